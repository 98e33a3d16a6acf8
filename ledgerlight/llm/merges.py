"""Byte-pair merging of many words at once.

Words of like length share a padded matrix with one row each. In every round each row merges its leftmost
pair of least rank; finished rows leave the matrix and unused columns are cut off. Pair ranks come from an
open-addressing hash table held in arrays.
"""

from __future__ import annotations

import heapq
import numpy as np

NONE = np.int32(np.iinfo(np.int32).max)
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 20, 24, 32, 48, 64, 128, 256, 512, 1024)
MATRIX_CELLS = 1 << 19


class PairTable:
    """(left, right) -> (rank, merged), looked up for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        bits = max(int(len(left) * 2).bit_length(), 4)
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.merged = np.zeros(1 << bits, np.int32)
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slots = self.slots(keys)
        waiting = np.arange(len(keys))
        self.steps = 0
        while len(waiting):
            self.steps += 1
            place = slots[waiting]
            free = self.keys[place] == -1
            _, winner = np.unique(place[free], return_index=True)
            chosen = waiting[free][winner]
            at = slots[chosen]
            self.keys[at], self.rank[at], self.merged[at] = keys[chosen], rank[chosen], merged[chosen]
            waiting = waiting[self.keys[slots[waiting]] != keys[waiting]]
            slots[waiting] = (slots[waiting] + 1) & self.mask

    def slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair; an empty slot's rank is NONE. A pad (negative id) pairs with nothing."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slots = self.slots(keys)
        held = self.keys[slots]
        wrong = (held != keys) & (held != -1)
        while wrong.any():
            slots[wrong] = (slots[wrong] + 1) & self.mask
            held = self.keys[slots]
            wrong = (held != keys) & (held != -1)
        return slots


def merge_all(flat: np.ndarray, sizes: np.ndarray, table: PairTable) -> list[bytes]:
    """Each word's ids, as little-endian unsigned 32-bit integers, once no pair is left to merge.

    ``flat`` holds the ids of all words one after another, ``sizes`` how many each word has.
    """
    out: list[bytes] = [b""] * len(sizes)
    starts = np.cumsum(sizes) - sizes
    low = 0
    for width in WIDTHS:
        chosen = np.flatnonzero((sizes > low) & (sizes <= width))
        rows = max(MATRIX_CELLS // width, 1)
        for start in range(0, len(chosen), rows):
            part = chosen[start:start + rows]
            cells = starts[part][:, None] + np.arange(width)
            inside = np.arange(width) < sizes[part][:, None]
            matrix = np.where(inside, flat[np.minimum(cells, len(flat) - 1)], np.int32(-1)).astype(np.int32)
            merge_rows(out, part, matrix, sizes[part], table)
        low = width
    for i in np.flatnonzero(sizes > low).tolist():
        out[i] = merge_long(flat[starts[i]:starts[i] + sizes[i]], table).astype("<u4").tobytes()
    return out


def merge_rows(
    out: list[bytes], rows: np.ndarray, matrix: np.ndarray, sizes: np.ndarray, table: PairTable,
) -> None:
    """Merge the rows of a matrix padded with -1, which is at least two columns wide."""
    slots = table.find(matrix[:, :-1], matrix[:, 1:])
    ranks = np.where(matrix[:, 1:] >= 0, table.rank[slots], NONE)
    while True:
        here = np.arange(len(rows))
        best = ranks.argmin(axis=1)
        done = ranks[here, best] == NONE
        if done.any():
            put(out, rows[done], matrix[done], sizes[done])
            keep = ~done
            rows, matrix, ranks, sizes, best = rows[keep], matrix[keep], ranks[keep], sizes[keep], best[keep]
            if not len(rows):
                return
            here = np.arange(len(rows))
        longest = int(sizes.max())
        if longest < matrix.shape[1]:
            matrix, ranks = matrix[:, :longest], ranks[:, : longest - 1]
        merged = table.merged[table.find(matrix[here, best], matrix[here, best + 1])]
        matrix = close_gap(matrix, best + 1, np.int32(-1))
        matrix[here, best] = merged
        ranks = close_gap(ranks, best, NONE)
        sizes = sizes - 1
        for shift in (-1, 0):
            at = best + shift
            ok = (at >= 0) & (at + 1 < sizes)
            r, c = here[ok], at[ok]
            ranks[r, c] = table.rank[table.find(matrix[r, c], matrix[r, c + 1])]


def put(out: list[bytes], rows: np.ndarray, matrix: np.ndarray, sizes: np.ndarray) -> None:
    raw = matrix[np.arange(matrix.shape[1]) < sizes[:, None]].astype("<u4").tobytes()
    stops = np.cumsum(sizes) * 4
    for i, a, b in zip(rows.tolist(), (stops - 4 * sizes).tolist(), stops.tolist()):
        out[i] = raw[a:b]


def close_gap(matrix: np.ndarray, gap: np.ndarray, fill: np.int32) -> np.ndarray:
    """Take column gap[i] out of row i; what follows moves left and fill comes in at the end."""
    moved = np.empty_like(matrix)
    moved[:, :-1], moved[:, -1] = matrix[:, 1:], fill
    return np.where(np.arange(matrix.shape[1]) < gap[:, None], matrix, moved)


def merge_long(word: np.ndarray, table: PairTable) -> np.ndarray:
    """One word too long for a matrix: a linked list and a heap of pairs, the same order of merges."""
    ids = word.tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    slots = table.find(word[:-1], word[1:])
    heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(table.rank[slots].tolist()) if r != NONE]
    heapq.heapify(heap)
    alive = [True] * n

    def push(i: int) -> None:
        j = after[i]
        if j < n:
            slot = table.find(np.array([ids[i]]), np.array([ids[j]]))[0]
            if table.rank[slot] != NONE:
                heapq.heappush(heap, (int(table.rank[slot]), i, ids[i], ids[j]))

    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or ids[i] != left or ids[j] != right:
            continue
        ids[i] = int(table.merged[table.find(np.array([left]), np.array([right]))[0]])
        alive[j] = False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return np.array([x for x, ok in zip(ids, alive) if ok], np.int32)
