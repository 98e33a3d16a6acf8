"""Text into pre-tokens, many texts at a time: character classes and boundaries are array operations.

Both splitting patterns cut at places that the classes of neighbouring characters decide, so no
regular expression runs over the text. ``distinct`` then names every distinct pre-token once.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from ledgerlight.llm.common import once

OTHER, LETTER, NUMBER, SPACE, BLANK, EDGE = range(6)

# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# The contractions that both patterns split off.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")

SEGMENT_CHARS = 1_000_000
SAFE_CUT = re.compile(r"(?<=[A-Za-z0-9.,]) (?=[A-Za-z0-9])")


def class_table() -> np.ndarray:
    return once(("character classes",), build_class_table)


def build_class_table() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)),
        np.uint8, sys.maxunicode + 1,
    )
    table[list(WHITE_SPACE)] = SPACE
    table[0x20] = BLANK
    return table


@dataclass(frozen=True)
class Pieces:
    """Pre-tokens as ranges of the joined text; ``owner`` is the index of the text each belongs to."""

    joined: str
    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray


def segments(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Texts, the longest cut at blanks between plain characters, where every pattern cuts anyway."""
    parts: list[str] = []
    owner: list[int] = []
    for i, text in enumerate(texts):
        start = 0
        while len(text) - start > SEGMENT_CHARS:
            cut = SAFE_CUT.search(text, start + SEGMENT_CHARS)
            if cut is None:
                break
            parts.append(text[start:cut.start()])
            owner.append(i)
            start = cut.start()
        parts.append(text[start:] if start else text)
        owner.append(i)
    return parts, np.array(owner, dtype=np.int64)


def split(texts: list[str], keep_space: bool) -> Pieces:
    """Pre-tokens of texts.

    With ``keep_space`` runs of white space are pre-tokens and one blank goes with the word behind it; else
    white space is dropped and every numeral stands alone. Empty texts have no pre-tokens.
    """
    parts, owner = segments(texts)
    joined = "\n" + "\n".join(parts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    edges = np.concatenate(([0], np.cumsum(lengths + 1)))
    kind = class_table()[codes]
    kind[edges] = EDGE
    previous, following = np.empty_like(kind), np.empty_like(kind)
    previous[0], previous[1:] = EDGE, kind[:-1]
    following[-1], following[:-1] = EDGE, kind[1:]
    word = kind <= NUMBER
    white = (kind == SPACE) | (kind == BLANK)
    if keep_space:
        start = white & ((following <= NUMBER) | ((previous != SPACE) & (previous != BLANK)))
        start |= word & (previous != kind) & (previous != BLANK)
        opens = (previous != OTHER) & (previous != BLANK)
    else:
        start = word & ((previous != kind) | (kind == NUMBER))
        opens = previous != OTHER
    cut_contractions(codes, kind, opens, start)
    stops = start | (kind == EDGE) if keep_space else start | (kind == EDGE) | white
    at = np.flatnonzero(stops)
    first = start[at[:-1]]
    starts, ends = at[:-1][first], at[1:][first]
    which = np.searchsorted(edges, starts, side="right") - 1
    return Pieces(joined, codes, starts, ends, owner[which])


def cut_contractions(codes: np.ndarray, kind: np.ndarray, opens: np.ndarray, start: np.ndarray) -> None:
    """An apostrophe that begins a pre-token takes the ending behind it; the rest of the word starts anew."""
    marks = np.flatnonzero((codes == ord("'")) & opens & (kind == OTHER))
    if not len(marks):
        return
    last = len(codes) - 1
    one, two = codes[np.minimum(marks + 1, last)], codes[np.minimum(marks + 2, last)]
    size = np.where(np.isin(one, [ord(c) for c in SHORT_ENDINGS]), 1, 0)
    for ending in LONG_ENDINGS:
        size[(one == ord(ending[0])) & (two == ord(ending[1]))] = 2
    marks, size = marks[size > 0], size[size > 0]
    start[marks] = True
    start[marks + 1] = False
    after = marks + 1 + size
    start[after[kind[after] == LETTER]] = True


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
KEPT_POWERS = 1 << 20


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse up to a size; the usual sizes are kept."""
    if size > KEPT_POWERS:
        return build_powers(size)
    up, down = once(("powers",), lambda: build_powers(KEPT_POWERS))
    return up[:size], down[:size]


def build_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def distinct(pieces: Pieces) -> tuple[list[str], np.ndarray]:
    """The distinct pre-tokens, and for each pre-token its index among them.

    Ranges are hashed by prefix sums and grouped by hash; each is then compared with the first of its
    group, character by character, so a collision can't go unnoticed: it would be settled by the texts.
    """
    starts, ends = pieces.starts, pieces.ends
    if not len(starts):
        return [], np.empty(0, np.int64)
    up, down = powers(1 << int(len(pieces.codes)).bit_length())
    with np.errstate(over="ignore"):
        sums = np.zeros(len(pieces.codes) + 1, np.uint64)
        np.cumsum((pieces.codes.astype(np.uint64) + np.uint64(1)) * up[: len(pieces.codes)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * down[starts]
        hashes ^= hashes >> np.uint64(29)
    coded = pa.array(hashes).dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    first = np.empty(len(coded.dictionary), np.int64)
    first[index[::-1]] = np.arange(len(index) - 1, -1, -1)
    sizes = ends - starts
    model = starts[first][index]
    same = sizes == sizes[first][index]
    if same.all():
        again = np.flatnonzero(model != starts)
        width = sizes[again]
        own = np.arange(int(width.sum())) + np.repeat(starts[again] - (np.cumsum(width) - width), width)
        same = pieces.codes[own] == pieces.codes[own - np.repeat(starts[again] - model[again], width)]
    if same.all():
        text = pieces.joined
        return [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())], index
    words = [pieces.joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return list(names), np.fromiter(map(names.__getitem__, words), np.int64, len(words))
