"""Packing of token sequences: shallow combinations of lengths fill a window, non-negative least squares says how often.

Documents are cut at multiples of the window. What is left of each is shorter; the histogram of these lengths
(at most one count per length, so of bounded size) is matched by combinations of two or three lengths that fill a
power of two exactly. Bundles of half or a quarter window stack without a gap. Rounding leaves residual documents,
which are laid end to end and cut where a window is full; the last, unfilled window is cut into powers of two.

A piece's place follows from its rank among the pieces of its length. Ranks need no sort: every writing task numbers
its pieces of each length, and the numbers of the tasks before it are added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerlight.llm.common import CHUNK_CHARS, byte_runs, release, texts
from ledgerlight.llm.vocabulary import word_ids, word_vocabulary
from ledgerlight.session import materialise

LEAST_WINDOW = 64
HEAVY_LENGTHS = 16
STEPS = 200
BROADCAST_OFFSETS = 500_000

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, block long, ordinal long"
SLOTS = T.StructType([
    T.StructField(n, T.LongType(), False) for n in ("length", "first", "behind", "size", "at", "inner", "base")
])


def pack(
    docs: DataFrame, vocabulary_path: str, window: int = 4096, end_id: int = 2, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): every id of every text in exactly one piece.

    ``window`` is a power of two. Ids are unsigned 32-bit little-endian integers in a binary column. Null and empty
    texts hold the end id alone; null keys stay null; repeated rows are packed one by one; an empty table gives no
    piece; columns other than key and text are not read; long texts are cut at multiples of the window.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two")
    cut = materialise(cut_tokens(texts(docs, key, text), vocabulary_path, window, end_id))
    per_block = cut.groupBy("block", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(per_block.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    histogram = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_windows(histogram, window)
    return place(cut, offsets, plan, window)


def cut_tokens(docs: DataFrame, vocabulary_path: str, window: int, end_id: int) -> DataFrame:
    """One row per piece of at most a window, numbered within its task among the pieces of its length."""

    def run(batches):
        block = TaskContext.get().partitionId()
        vocabulary = word_vocabulary(vocabulary_path)
        seen = np.zeros(window + 1, np.int64)
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            keys = batch.column("doc_id")
            for first, last in byte_runs(batch.column("text"), CHUNK_CHARS):
                coded = word_ids(vocabulary, batch.column("text").slice(first, last - first).to_pylist())
                tokens = np.fromiter(map(len, coded), np.int64, len(coded)) // 4 + 1
                owner = np.repeat(np.arange(len(coded)), -(-tokens // window))
                part = np.arange(len(owner)) - np.searchsorted(owner, owner)
                start = part * window
                length = np.minimum(tokens[owner] - start, window)
                ids = []
                for i, a, n in zip(owner.tolist(), (start * 4).tolist(), (length * 4).tolist()):
                    piece = coded[i][a:a + n]
                    ids.append(piece if len(piece) == n else piece + end)
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                ordinal = np.empty(len(owner), np.int64)
                ordinal[order] = seen[ranked] + np.arange(len(owner)) - np.searchsorted(ranked, ranked)
                seen += np.bincount(length, minlength=window + 1)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, last - first).take(pa.array(owner)), pa.array(start), pa.array(length),
                     pa.array(tokens[owner]), pa.array(ids, pa.binary()),
                     pa.array(np.full(len(owner), block, np.int64)), pa.array(ordinal)],
                    names=["doc_id", "start", "length", "doc_tokens", "ids", "block", "ordinal"],
                )
        release()

    return docs.mapInArrow(run, PIECES)


class WindowPlan:
    """Slots (length, ranks, where they go), and the stream of residual pieces behind all planned sequences."""

    def __init__(self, slots: list[tuple], planned: int, stream: int):
        self.slots, self.planned, self.stream = slots, planned, stream


def plan_windows(histogram: dict[int, int], window: int) -> WindowPlan:
    """From counts per length, bounded by the window, to ranges of ranks and their places."""
    counts = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    full = int(counts[window])
    slots = [(window, 0, full, window, 0, 0, 0)] if full else []
    left = counts.copy()
    left[window] = 0
    combos, sizes = combinations(left, window)
    repeats = rounded_repeats(combos, least_squares(combos, left), left)
    repeats = whole_stacks(repeats, sizes, window)
    used = np.zeros(window + 1, np.int64)
    base = full
    for size in sorted(set(sizes.tolist()), reverse=True):
        per_window, bundles = window // size, 0
        for k in np.flatnonzero((sizes == size) & (repeats > 0)).tolist():
            n, inner = int(repeats[k]), 0
            for length in combos[k].tolist():
                if length:
                    first = int(used[length])
                    slots.append((length, first, first + n, size, bundles, inner, base))
                    used[length] += n
                    inner += length
            bundles += n
        base += bundles // per_window
    stream = 0
    for length in np.flatnonzero(left > used)[::-1].tolist():
        slots.append((length, int(used[length]), int(left[length]), 0, stream, 0, base))
        stream += length * int(left[length] - used[length])
    return WindowPlan(slots, base, stream)


def combinations(counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to three lengths that occur and fill a power of two; the third is one of the heaviest lengths."""
    there = counts > 0
    heavy = np.argsort(-counts, kind="stable")[:HEAVY_LENGTHS]
    heavy = heavy[counts[heavy] > 0]
    rows, sizes = [], []
    size = min(LEAST_WINDOW, window)
    while size <= window:
        if size < window and there[size]:
            rows.append(np.array([[size, 0, 0]]))
            sizes.append(size)
        for third in [0, *heavy.tolist()]:
            rest = size - third
            a = np.arange(1, rest // 2 + 1) if rest > 1 else np.empty(0, np.int64)
            a = a[there[a] & there[rest - a]]
            rows.append(np.stack([rest - a, a, np.full(len(a), third)], axis=1))
            sizes.append(size)
        size *= 2
    lengths = np.concatenate(rows) if rows else np.empty((0, 3), np.int64)
    return lengths, np.repeat(sizes, [len(r) for r in rows]).astype(np.int64)


def least_squares(combos: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """x >= 0 with combos x near counts: multiplicative steps, which never leave the non-negative numbers."""
    goal = counts.astype(float)
    goal[0] = 0
    weight = (combos > 0).astype(float)
    x = np.full(len(combos), goal.sum() / max(weight.sum(), 1))
    wanted = (goal[combos] * weight).sum(axis=1)
    for _ in range(STEPS):
        made = np.bincount(combos.ravel(), weights=(x[:, None] * weight).ravel(), minlength=len(goal))
        x *= wanted / np.maximum((made[combos] * weight).sum(axis=1), 1e-12)
    return x


def rounded_repeats(combos: np.ndarray, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whole repeats, the largest first, none beyond what is left of a length."""
    left, out = counts.copy(), np.zeros(len(combos), np.int64)
    for k in np.argsort(-x, kind="stable").tolist():
        lengths, need = np.unique(combos[k][combos[k] > 0], return_counts=True)
        n = min(int(np.ceil(x[k] - 0.5)), int((left[lengths] // need).min()))
        if n > 0:
            out[k] = n
            left[lengths] -= n * need
    return out


def whole_stacks(repeats: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Bundles of each size a multiple of what fills a window; the few beyond go back to the residuals."""
    out = repeats.copy()
    for size in set(sizes.tolist()):
        mine = np.flatnonzero(sizes == size)
        beyond = int(out[mine].sum()) % (window // size)
        for k in mine[::-1]:
            taken = min(beyond, int(out[k]))
            out[k] -= taken
            beyond -= taken
    return out


def place(cut: DataFrame, offsets: DataFrame, plan: WindowPlan, window: int) -> DataFrame:
    """Each piece's sequence and offset; residual pieces are cut where their stream fills a sequence."""
    spark: SparkSession = cut.sparkSession
    before = offsets.select("block", "length", "before")
    if offsets.count() <= BROADCAST_OFFSETS:
        before = F.broadcast(before)
    slots = F.broadcast(spark.createDataFrame(plan.slots, SLOTS))
    rank = F.col("before") + F.col("ordinal")
    found = (
        cut.join(before, ["block", "length"]).withColumn("rank", rank)
        .join(slots, "length").where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("behind")))
    )
    nth = F.col("rank") - F.col("first")
    per_window = F.lit(window) / F.col("size")
    bundle = F.col("at") + nth
    from_plan = found.where("size > 0").select(
        "doc_id", "start", "length", "doc_tokens",
        (F.col("base") + F.floor(bundle / per_window)).cast("long").alias("sequence_id"),
        ((bundle % per_window) * F.col("size") + F.col("inner")).cast("long").alias("offset"),
        "ids",
    )
    edges = tail_edges(plan.stream, window)
    whole = plan.stream // window
    position = F.col("at") + nth * F.col("length")
    residual = found.where("size = 0").withColumn("here", position).withColumn("stop", F.expr("here + length"))
    next_window = F.expr(f"(floor(here / {window}) + 1) * {window}").cast("long")
    inside = F.filter(
        F.array_distinct(F.array(next_window, *[F.lit(e).cast("long") for e in edges])),
        lambda x: (x > F.col("here")) & (x < F.col("stop")),
    )
    residual = residual.withColumn("cuts", F.array_sort(inside))
    residual = residual.withColumn("part", F.explode(F.arrays_zip(
        F.concat(F.array("here"), "cuts").alias("a"), F.concat("cuts", F.array("stop")).alias("b"),
    )))
    a, b = F.col("part.a"), F.col("part.b")
    tail = F.lit(0).cast("long")
    tail_start = F.lit(whole * window).cast("long")
    for k, edge in enumerate(edges):
        tail = F.when(a >= edge, k).otherwise(tail)
        tail_start = F.when(a >= edge, edge).otherwise(tail_start)
    in_tail = a >= whole * window
    skip = (a - F.col("here")).cast("int")
    from_stream = residual.select(
        "doc_id", (F.col("start") + skip).alias("start"), (b - a).alias("length"), "doc_tokens",
        (F.col("base") + F.when(in_tail, whole + tail).otherwise(F.floor(a / window))).cast("long").alias("sequence_id"),
        F.when(in_tail, a - tail_start).otherwise(a % window).cast("long").alias("offset"),
        F.substring("ids", skip * 4 + 1, ((b - a) * 4).cast("int")).alias("ids"),
    )
    return from_plan.unionByName(from_stream)


def tail_edges(stream: int, window: int) -> list[int]:
    """Where the sequences begin into which the last, unfilled window is cut: powers of two, the largest first."""
    at, edges = stream // window * window, []
    while at < stream:
        edges.append(at)
        at += 1 << ((stream - at).bit_length() - 1)
    return edges
