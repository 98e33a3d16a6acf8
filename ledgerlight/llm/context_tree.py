"""Scoring by context-tree weighting over binary-decomposed bytes.

The model is a tree of byte contexts up to DEPTH; in each context a byte is eight binary choices, each with counts of
zeros and ones and a Krichevsky-Trofimov estimate. A node's weighted probability is half its own estimate's and half
the product of its children's, so that every depth has a posterior weight, and a prediction mixes all depths
that the training text has seen (an unseen context predicts nothing; its parent stands in).

What is counted grows with the corpus and is nowhere gathered whole. Documents are dealt to buckets of bounded size.
Each bucket counts its grams (a byte behind its context) and words; sums go by gram, trees of different pairs of nearest
context bytes are built apart, and only nodes of depth 0 and 1, at most 257 times 255, pass the
driver. Probabilities go back to the buckets that asked for them and meet their texts there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm.common import byte_runs, crc32_mod, release, texts
from ledgerlight.llm.keytable import KeyTable
from ledgerlight.session import materialise

DEPTH = 5
BUCKET_BYTES = 24 << 20
PART_BYTES = 1 << 19
GROUP_GRAMS = 200_000
HELD_GRAMS = 1_200_000
MOST_LABELS = 4096
FOLDS = 10
TABLE = 4096
HALF = float(np.log(0.5))
COUNTED = "bucket int, gram long, word binary, n long"
SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, word_score double, score double, n_symbols long"
)


def grams_of(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of every text and its end (a zero byte) as a gram: nearest context byte highest, the byte
    itself lowest; and how many grams each text has. Before a text's start the context is zero bytes.
    """
    pad = bytes(DEPTH)
    joined = np.frombuffer(pad + b"".join(r + b"\0" + pad for r in raws), np.uint8)
    sizes = np.fromiter(map(len, raws), np.int64, len(raws)) + 1
    starts = DEPTH + np.cumsum(sizes + DEPTH) - (sizes + DEPTH)
    inside = np.zeros(len(joined) + 1, np.int8)
    inside[starts] += 1
    inside[starts + sizes] -= 1
    grams = joined.astype(np.int64)
    for back in range(1, DEPTH + 1):
        grams[back:] |= joined[:-back].astype(np.int64) << (8 * (DEPTH - back + 1))
    return grams[np.cumsum(inside[:-1], dtype=np.int8).view(bool)], sizes


def cut_long(raw: bytes) -> Iterator[tuple[bytes, bytes, bool]]:
    """(context, part, last) of a text in parts of bounded size."""
    for start in range(0, max(len(raw), 1), PART_BYTES):
        end = start + PART_BYTES
        yield raw[max(start - DEPTH, 0):start], raw[start:end], end >= len(raw)


def grams_in_parts(raw: bytes) -> Iterator[np.ndarray]:
    """The grams of one text of any length, a bounded number at a time."""
    for context, part, last in cut_long(raw):
        grams, _ = grams_of([context + part])
        grams = grams[len(context):]
        yield grams if last else grams[:-1]


def text_runs(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of whole lower-cased texts of bounded size, with the index of the first."""
    for first, last in byte_runs(column, PART_BYTES):
        yield first, [t.encode().lower() for t in column.slice(first, last - first).to_pylist()]


class BucketCounts:
    """Counts of one bucket: its grams and words, and how often they occur in training texts."""

    def __init__(self):
        self.table, self.grams = KeyTable(), np.zeros(0, np.int64)
        self.words: Counter[bytes] = Counter()
        self.other: set[bytes] = set()

    def take(self, raws: list[bytes], train: list[bool]) -> None:
        for raw, learn in zip(raws, train):
            words = raw.split()
            if learn:
                self.words.update(words)
            else:
                self.other.update(words)
        if len(raws) == 1:
            for grams in grams_in_parts(raws[0]):
                self.tally(grams, np.full(len(grams), train[0]))
        else:
            grams, sizes = grams_of(raws)
            self.tally(grams, np.repeat(np.array(train, bool), sizes))

    def tally(self, grams: np.ndarray, learn: np.ndarray) -> None:
        places = self.table.places(grams)
        if self.table.count > len(self.grams):
            wider = np.zeros(max(self.table.count, len(self.grams) + len(self.grams) // 2), np.int64)
            wider[: len(self.grams)] = self.grams
            self.grams = wider
        found = np.bincount(places[learn], minlength=self.table.count)
        self.grams[: len(found)] += found

    def rows(self, bucket: int) -> Iterator[pa.RecordBatch]:
        keys = self.table.held()
        order = np.argsort(keys)
        n = len(keys)
        yield counted(bucket, pa.array(keys[order]), pa.nulls(n, pa.binary()), pa.array(self.grams[:n][order]))
        for word in self.other:
            self.words.setdefault(word, 0)
        n = len(self.words)
        words, times = pa.array(self.words.keys(), pa.binary()), pa.array(self.words.values(), pa.int64())
        yield counted(bucket, pa.nulls(n, pa.int64()), words, times)


def counted(bucket: int, grams: pa.Array, words: pa.Array, n: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(n), bucket, np.int32)), grams, words, n], names=["bucket", "gram", "word", "n"],
    )


def count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams and words of each bucket that this task holds, with their training counts, which may be 0.

    At HELD_GRAMS what has been counted is put out, and counting starts anew: sums don't mind the repeats.
    """
    found: dict[int, BucketCounts] = {}
    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        for bucket in np.unique(buckets).tolist():
            part = batch.filter(pa.array(buckets == bucket))
            train = [not h for h in part.column("held_out").to_pylist()]
            counts = found.setdefault(bucket, BucketCounts())
            for first, raws in text_runs(part.column("text")):
                counts.take(raws, train[first:first + len(raws)])
            if sum(c.table.count for c in found.values()) > HELD_GRAMS:
                del counts
                while found:
                    yield from rows_of(found)
                release()
    while found:
        yield from rows_of(found)
    release()


def rows_of(found: dict[int, BucketCounts]) -> Iterator[pa.RecordBatch]:
    """The rows of one bucket, which is then let go."""
    bucket = min(found)
    yield from found.pop(bucket).rows(bucket)


def even_labels(spark: SparkSession, buckets: int) -> list[int]:
    """A number for each bucket such that hash partitioning deals every bucket to a partition of its own."""
    if buckets > MOST_LABELS:
        return []
    numbers = spark.range(40 * buckets).select(F.col("id").cast("int").alias("i"))
    dealt = numbers.groupBy(F.pmod(F.hash("i"), F.lit(buckets)).alias("p")).agg(F.min("i").alias("i"))
    found = [r["i"] for r in dealt.orderBy("p").collect()]
    return found if len(found) == buckets else []


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, for arguments from 8 on."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any sequence with so many zeros and ones."""
    def half_up(n: np.ndarray) -> np.ndarray:
        """log of (1/2)(3/2)...(n - 1/2)."""
        table = np.concatenate(([0.0], np.cumsum(np.log(np.arange(TABLE) + 0.5))))
        big = np.maximum(n, TABLE).astype(float)
        return np.where(n <= TABLE, table[np.minimum(n, TABLE)], log_gamma(big + 0.5) - 0.5 * np.log(np.pi))

    def factorial(n: np.ndarray) -> np.ndarray:
        table = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, TABLE + 1)))))
        big = np.maximum(n, TABLE).astype(float)
        return np.where(n <= TABLE, table[np.minimum(n, TABLE)], log_gamma(big + 1))

    return half_up(zeros) + half_up(ones) - factorial(zeros + ones)


def mixed(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Log of the weighted probability: half the own estimate, half the children's."""
    return np.logaddexp(HALF + own, HALF + children)


class Level:
    """All binary nodes of one depth and bit: (context, bits before) in order, and their counts."""

    def __init__(self, pairs: np.ndarray, n: np.ndarray, bit: int):
        symbol = pairs & 255
        keys = ((pairs >> 8) << 8) | ((1 << bit) | (symbol >> (8 - bit)))
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        one = (symbol >> (7 - bit)) & 1
        self.keys = keys[first]
        self.of_pair = np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1])))
        self.ones = np.add.reduceat(n * one, first)
        self.zeros = np.add.reduceat(n, first) - self.ones
        self.own = log_kt(self.zeros, self.ones)
        self.weighted = self.own


def build_levels(grams: np.ndarray, n: np.ndarray, top: int) -> tuple[list[np.ndarray], list[list[Level]]]:
    """For depths ``top`` to DEPTH the (context, byte) pairs and the levels of their eight bits, weighted upward.

    ``grams`` are sorted and distinct.
    """
    pairs, levels = {}, {}
    pairs[DEPTH], counts = grams, n
    levels[DEPTH] = [Level(grams, counts, bit) for bit in range(8)]
    for depth in range(DEPTH - 1, top - 1, -1):
        below = pairs[depth + 1]
        shorter = ((below >> 16) << 8) | (below & 255)
        pairs[depth], index = np.unique(shorter, return_inverse=True)
        counts = np.bincount(index, weights=counts, minlength=len(pairs[depth])).astype(np.int64)
        levels[depth] = [Level(pairs[depth], counts, bit) for bit in range(8)]
        for bit in range(8):
            level, child = levels[depth][bit], levels[depth + 1][bit]
            parent = ((child.keys >> 16) << 8) | (child.keys & 255)
            total = np.bincount(np.searchsorted(level.keys, parent), weights=child.weighted, minlength=len(level.keys))
            level.weighted = mixed(level.own, total)
    return pairs, levels


def top_nodes(part: pd.DataFrame) -> pd.DataFrame:
    """Depth-2 nodes of some pairs of nearest context bytes, for the levels above."""
    part = part.sort_values("gram")
    _, levels = build_levels(part["gram"].to_numpy(), part["n"].to_numpy(), 2)
    out = [
        pd.DataFrame({"context": level.keys >> 16, "node": (level.keys & 255).astype(np.int32),
                      "zeros": level.zeros, "ones": level.ones, "weighted": level.weighted})
        for level in levels[2]
    ]
    release()
    return pd.concat(out).query("zeros + ones > 0")


class Root:
    """Nodes of depth 0 and 1 in arrays by (nearest byte, node), shares of their own estimates included."""

    def __init__(self, rows: list[tuple[int, int, int, int, float]]):
        zeros, ones, below = (np.zeros((257, 256)) for _ in range(3))
        for context, node, z, o, weighted in rows:
            zeros[context, node], ones[context, node], below[context, node] = z, o, weighted
        zeros[256], ones[256] = zeros[:256].sum(axis=0), ones[:256].sum(axis=0)
        own = log_kt(zeros.astype(np.int64), ones.astype(np.int64))
        weighted = mixed(own, below)
        weighted[256] = mixed(own[256], weighted[:256].sum(axis=0))
        self.seen = zeros + ones > 0
        self.share = np.exp(HALF + own - weighted)
        self.p_one = (ones + 0.5) / (zeros + ones + 1)


def probabilities(part: pd.DataFrame, root: Root) -> pd.DataFrame:
    """log10 probability of each gram's byte in its context, all depths mixed."""
    part = part.sort_values("gram")
    grams = part["gram"].to_numpy()
    pairs, levels = build_levels(grams, part["n"].to_numpy(), 2)
    index = {}
    for depth in range(DEPTH, 1, -1):
        if depth == DEPTH:
            index[depth] = np.arange(len(grams))
        else:
            shorter = ((grams >> (8 * (DEPTH - depth) + 8)) << 8) | (grams & 255)
            index[depth] = np.searchsorted(pairs[depth], shorter)
    nearest = (grams >> (8 * DEPTH)).astype(np.int64)
    symbol = grams & 255
    total = np.zeros(len(grams))
    for bit in range(8):
        node = (1 << bit) | (symbol >> (8 - bit))
        # from the deepest context that the training text has seen upward
        p = np.zeros(len(grams))
        seen = np.zeros(len(grams), bool)
        for depth in range(DEPTH, 1, -1):
            level = levels[depth][bit]
            at = level.of_pair[index[depth]]
            zeros, ones = level.zeros[at], level.ones[at]
            share = np.exp(HALF + level.own[at] - level.weighted[at]) if depth < DEPTH else np.ones(len(at))
            p, seen = mix(p, seen, (ones + 0.5) / (zeros + ones + 1), share, zeros + ones > 0)
        for context in (nearest, np.full(len(grams), 256)):
            p, seen = mix(p, seen, root.p_one[context, node], root.share[context, node], root.seen[context, node])
        p = np.where(seen, p, 0.5)
        one = (symbol >> (7 - bit)) & 1
        total += np.log10(np.where(one == 1, p, 1 - p))
    release()
    return pd.DataFrame({"gram": grams, "p": total})


def mix(
    p: np.ndarray, seen: np.ndarray, own: np.ndarray, share: np.ndarray, here: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """One depth up: the own estimate with its share if a deeper node was seen, alone if none was."""
    joint = np.where(seen, share * own + (1 - share) * p, own)
    return np.where(here, joint, p), seen | here


def score_bucket(docs: pa.Table, values: pa.Table) -> pa.Table:
    """Texts of one bucket against the probabilities and counts that it asked for."""
    grams_in = values.filter(pa.compute.is_valid(values.column("gram")))
    table = KeyTable()
    table.add(grams_in.column("gram").to_numpy())
    chance = grams_in.column("v").to_numpy()
    words_in = values.filter(pa.compute.is_valid(values.column("word")))
    place = {w: i for i, w in enumerate(words_in.column("word").to_pylist())}
    count = words_in.column("v").to_numpy()
    logs, seen = np.log10(count + 0.1), count > 0
    del grams_in, words_in, values
    n_tokens, n_known, word_score, score, n_symbols = [], [], [], [], []
    for raws in (raws for batch in docs.to_batches() for _, raws in text_runs(batch.column("text"))):
        for raw in raws:
            words = raw.split()
            n_tokens.append(len(words) + 1)
            at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            n_known.append(int(seen[at].sum()))
            word_score.append(float(logs[at].sum()))
            n_symbols.append(len(raw) + 1)
        if len(raws) == 1:
            score.append(float(sum(chance[table.find(g)].sum() for g in grams_in_parts(raws[0]))))
        else:
            grams, sizes = grams_of(raws)
            score += np.add.reduceat(chance[table.find(grams)], np.cumsum(sizes) - sizes).tolist()
    release()
    return pa.table({
        "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"),
        "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
        "word_score": pa.array(word_score, pa.float64()), "score": pa.array(score, pa.float64()),
        "n_symbols": pa.array(n_symbols, pa.int64()),
    })


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte), a row for each row of docs.

    Learns from documents whose id's crc32 is no multiple of 10. ``score`` is the log10 probability of the lower-cased
    text and its end under the context tree, ``bits_per_byte`` its code length; ``base_score`` is that of a smoothed
    word count. Null texts are empty ones, which have one token, the end. Rows with a null key are dealt out by their
    text; repeated rows count as often as they occur and each give a row; an empty table gives none;
    columns other than key and text are not read; texts of any length are scored whole, in bounded parts.
    """
    source = texts(docs, key, text)
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(-(-size // BUCKET_BYTES), 6)
    place = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(buckets)).cast("int")
    dealt = source.select(place.alias("bucket"), "doc_id", "text", (crc32_mod("doc_id", FOLDS) == 0).alias("held_out"))
    labels = even_labels(source.sparkSession, buckets)
    label = F.element_at(F.array(*map(F.lit, labels)), F.col("bucket") + 1) if labels else F.col("bucket")
    spread = dealt.withColumn("label", label).repartition(buckets, "label").drop("label")
    counts = materialise(spread.mapInArrow(count_buckets, COUNTED))

    grams = counts.where("gram is not null").select("bucket", "gram", "n")
    sums = materialise(grams.groupBy("gram").agg(F.sum("n").alias("n")))
    groups = max(-(-sums.count() // GROUP_GRAMS), 12)
    pair = F.shiftrightunsigned("gram", 8 * (DEPTH - 1))
    by_pair = sums.withColumn("part", F.pmod(F.xxhash64(pair), F.lit(groups)).cast("int"))
    nodes = by_pair.groupBy("part").applyInPandas(
        lambda part: top_nodes(part), "context long, node int, zeros long, ones long, weighted double",
    )
    # nodes of depth 1: at most 256 contexts of 255 nodes
    upper = nodes.groupBy("context", "node").agg(F.sum("zeros"), F.sum("ones"), F.sum("weighted")).collect()
    root = Root([tuple(r) for r in upper])
    chances = by_pair.groupBy("part").applyInPandas(lambda part: probabilities(part, root), "gram long, p double")

    words = counts.where("word is not null").select("bucket", "word", "n")
    totals = materialise(words.groupBy("word").agg(F.sum("n").alias("c")))
    n_words, n_types = totals.where("c > 0").agg(F.sum("c"), F.count("*")).first()
    ends = source.where(crc32_mod("doc_id", FOLDS) != 0).count()
    train_tokens = (n_words or 0) + ends
    types = n_types + (ends > 0)

    nothing = F.lit(None)
    values = grams.join(chances, "gram").select("bucket", "gram", nothing.cast("binary").alias("word"), F.col("p").alias("v"))
    values = values.unionByName(words.join(totals, "word").select(
        "bucket", nothing.cast("long").alias("gram"), "word", F.col("c").cast("double").alias("v"),
    ))
    scored = dealt.groupBy("bucket").cogroup(values.groupBy("bucket")).applyInArrow(
        lambda left, right: score_bucket(left, right), SCORED,
    )
    # every token's share of the denominator, and the end's own count
    log10 = lambda x: float(np.log10(x))
    base = F.col("word_score") + F.lit(log10(ends + 0.1)) - F.col("n_tokens") * F.lit(log10(train_tokens + 0.1 * (types + 1)))
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.col("n_symbols")).alias("bits_per_byte"),
    )
