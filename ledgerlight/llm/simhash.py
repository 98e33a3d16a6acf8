"""Near-duplicates by SimHash: fingerprints of word shingles, linked by multi-index hashing.

A fingerprint is cut into segments, enough of them that two fingerprints within the distance agree in one
up to a single bit. Each segment's ball of radius one is enumerated: a fingerprint is stored under its segments and
looked up under them with one clear bit set, so every pair with one differing bit is met from exactly one side.
Matches are verified by the full distance inside the join; equal fingerprints are one row throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import map_texts, texts
from ledgerlight.llm.components import components
from ledgerlight.session import materialise

SEED = 42
PART_BYTES = 1 << 20
BLANKS = b" \t\n\v\f\r"


def shingle_hashes(raw: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``words`` words of a lower-cased text, some at a time; of all words if fewer."""
    carry: list[bytes] = []
    start, any_shingle = 0, False
    while start < len(raw):
        end = min(start + PART_BYTES, len(raw))
        while end < len(raw) and raw[end] not in BLANKS:
            end += 1
        found = carry + raw[start:end].split()
        start = end
        if len(found) >= words:
            any_shingle = True
            joined = b" ".join(found)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ends = np.cumsum(sizes + 1) - 1
            first = (ends - sizes)[: len(found) - words + 1].tolist()
            digest = xxhash.xxh64_intdigest
            yield np.array([digest(joined[a:b], SEED) for a, b in zip(first, ends[words - 1:].tolist())], np.uint64)
        carry = found[len(found) - words + 1:] if len(found) >= words else found
        if words == 1:
            carry = []
    if not any_shingle and carry:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], np.uint64)


def fingerprints_of(batch: list[str], words: int) -> np.ndarray:
    """A bit is set where more than half of a text's shingle hashes have it; no words: zero."""
    parts, sizes = [], np.zeros(len(batch), np.int64)
    for i, text in enumerate(batch):
        for hashes in shingle_hashes(text.encode().lower(), words):
            sizes[i] += len(hashes)
            parts.append(hashes)
    ones = np.zeros((len(batch), 64), np.int64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        hashes = np.concatenate(parts)
        starts = (np.cumsum(sizes) - sizes)[filled]
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[filled] = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    majority = ones * 2 > sizes[:, None]
    return np.packbits(majority, axis=1, bitorder="little").view(np.int64).ravel()


def fingerprints(docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every whole text, the 64 bits as a signed long."""

    def work(batch: list[str]) -> dict[str, pa.Array]:
        return {"fp": pa.array(fingerprints_of(batch, words), pa.int64())}

    return map_texts(texts(docs, key, text), work, "doc_id long, fp long")


def segment(fp: Column, width: int, number: int) -> Column:
    mask = F.lit((1 << width) - 1).cast("long")
    return F.shiftrightunsigned(fp, width * number).bitwiseAND(mask)


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b): every pair of different fingerprints within the distance, once.

    Joined by shuffle at any size: Spark sizes a table by what it was before an explode, and would broadcast dozens of
    rows for each fingerprint.
    """
    if not 0 <= distance < 16:
        raise ValueError("distance must be 0 to 15")
    count = max(distance // 2 + 1, 2)
    width = 64 // count  # bits beyond the last segment are left to the verification
    names = F.array(*[segment(F.col("fp"), width, n) + F.lit(n << width).cast("long") for n in range(count)])
    stored = distinct.select(F.col("fp").alias("a"), F.explode(names).alias("to"))
    probes = distinct.select(F.col("fp").alias("b"), F.posexplode(names).alias("n", "at"))
    balls = probes.select("b", "n", F.explode(F.expr(
        f"concat(array(at), filter(transform(sequence(0, {width - 1}), i -> at | shiftleft(1L, i)), x -> x <> at))",
    )).alias("to"), "at")
    differing = F.col("a").bitwiseXOR(F.col("b"))
    near = F.bit_count(differing) <= distance
    earlier = F.lit(False)
    for n in range(count - 1):
        earlier = earlier | ((F.col("n") > n) & (F.bit_count(segment(differing, width, n)) <= 1))
    equal_here = F.col("to") == F.col("at")
    return (
        stored.hint("merge").join(balls.hint("merge"), "to")
        .where(near & ~earlier & (~equal_here | (F.col("a") < F.col("b"))))
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, words: int = 3, distance: int = 3, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of docs.

    Texts link when their fingerprints differ in at most ``distance`` bits; component_id is the smallest doc_id that
    can be reached. Null and empty texts share the fingerprint zero. A null key takes part with its text but
    is never a component's id; a component of null keys alone has none. Repeated rows each give a row; an
    empty table gives none; other columns are not read.
    """
    marked = materialise(fingerprints(docs, words, key, text))
    return grouped(marked, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def grouped(marked: DataFrame, distance: int) -> DataFrame:
    """Written (doc_id, fp) with component_id, the smallest doc_id that links reach."""
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct, distance))
    linked = roots.join(distinct, roots["node"] == distinct["fp"]).groupBy("root").agg(F.min("least").alias("smallest"))
    reached = roots.join(linked, "root").select(F.col("node").alias("fp"), "smallest")
    classes = materialise(
        distinct.join(reached, "fp", "left").select("fp", F.coalesce("smallest", "least").alias("component_id"))
    )
    return marked.join(classes, "fp")


def one_of_each(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """docs with one row of each group of near-duplicates, that of smallest doc_id; its columns are unchanged.

    Each row counts by its own text, so rows that share a doc_id may be of several groups. Of a group's rows with that
    doc_id the one of smallest fingerprint and text hash stays. Rows without a doc_id stay.
    """
    key, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    numbered = materialise(docs.withColumn("__row", F.monotonically_increasing_id()))
    marked = materialise(fingerprints(numbered.select(F.col("__row").alias("doc_id"), "text"), words))
    classes = materialise(grouped(marked, distance).select(F.col("doc_id").alias("__row"), "fp", "component_id"))
    own = numbered.where(key.isNotNull()).select("__row", key.alias("id"), F.xxhash64(text).alias("hash"))
    order = F.struct("id", "fp", "hash", "__row")
    first = classes.join(own, "__row").groupBy("component_id").agg(F.min(order).alias("first"))
    kept = materialise(first.select(F.col("first.__row").alias("__row")))
    gone = materialise(own.select("__row").join(kept, "__row", "left_anti"))
    return numbered.join(gone, "__row", "left_anti").select(*[F.col(f"`{n}`") for n in docs.columns])
