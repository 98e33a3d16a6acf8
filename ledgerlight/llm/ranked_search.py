"""Ranked lexical search: exact top documents per item, term at a time, with a limited set of accumulators.

Documents are indexed in blocks: a block holds the postings of its documents, term by term. A search goes through the
terms of an item from the rarest to the commonest. A document's accumulator is opened by its first posting; once the
bounds of the terms still to come add up to less than the k-th best partial score, no more are opened, as a document met
only from there on can't reach the k-th place. Open accumulators are updated to the end, so their scores are exact.
The k-th best score carries on from block to block within a task; a first pass over some blocks gives all tasks a
score that k documents reach, so that later blocks open few accumulators and put out few rows.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight.llm.common import byte_runs, once, release, texts
from ledgerlight.session import materialise

BLOCK_BYTES = 16 << 20
QUERY_BYTES = 1 << 20
SEED_BLOCKS = 16
LAST_ID = np.iinfo(np.int64).max

INDEX = (
    "seed boolean, doc_ids binary, unnamed binary, lengths binary, documents long, length long, "
    "terms binary, ends binary, postings binary, occurrences binary"
)

#: Every ASCII character that is no letter or digit parts terms; A-Z become a-z; other bytes stay.
FOLD = bytes(
    ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else 32 if c < 128 else c
    for c in range(256)
)


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split(b" ") if text else []


def counted(text: str) -> Counter:
    found = Counter(terms_of(text))
    del found[b""]
    return found


class Block:
    """Postings of some documents, gathered text by text."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.terms: list[np.ndarray] = []
        self.occurrences: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_id: int | None, text: str) -> None:
        found, vocabulary = counted(text), self.vocabulary
        self.bytes += len(text) + 64
        if not found:
            return
        self.ids.append(doc_id)
        tf = np.fromiter(found.values(), np.int32, len(found))
        self.lengths.append(int(tf.sum()))
        self.terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in found], np.int32))
        self.occurrences.append(tf)

    def row(self, seed: bool) -> dict[str, object]:
        """The block as one row: terms in byte order, the documents of a term in the order they came."""
        names = sorted(self.vocabulary)
        place = np.empty(len(names), np.int32)
        place[[self.vocabulary[t] for t in names]] = np.arange(len(names), dtype=np.int32)
        sizes = [len(t) for t in self.terms]
        terms = place[np.concatenate(self.terms)] if sizes else np.empty(0, np.int32)
        docs = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        order = np.argsort(terms, kind="stable")
        tf = np.concatenate(self.occurrences) if sizes else np.empty(0, np.int32)
        return {
            "seed": seed,
            "doc_ids": np.array([LAST_ID if i is None else i for i in self.ids], np.int64).tobytes(),
            "unnamed": np.array([i is None for i in self.ids], bool).tobytes(),
            "lengths": np.array(self.lengths, np.int64).tobytes(),
            "documents": len(self.ids),
            "length": sum(self.lengths),
            "terms": b"\n".join(names),
            "ends": np.cumsum(np.bincount(terms, minlength=len(names))).astype(np.int32).tobytes(),
            "postings": docs[order].tobytes(),
            "occurrences": tf[order].tobytes(),
        }


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of about block_bytes of text: every term of every whole text. A block never spans tasks."""
    schema = pa.schema([
        ("seed", pa.bool_()), *[(n, pa.binary()) for n in ("doc_ids", "unnamed", "lengths")],
        ("documents", pa.int64()), ("length", pa.int64()),
        *[(n, pa.binary()) for n in ("terms", "ends", "postings", "occurrences")],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        number, block = context.partitionId() if context else 0, Block()
        made = 0

        def put_out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([block.row(made == 0 and number % SEED_BLOCKS == 0)], schema)

        for batch in batches:
            for start, end in byte_runs(batch.column("text"), 1 << 20):
                part = batch.slice(start, end - start)
                for doc_id, whole in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    block.add(doc_id, whole)
                    if block.bytes >= block_bytes:
                        yield put_out()
                        made, block = made + 1, Block()
        if block.ids:
            yield put_out()
        block = Block()
        release()

    return texts(docs, key, text).mapInArrow(run, INDEX)


@dataclass
class Item:
    """An item's terms, rarest first, with what each is worth."""

    terms: list[bytes]
    weights: list[int]


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def items_in_blocks(items: DataFrame, key: str, text: str, most: int = QUERY_BYTES) -> Iterator[list[tuple]]:
    """Lists of (item_id, counted terms) of bounded size; the items are read one partition at a time."""
    held, size = [], 0
    for row in items.select(F.col(f"`{key}`").alias("item_id"), F.col(f"`{text}`").cast("string").alias("text")).toLocalIterator():
        found = counted(row["text"] or "")
        held.append((row["item_id"], found))
        size += 64 + sum(len(t) + 64 for t in found)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def document_frequencies(index: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """In how many documents each of some terms occurs; only the index's terms and their ends are read."""
    wanted = index.sparkSession.sparkContext.broadcast(pickle.dumps(sorted(terms)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ours, total = pickle.loads(wanted.value), Counter()
        for batch in batches:
            for row in range(batch.num_rows):
                block = {n: batch.column(n)[row].as_py() for n in ("terms", "ends")}
                names, ends = terms_and_ends(block)
                for term, (start, end) in spans_of(names, ends, ours).items():
                    total[term] += end - start
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["term", "df"],
            )
        release()

    counts = index.select("terms", "ends").mapInArrow(run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    try:
        return {bytes(r["term"]): r["df"] for r in counts.collect()}
    finally:
        wanted.destroy()


def terms_and_ends(block: dict[str, bytes]) -> tuple[dict[bytes, int], np.ndarray]:
    names = block["terms"].split(b"\n") if block["terms"] else []
    return {t: i for i, t in enumerate(names)}, np.frombuffer(block["ends"], np.int32)


def spans_of(places: dict[bytes, int], ends: np.ndarray, terms: Iterable[bytes]) -> dict[bytes, tuple[int, int]]:
    """Where the postings of those terms lie that the block holds."""
    at = {t: places[t] for t in terms if t in places}
    return {t: (int(ends[i - 1]) if i else 0, int(ends[i])) for t, i in at.items()}


class Searcher:
    """Scores the blocks of a task, one after another, and keeps the k best documents of each item."""

    def __init__(self, items: list[Item], k: int, documents: int, length: int, floors: np.ndarray):
        self.items, self.k, self.documents, self.length = items, k, documents, length
        self.terms = sorted({t for item in items for t in item.terms})
        self.floors = floors.copy()  # a score that k documents are known to reach, by item
        self.best: list[list[np.ndarray]] = [
            [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)] for _ in items
        ]
        self.opened = self.met = 0

    def add(self, block: dict[str, bytes]) -> None:
        places, ends = terms_and_ends(block)
        spans = spans_of(places, ends, self.terms)
        if not spans:
            return
        lengths = np.frombuffer(block["lengths"], np.int64)
        ids, unnamed = np.frombuffer(block["doc_ids"], np.int64), np.frombuffer(block["unnamed"], bool)
        postings, occurrences = np.frombuffer(block["postings"], np.int32), np.frombuffer(block["occurrences"], np.int32)
        m = 100 - 75 + (75 * lengths * self.documents) // self.length
        lists = {}
        for term, (start, end) in spans.items():
            docs, tf = postings[start:end], occurrences[start:end].astype(np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[docs])
            lists[term] = docs, impact, int(impact.max())
        scores, open_ = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), bool)
        for number, item in enumerate(self.items):
            self.search(number, item, lists, scores, open_, ids, unnamed)

    def search(
        self, number: int, item: Item, lists: dict, scores: np.ndarray, open_: np.ndarray, ids: np.ndarray,
        unnamed: np.ndarray,
    ) -> None:
        mine = [(lists[t], w) for t, w in zip(item.terms, item.weights) if t in lists and w > 0]
        left = sum(entry[2] * w for entry, w in mine)
        survivors = np.empty(0, np.int32)
        creating = True
        for (docs, impact, highest), w in mine:
            if creating and left < self.reached(number, scores[survivors]):
                creating = False
                survivors.sort()
            if creating:
                fresh = docs[~open_[docs]]
                open_[fresh] = True
                survivors = np.concatenate([survivors, fresh])
                scores[docs] += w * impact
            else:
                if not len(survivors):
                    break
                at = np.searchsorted(docs, survivors)
                at[at == len(docs)] = 0
                hit = docs[at] == survivors
                scores[survivors[hit]] += w * impact[at[hit]]
            left -= highest * w
            self.met += len(docs)
        self.opened += len(survivors)
        found = survivors[scores[survivors] > 0]
        self.keep(number, scores[found], ids[found], unnamed[found])
        scores[survivors] = 0
        open_[survivors] = False

    def reached(self, number: int, partial: np.ndarray) -> int:
        """A score that k documents reach already: from before, or by the partial scores of this block."""
        if len(partial) < self.k:
            return int(self.floors[number])
        return max(int(self.floors[number]), int(np.partition(partial, len(partial) - self.k)[len(partial) - self.k]))

    def keep(self, number: int, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        enough = scores >= self.floors[number]
        old = self.best[number]
        joined = [np.concatenate([a, b[enough]]) for a, b in zip(old, (scores, ids, unnamed))]
        if len(joined[0]) > self.k:
            order = np.lexsort((joined[1], joined[2], -joined[0]))[: self.k]
            joined = [x[order] for x in joined]
        self.best[number] = joined
        if len(joined[0]) == self.k:
            self.floors[number] = max(self.floors[number], joined[0].min())

    def rows(self) -> dict[str, np.ndarray]:
        sizes = [len(b[0]) for b in self.best]
        joined = [np.concatenate([b[i] for b in self.best]) for i in range(3)] if sizes else self.best
        return {"item": np.repeat(np.arange(len(sizes)), sizes), "score": joined[0], "doc_id": joined[1], "unnamed": joined[2]}


def candidates(index: DataFrame, items: list[Item], k: int, documents: int, length: int, floors: np.ndarray) -> DataFrame:
    """(item, score, doc_id): the k best documents of each task that reach the item's floor."""
    sent = index.sparkSession.sparkContext.broadcast(pickle.dumps([(i.terms, i.weights) for i in items]))
    least = floors.tobytes()
    columns = ["lengths", "doc_ids", "unnamed", "terms", "ends", "postings", "occurrences"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ours = [Item(terms, weights) for terms, weights in pickle.loads(sent.value)]
        searcher = Searcher(ours, k, documents, length, np.frombuffer(least, np.int64))
        for batch in batches:
            for row in range(batch.num_rows):
                searcher.add({n: batch.column(n)[row].as_py() for n in columns})
        found = searcher.rows()
        ids = pa.array(found["doc_id"], pa.int64(), mask=found["unnamed"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(found["item"], pa.int32()), pa.array(found["score"], pa.int64()), ids], names=["item", "score", "doc_id"],
        )
        release()

    return index.select(*columns).mapInArrow(run, "item int, score long, doc_id long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, k: int = 10, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each item, by a written index.

    Items are taken in blocks of bounded size, each of which goes through the whole index.
    """
    spark = index.sparkSession
    kind = items.schema[key].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    totals = index.agg(F.sum("documents"), F.sum("length")).first()
    parts: list[DataFrame] = []
    if totals[0]:
        documents, length = totals
        for block in items_in_blocks(items, key, text):
            df = document_frequencies(index, {t for _, found in block for t in found})
            prepared = []
            for _, found in block:
                order = sorted((t for t in found if t in df), key=lambda t: (df[t], t))
                prepared.append(Item(order, [found[t] * weight(documents, df[t]) for t in order]))
            floors = np.zeros(len(block), np.int64)
            seeds = ranked(candidates(index.where("seed"), prepared, k, documents, length, floors), k)
            for row in seeds.where(F.col("rank") == k).select("item", "score").collect():
                floors[row["item"]] = row["score"]
            found = ranked(candidates(index, prepared, k, documents, length, floors), k)
            names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"item int, item_id {kind}")
            made = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
            parts.append(made if not parts else materialise(made))
    if not parts:
        return spark.createDataFrame([], schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def top_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of each item, scores above zero only.

    Null and empty texts have no terms: such documents count nowhere, such items have no rows. A document without a key
    takes part in all counts and ranks last among equal scores, its doc_id being null. Repeated rows are documents of their
    own; repeated items each get their rows. Equal scores go by ascending doc_id. An empty table on either side gives no
    rows; other columns are not read.
    """
    index = materialise(build_index(docs, key, text, block_bytes))
    return search(index, items, k, item_key, item_text)
