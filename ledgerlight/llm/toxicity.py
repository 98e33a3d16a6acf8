"""Toxicity by nearest labelled examples: exact cosine of whole texts, distance-weighted votes.

The vocabulary is every word of the examples. A word weighs by its document frequency, counted over all documents, and
more if it marks toxic examples; none is left out. Examples of equal vectors are one entry that counts as many. Every
text is compared with every entry: the words that most entries hold by a matrix product, the others by inverted lists.
That product is of single precision and only bounds the similarities; the entries that may be among the nearest are
compared again in double precision. Every entry as near as the last one needed votes too, so ties need no order. A
logistic curve fitted to leave-one-out votes of all examples turns votes into probabilities.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm.common import CHUNK_CHARS, byte_runs, crc32_mod, release, texts
from ledgerlight.llm.pretokens import distinct, split
from ledgerlight.session import materialise

MAX_EXAMPLES = 20_000
NEAREST = 25
CLOSENESS = 0.1
PRIOR_WEIGHT = 3.0
FOLDS = 5
BUCKETS = 1 << 20
DENSE_WORDS = 512
QUERIES_AT_ONCE = 64
HASHED_AT_ONCE = 10_000
POSTS_AT_ONCE = 1 << 18
# far beyond the rounding of sums in single precision
ROUNDING = 1e-4


def words_of(batch: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-case words; for every word its index among them and the text it is in."""
    pieces = split([t.lower() for t in batch], keep_space=False)
    words, index = distinct(pieces)
    return words, index, pieces.owner


def counted(owner: np.ndarray, index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ``size`` texts: where each one's distinct words begin, the words in order, how often each occurs."""
    pairs, times = np.unique(owner * (1 << 32) + index, return_counts=True)
    return np.searchsorted(pairs >> 32, np.arange(size + 1)), pairs & 0xFFFFFFFF, times


class Places:
    """The place of each word, in a tenth of a dict's room: words in one array, found by their sorted hashes."""

    def __init__(self, words: pa.Array):
        self.words = words
        hashes = np.empty(len(words), np.int64)
        for start in range(0, len(words), HASHED_AT_ONCE):
            some = words.slice(start, HASHED_AT_ONCE).to_pylist()
            hashes[start:start + len(some)] = np.fromiter(map(hash, some), np.int64, len(some))
        self.order = np.argsort(hashes, kind="stable").astype(np.int32)
        self.hashes = hashes[self.order]
        twice = np.flatnonzero(self.hashes[1:] == self.hashes[:-1])
        # words that share their hash with another one
        self.twins = {words[i].as_py(): i for i in self.order[np.union1d(twice, twice + 1)].tolist()}

    def __reduce__(self) -> tuple:
        # hashes of texts differ from process to process
        return Places, (self.words,)

    def __len__(self) -> int:
        return len(self.words)

    def __iter__(self) -> Iterator[str]:
        return iter(self.words.to_pylist())

    def find(self, words: list[str]) -> np.ndarray:
        """The place of each of these words, -1 for those that have none."""
        if not len(self.words) or not words:
            return np.full(len(words), -1, np.int64)
        hashes = np.fromiter(map(hash, words), np.int64, len(words))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        like = np.flatnonzero(self.hashes[at] == hashes)
        there = self.order[at[like]].astype(np.int64)
        same = pa.compute.equal(self.words.take(pa.array(there)), pa.array(words, pa.string()).take(pa.array(like)))
        out = np.full(len(words), -1, np.int64)
        out[like] = np.where(same.to_numpy(zero_copy_only=False), there, -1)
        if self.twins:
            out = np.array([self.twins.get(w, i) for w, i in zip(words, out.tolist())], np.int64)
        return out


def known_words(batch: list[str], places: Places) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words that have a place: as ``counted`` gives them."""
    words, index, owner = words_of(batch)
    index = places.find(words)[index] if words else index
    return counted(owner[index >= 0], index[index >= 0], len(batch))


def word_counts(docs: DataFrame) -> DataFrame:
    """(toxic, words, times): the distinct words of each text and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in byte_runs(batch.column("text"), CHUNK_CHARS):
                part = batch.slice(first, last - first)
                words, index, owner = words_of(part.column("text").to_pylist())
                offsets, word, times = counted(owner, index, part.num_rows)
                offsets = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), pa.ListArray.from_arrays(offsets, pa.array(words, pa.string()).take(pa.array(word))),
                     pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                    names=["toxic", "words", "times"],
                )
        release()

    return docs.select("toxic", "text").mapInArrow(run, "toxic int, words array<string>, times array<int>")


def placed_words(examples: DataFrame, places: Broadcast) -> DataFrame:
    """(toxic, words, times) with words as their places, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, times, offsets = flat(batch.column("words"), batch.column("times"))
            ids = places.value.find(words.to_pylist())
            order = np.lexsort((ids, np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))))
            at = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.ListArray.from_arrays(at, pa.array(ids[order], pa.int32())),
                 pa.ListArray.from_arrays(at, times.take(pa.array(order)))],
                names=["toxic", "words", "times"],
            )

    return examples.mapInArrow(run, "toxic int, words array<int>, times array<int>")


def flat(words: pa.ListArray, times: pa.ListArray) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """The values of two list columns of equal lengths, and where each row's begin."""
    sizes = pa.compute.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    return words.flatten(), times.flatten(), np.concatenate(([0], np.cumsum(sizes)))


def document_frequencies(docs: DataFrame, places: Broadcast) -> tuple[np.ndarray, int]:
    """In how many documents each placed word occurs, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(len(places.value), np.int64), 0
        for batch in batches:
            for first, last in byte_runs(batch.column("text"), CHUNK_CHARS):
                _, word, _ = known_words(batch.column("text").slice(first, last - first).to_pylist(), places.value)
                found += np.bincount(word, minlength=len(found))
            rows += batch.num_rows
        seen = np.flatnonzero(found)
        for start in range(0, len(seen), BUCKETS):
            some = seen[start:start + BUCKETS]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(found[some])], names=["word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([rows], pa.int64())], names=["word", "n"])
        release()

    counts = docs.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    word, n = counts["word"].to_numpy(), counts["n"].to_numpy()
    out = np.zeros(len(places.value), np.int64)
    out[word[word >= 0]] = n[word >= 0]
    return out, int(n[word < 0].sum())


def bounded_examples(labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, toxic) of at most about ``most`` rows, those of smallest hash; one row for each doc_id.

    A document is toxic if any of its labels says so; null ids and labels are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic is not null").where(crc32_mod("doc_id", FOLDS) != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    if total > most:
        # a margin of four deviations keeps the bound
        share = (most - 4 * math.sqrt(most)) / total
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)) < int(share * BUCKETS))
    return known


def emphasis(toxic: np.ndarray, found: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """A factor of at least one for each word: one and the square of the two-sample z by which it marks toxic examples."""
    share = found / max(n_toxic + n_clean, 1)
    gap = toxic / max(n_toxic, 1) - (found - toxic) / max(n_clean, 1)
    spread = np.sqrt(share * (1 - share) * (1 / max(n_toxic, 1) + 1 / max(n_clean, 1)))
    return 1 + np.maximum(gap / (spread + 1e-12), 0) ** 2 if n_toxic and n_clean else np.ones(len(found))


@dataclass(frozen=True)
class Index:
    """Entries as sparse unit vectors; by word, the matrix of those most entries hold and the lists of the others."""

    idf: np.ndarray
    starts: np.ndarray
    ids: np.ndarray
    times: np.ndarray
    logs: np.ndarray
    lengths: np.ndarray
    column: np.ndarray
    matrix: np.ndarray
    cuts: np.ndarray
    places: np.ndarray
    posts: np.ndarray
    size: np.ndarray
    toxic: np.ndarray
    prior: float

    @property
    def values(self) -> np.ndarray:
        """What each entry's words weigh in it."""
        return self.values_at(np.arange(len(self.ids)), np.repeat(self.lengths, np.diff(self.starts)))

    def values_at(self, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """As ``weights`` gives them; made anew for the few entries that need them, as they would fill much memory."""
        return self.logs[self.times[at]] * self.idf[self.ids[at]] / lengths


def weights(ids: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vector of (1 + log tf) idf."""
    raw = (1 + np.log(times)) * idf[ids]
    length = math.sqrt(float(raw @ raw))
    return raw / length if length else raw


@dataclass(frozen=True)
class Entries:
    """What an index is made from, in little room: pickled, it is compressed, and unpickled, it is the index."""

    idf: np.ndarray
    sizes: np.ndarray
    ids: np.ndarray
    times: np.ndarray
    size: np.ndarray
    toxic: np.ndarray
    prior: float

    def __reduce__(self) -> tuple:
        steps = np.diff(self.ids, prepend=np.int32(0))
        small = [pa.compress(x.astype(np.int32).tobytes(), "zstd", asbytes=True) for x in (steps, self.times)]
        return opened, (*small, len(self.ids), self.idf, self.sizes, self.size, self.toxic, self.prior)


def opened(steps: bytes, times: bytes, n: int, idf: np.ndarray, sizes: np.ndarray, size: np.ndarray, toxic: np.ndarray, prior: float) -> Index:
    def numbers(x: bytes) -> np.ndarray:
        return np.frombuffer(pa.decompress(x, 4 * n, "zstd", asbytes=True), np.int32)

    often = numbers(times)
    often = often.astype(np.min_scalar_type(often.max(initial=0)))
    return index_of(Entries(idf, sizes, np.cumsum(numbers(steps), dtype=np.int32), often, size, toxic, prior))


def entries_of(vectors: list[tuple], idf: np.ndarray, prior: float) -> Entries:
    """Entries from (ids, times, label) of the examples that have any word; equal vectors become one."""
    tally: dict[tuple[bytes, bytes], list[int]] = {}
    for ids, times, label in vectors:
        if len(ids):
            # big-endian bytes sort as the numbers do
            entry = tally.setdefault((np.asarray(ids, ">u4").tobytes(), np.asarray(times, ">u4").tobytes()), [0, 0])
            entry[0] += 1
            entry[1] += label
    entries = sorted(tally)
    ids, times = (np.frombuffer(b"".join(e[k] for e in entries), ">u4").astype(np.int32) for k in (0, 1))
    sizes = np.array([len(ids) // 4 for ids, _ in entries], np.int64)
    size = np.array([tally[e][0] for e in entries], np.int64)
    toxic = np.array([tally[e][1] for e in entries], np.int64)
    return Entries(idf, sizes, ids, times, size, toxic, prior)


def build_index(vectors: list[tuple], idf: np.ndarray, prior: float) -> Index:
    return index_of(entries_of(vectors, idf, prior))


def index_of(e: Entries) -> Index:
    idf, sizes, ids = e.idf, e.sizes, e.ids
    starts = np.concatenate(([0], np.cumsum(sizes)))
    logs = 1 + np.log(np.maximum(np.arange(int(e.times.max(initial=0)) + 1), 1))
    values, lengths = np.empty(len(ids), np.float32), np.ones(len(sizes))
    for k, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        raw = logs[e.times[a:b]] * idf[ids[a:b]]
        lengths[k] = math.sqrt(float(raw @ raw)) or 1.0
        values[a:b] = raw / lengths[k]
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    found = np.bincount(ids, minlength=len(idf))
    column = np.full(len(idf), -1, np.int32)
    often = np.argsort(-found, kind="stable")[:DENSE_WORDS]
    column[often] = np.arange(len(often))
    matrix = np.zeros((len(often), len(sizes)), np.float32)
    held = column[ids] >= 0
    matrix[column[ids[held]], owner[held]] = values[held]
    other = np.flatnonzero(~held).astype(np.int32)
    other = other[np.argsort(ids[other], kind="stable").astype(np.int32)]
    cuts = np.concatenate(([0], np.cumsum(np.bincount(ids[other], minlength=len(idf)))))
    made = Index(
        idf, starts, ids, e.times, logs, lengths, column, matrix, cuts, owner[other], values[other], e.size, e.toxic, e.prior,
    )
    release()
    return made


def similarities(index: Index, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Single-precision similarity of each of a few vectors with every entry."""
    m = len(index.size)
    row = np.repeat(np.arange(len(vectors)), [len(ids) for ids, _ in vectors])
    ids = np.concatenate([ids for ids, _ in vectors])
    values = np.concatenate([values for _, values in vectors]).astype(np.float32)
    held = index.column[ids] >= 0
    dense = np.zeros((len(vectors), len(index.matrix)), np.float32)
    dense[row[held], index.column[ids[held]]] = values[held]
    out = dense @ index.matrix
    summed = out.reshape(-1)
    row, ids, values = row[~held], ids[~held], values[~held]
    first = index.cuts[ids]
    n = index.cuts[ids + 1] - first
    total = np.cumsum(n)
    start = 0
    while start < len(ids):
        before = total[start - 1] if start else 0
        end = max(int(np.searchsorted(total, before + POSTS_AT_ONCE, side="right")), start + 1)
        some = n[start:end]
        at = np.arange(int(some.sum())) + np.repeat(first[start:end] - (np.cumsum(some) - some), some)
        np.add.at(
            summed, np.repeat(row[start:end] * m, some) + index.places[at], np.repeat(values[start:end], some) * index.posts[at],
        )
        start = end
    return out


def chosen(index: Index, near_by: np.ndarray, scratch: np.ndarray, ids: np.ndarray, vector: np.ndarray, needed: int):
    """``nearest`` of one vector whose similarities are known in single precision; scratch is all zeros before and after."""
    least = np.partition(near_by, len(near_by) - needed)[len(near_by) - needed] if needed <= len(near_by) else 0.0
    entries = np.flatnonzero((near_by > 0) & (near_by >= least - ROUNDING))
    if not len(entries):
        return entries, np.empty(0)
    first, n = index.starts[entries], index.starts[entries + 1] - index.starts[entries]
    begin = np.cumsum(n) - n
    at = np.arange(int(n.sum())) + np.repeat(first - begin, n)
    scratch[ids] = vector
    near = np.add.reduceat(scratch[index.ids[at]] * index.values_at(at, np.repeat(index.lengths[entries], n)), begin)
    scratch[ids] = 0
    order = np.argsort(-near, kind="stable")
    last = int(np.searchsorted(np.cumsum(index.size[entries[order]]), needed))
    if last < len(order):
        keep = near >= near[order[last]] - 1e-9
        entries, near = entries[keep], near[keep]
    return entries, near


def nearest(index: Index, ids: np.ndarray, vector: np.ndarray, needed: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries and similarities of the ``needed`` nearest examples and of all that tie with the last one."""
    return chosen(index, similarities(index, [(ids, vector)])[0], np.zeros(len(index.idf)), ids, vector, needed)


def votes(index: Index, texts: list[tuple], left_out: list[int] | None = None) -> list[tuple[float, list[tuple[float, int, int]]]]:
    """For each text's (ids, times): the share of toxic votes, nearer examples weighing more, and the evidence as
    (similarity, examples, toxic ones).

    ``left_out`` are the labels of one example of each very vector that must not vote.
    """
    made: list[tuple[float, list[tuple[float, int, int]]]] = [(index.prior, [])] * len(texts)
    full = [i for i, (ids, _) in enumerate(texts) if len(ids)] if len(index.size) else []
    scratch = np.zeros(len(index.idf))
    for start in range(0, len(full), QUERIES_AT_ONCE):
        some = full[start:start + QUERIES_AT_ONCE]
        vectors = [(texts[i][0], weights(*texts[i], index.idf)) for i in some]
        for i, near_by, (ids, vector) in zip(some, similarities(index, vectors), vectors):
            entries, near = chosen(index, near_by, scratch, ids, vector, NEAREST + (left_out is not None))
            size, toxic = index.size[entries].astype(float), index.toxic[entries].astype(float)
            evidence = [(round(float(s), 6), int(n), int(t)) for s, n, t in sorted(zip(near, size, toxic), reverse=True)[:5]]
            if left_out is not None and len(near):
                own = int(np.argmax(near))
                size[own] -= 1
                toxic[own] -= left_out[i]
            weight = near / (np.maximum(1 - near, 0) + CLOSENESS)
            share = (float(weight @ toxic) + PRIOR_WEIGHT * index.prior) / (float(weight @ size) + PRIOR_WEIGHT)
            made[i] = share, evidence
    return made


def logit(p: np.ndarray | float) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_curve(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the log odds of the votes; Newton steps with a small penalty."""
    x = logit(votes)
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.array([1.0, 0.0])
    penalty = np.diag([1e-2, 1e-2])
    centre = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - labels) + penalty @ (beta - centre)
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, gradient)
        beta = beta - step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


@dataclass(frozen=True)
class Model:
    """Words with their places, index and curve; everything in it is bounded by the examples."""

    places: Broadcast
    index: Broadcast
    slope: float
    offset: float

    def score(self, share: float) -> float:
        return float(1 / (1 + math.exp(-max(min(self.slope * float(logit(share)) + self.offset, 30.0), -30.0))))

    def judge(self, batch: list[str], known: dict[bytes, tuple[float, str]]) -> list[tuple[float, str]]:
        """Score and evidence of each text; known keeps those of vectors met before."""
        offsets, word, times = known_words(batch, self.places.value)
        texts = [(word[a:b], times[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        keys = [hashlib.blake2b(ids.tobytes() + n.tobytes(), digest_size=16).digest() for ids, n in texts]
        if len(known) > 20_000:
            known.clear()
        new = {k: t for k, t in zip(keys, texts) if k not in known}
        for k, (share, evidence) in zip(new, votes(self.index.value, list(new.values()))):
            known[k] = self.score(share), ";".join(f"{s}:{n}:{t}" for s, n, t in evidence)
        return [known[k] for k in keys]


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> Model:
    """The model; ``most`` bounds the labelled rows that are learned from, document frequencies cover all documents."""
    context = docs.sparkSession.sparkContext
    known = bounded_examples(labels, most)
    examples = materialise(word_counts(texts(docs).join(F.broadcast(known), "doc_id")))
    words = sorted(examples.select(F.explode("words").alias("word")).distinct().toArrow()["word"].to_pylist())
    places = context.broadcast(Places(pa.array(words, pa.string())))
    in_docs, total = document_frequencies(texts(docs), places)
    learned = materialise(placed_words(examples, places))
    n_words = len(words)
    del words
    table = learned.toArrow().combine_chunks()
    toxic = (table["toxic"].to_numpy() != 0).astype(np.int64)
    columns = [pa.concat_arrays(table[n].chunks) if len(toxic) else pa.array([], table[n].type) for n in ("words", "times")]
    del table
    ids, times, offsets = flat(*columns)
    # as they came, in four bytes each: copies of all entries are what takes room in the driver
    ids, times = ids.to_numpy(), times.to_numpy()
    n_toxic = int(toxic.sum())
    n_clean = len(toxic) - n_toxic
    found = np.bincount(ids, minlength=n_words)
    marked = np.bincount(ids[np.repeat(toxic.astype(bool), np.diff(offsets))], minlength=n_words)
    idf = (1 + np.log((1 + total) / (1 + in_docs))) * emphasis(marked, found, n_toxic, n_clean)
    vectors = [(ids[a:b], times[a:b], t) for a, b, t in zip(offsets[:-1].tolist(), offsets[1:].tolist(), toxic.tolist())]
    index = context.broadcast(entries_of(vectors, idf, (n_toxic + 0.05) / (len(toxic) + 1.0)))
    del vectors, ids, times, columns
    release()
    if not (n_toxic and n_clean):
        return Model(places, index, 1.0, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, times, offsets = flat(batch.column("words"), batch.column("times"))
            ids, times = ids.to_numpy().astype(np.int64), times.to_numpy().astype(np.int64)
            label = [int(t != 0) for t in batch.column("toxic").to_pylist()]
            own = [(ids[a:b], times[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            shares = [share for share, _ in votes(index.value, own, label)]
            yield pa.RecordBatch.from_arrays([pa.array(shares, pa.float64()), pa.array(label, pa.int32())], names=["share", "toxic"])
        release()

    # in order, so that sums round alike
    told = learned.mapInArrow(run, "share double, toxic int").toArrow().sort_by([("share", "ascending"), ("toxic", "ascending")])
    return Model(places, index, *fit_curve(told["share"].to_numpy(), told["toxic"].to_numpy().astype(float)))


def scores(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence), one row for each row of docs.

    Scores depend on the text alone. held_out marks documents whose labels are never learned from. Null and empty
    texts, and texts that share no word with any example, get the share of toxic examples; without usable labels
    every score is low. Null keys keep their row; repeated rows score alike; an empty table gives none; other columns
    of docs and labels are not read. evidence lists the nearest groups of examples: similarity, examples, toxic.
    """
    model = fit(docs, labels, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[float, str]] = {}
        for batch in batches:
            for first, last in byte_runs(batch.column("text"), CHUNK_CHARS):
                part = batch.slice(first, last - first)
                made = model.judge(part.column("text").to_pylist(), known)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([s for s, _ in made], pa.float64()), pa.array([e for _, e in made], pa.string())],
                    names=["doc_id", "score", "evidence"],
                )
        release()

    scored = texts(docs).mapInArrow(run, "doc_id long, score double, evidence string")
    return scored.select(
        "doc_id", (crc32_mod("doc_id", FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """docs without the rows whose own text is predicted toxic, whatever their doc_id; columns unchanged."""
    model = fit(docs, labels, most)
    names = docs.columns
    # a copy of the texts beside them would fill much memory
    plain = isinstance(docs.schema["text"].dataType, T.StringType)
    whole = docs if plain else docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    source = "text" if plain else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[float, str]] = {}
        for batch in batches:
            for first, last in byte_runs(batch.column(source), CHUNK_CHARS):
                part = batch.slice(first, last - first)
                made = model.judge([t or "" for t in part.column(source).to_pylist()], known)
                yield part.filter(pa.array([s < 0.5 for s, _ in made], pa.bool_())).select(names)
        release()

    return whole.mapInArrow(run, docs.schema)
