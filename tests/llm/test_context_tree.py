import math
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from ledgerlight.llm import context_tree as tree
from ledgerlight.llm.keytable import KeyTable

DEPTH = tree.DEPTH


def bits(symbol):
    return [((1 << k) | (symbol >> (8 - k)), symbol >> (7 - k) & 1) for k in range(8)]


class Plain:
    """The same model by recursion over dictionaries."""

    def __init__(self, texts):
        self.n = defaultdict(lambda: [0, 0])
        self.below = defaultdict(set)
        for text in texts:
            raw = bytes(DEPTH) + text.encode().lower() + b"\0"
            for i in range(DEPTH, len(raw)):
                for depth in range(DEPTH + 1):
                    context = raw[i - depth:i]
                    for node, bit in bits(raw[i]):
                        self.n[context, node][bit] += 1
                        if depth:
                            self.below[context[1:], node].add(context)
        self.kept = {}

    def kt(self, zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.log(math.pi) - math.lgamma(zeros + ones + 1)

    def weighted(self, context, node):
        if (context, node) not in self.kept:
            own = self.kt(*self.n[context, node])
            if len(context) < DEPTH:
                rest = sum(self.weighted(c, node) for c in self.below[context, node])
                own = np.logaddexp(math.log(0.5) + own, math.log(0.5) + rest)
            self.kept[context, node] = own
        return self.kept[context, node]

    def p_one(self, context, node):
        p = None
        for depth in range(DEPTH, -1, -1):
            short = context[DEPTH - depth:]
            if (short, node) not in self.n:
                continue
            zeros, ones = self.n[short, node]
            own = (ones + 0.5) / (zeros + ones + 1)
            if p is None:
                p = own
            else:
                share = math.exp(math.log(0.5) + self.kt(zeros, ones) - self.weighted(short, node))
                p = share * own + (1 - share) * p
        return 0.5 if p is None else p

    def score(self, text):
        raw, total = bytes(DEPTH) + text.encode().lower() + b"\0", 0.0
        for i in range(DEPTH, len(raw)):
            total += self.chance(raw[i - DEPTH:i], raw[i])
        return total

    def chance(self, context, symbol):
        return sum(math.log10(p if bit else 1 - p) for node, bit in bits(symbol) for p in [self.p_one(context, node)])


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 10 == 0


@pytest.fixture(scope="module")
def small(spark):
    texts = ["the cat sat", "The cat ran", "", "a bat sat on the mat", "été été", "zzzz", "the the the", None] * 3
    rows = [(i, t) for i, t in enumerate(texts)]
    assert any(held(i) for i, _ in rows)
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_scores_by_brute_force(small):
    rows, docs = small
    model = Plain([t or "" for i, t in rows if not held(i)])
    found = {r["doc_id"]: r for r in tree.scores(docs).collect()}
    words = [w for i, t in rows if not held(i) for w in [*(t or "").lower().split(), None]]
    count = {w: words.count(w) for w in words}
    for i, text in rows:
        r = found[i]
        assert r["held_out"] == held(i) and math.isclose(r["score"], model.score(text or ""), rel_tol=1e-9)
        own = [*(text or "").lower().split(), None]
        base = sum(math.log10((count.get(w, 0) + 0.1) / (len(words) + 0.1 * (len(count) + 1))) for w in own)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in count for w in own), len(words))
        symbols = len((text or "").encode()) + 1
        assert math.isclose(r["bits_per_byte"], -r["score"] / math.log10(2) / symbols, rel_tol=1e-9)


def test_probabilities_of_all_bytes_add_up_to_one(small):
    rows, _ = small
    model = Plain([t or "" for i, t in rows if not held(i)])
    for context in (b"\0\0\0\0\0", b"e cat", b"qqqqq", b"he ca"):
        assert math.isclose(sum(10 ** model.chance(context, s) for s in range(256)), 1, rel_tol=1e-9)


def test_long_texts_are_scored_in_parts(monkeypatch):
    raw = b"some text that repeats itself. " * 20
    whole, _ = tree.grams_of([raw])
    monkeypatch.setattr(tree, "PART_BYTES", 37)
    assert np.concatenate(list(tree.grams_in_parts(raw))).tolist() == whole.tolist()
    assert np.concatenate(list(tree.grams_in_parts(b""))).tolist() == [0]


def test_log_kt_against_the_gamma_function():
    zeros, ones = np.array([0, 1, 7, 4095, 4096, 5000, 10**7]), np.array([0, 0, 3, 5, 4097, 1, 10**6])
    wanted = [
        math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1) for a, b in zip(zeros, ones)
    ]
    assert np.allclose(tree.log_kt(zeros, ones), wanted, rtol=1e-10, atol=1e-9)


def test_key_tables_hold_what_they_take():
    picked = np.random.default_rng(2)
    table, seen = KeyTable(4), {}
    for _ in range(30):
        keys = picked.integers(-50, 3000, 400) * picked.choice([1, 1 << 33])
        for key, place in zip(keys.tolist(), table.places(keys).tolist()):
            assert seen.setdefault(key, place) == place
    assert sorted(seen.values()) == list(range(table.count)) and (table.find(np.array([-10**9, 10**15])) == -1).all()


def test_documents_gain_from_context(some_docs):
    rows = tree.scores(some_docs).toPandas()
    assert len(rows) == some_docs.count() and (rows.score < 0).all()
    assert rows[rows.held_out].bits_per_byte.mean() < 4


def test_odd_documents(odd_docs, no_docs):
    rows = tree.scores(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(np.isfinite(r["score"]) and np.isfinite(r["base_score"]) for r in rows)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[7]["n_tokens"] == 500_001 and by_id[3]["n_tokens"] == by_id[4]["n_tokens"] == 1
    assert tree.scores(no_docs).count() == 0


def test_groups_without_training_text():
    part = pd.DataFrame({"gram": np.array([5, 6]), "n": np.array([0, 0])})
    assert len(tree.top_nodes(part)) == 0
    root = tree.Root([])
    assert np.allclose(tree.probabilities(part, root)["p"], 8 * math.log10(0.5))


def test_counts_put_out_early_give_the_same_scores(small, monkeypatch):
    _, docs = small
    whole = {r["doc_id"]: r["score"] for r in tree.scores(docs).collect()}
    monkeypatch.setattr(tree, "HELD_GRAMS", 5)
    monkeypatch.setattr(tree, "MOST_LABELS", 0)
    again = {r["doc_id"]: r["score"] for r in tree.scores(docs).collect()}
    assert again.keys() == whole.keys() and all(math.isclose(again[i], whole[i], rel_tol=1e-12) for i in whole)


def test_labels_deal_every_bucket_apart(spark):
    from pyspark.sql import functions as F

    labels = tree.even_labels(spark, 12)
    table = spark.createDataFrame([(x,) for x in labels], "x int").repartition(12, "x")
    assert len(labels) == 12 and table.select(F.spark_partition_id().alias("p")).distinct().count() == 12
