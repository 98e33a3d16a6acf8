import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerlight.llm import ranked_search as rs

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain(docs, items, k):
    """Every document scored for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id, score))
        best = sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(item_id, rank, doc_id, score) for rank, (_, _, doc_id, score) in enumerate(best, start=1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


def test_documents_by_brute_force(spark, folder, some_docs):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    wanted = plain(pairs(some_docs, "doc_id"), pairs(items, "item_id"), 10)
    assert rows(rs.top_documents(some_docs, items)) == wanted
    # many small blocks, several blocks of items
    index = rs.build_index(some_docs.repartition(20), block_bytes=4_000)
    assert rows(rs.search(index, items)) == wanted


def test_items_go_through_in_blocks(spark, some_docs, folder, monkeypatch):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    wanted = rows(rs.top_documents(some_docs, items, k=3))
    monkeypatch.setattr(rs.items_in_blocks, "__defaults__", (2_000,))
    assert rows(rs.top_documents(some_docs, items, k=3)) == wanted


def searched(blocks, item, k, totals, floor=0):
    searcher = rs.Searcher([item], k, *totals, np.array([floor]))
    for block in blocks:
        searcher.add(block.row(False))
    found = searcher.rows()
    return searcher, list(zip(found["score"].tolist(), found["doc_id"].tolist()))


def test_accumulators_stop_without_loss():
    random = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    odds = 1 / np.arange(1, 61)
    docs = [" ".join(random.choice(words, 30, p=odds / odds.sum())) for _ in range(4_000)]
    blocks = [rs.Block() for _ in range(4)]
    for i, text in enumerate(docs):
        blocks[i % 4].add(i, text)
    df = Counter(t for d in docs for t in set(d.split()))
    order = sorted(["w0", "w1", "w2", "w40", "w55", "w59"], key=lambda t: df[t])
    item = rs.Item([t.encode() for t in order], [rs.weight(4_000, df[t]) for t in order])
    searcher, found = searched(blocks, item, 10, (4_000, 30 * 4_000))
    best = sorted(found, key=lambda f: (-f[0], f[1]))
    assert [(f[1], f[0]) for f in best] == [(d, s) for _, _, d, s in plain(list(enumerate(docs)), [(0, " ".join(order))], 10)] or (
        sorted(best) == sorted((s, d) for _, _, d, s in plain(list(enumerate(docs)), [(0, " ".join(order))], 10))
    )
    any_term = sum(bool(set(d.split()) & set(order)) for d in docs)
    assert searcher.opened < any_term / 2
    # a floor that ten documents reach opens fewer still and loses none of them
    again, same = searched(blocks, item, 10, (4_000, 30 * 4_000), floor=min(s for s, _ in best))
    assert sorted(same) == sorted(best) and again.opened <= searcher.opened


def test_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(i, "Same words here") for i in range(40, 0, -1)] + [(99, "other")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "same"), (1, "same"), (2, "nothing"), (3, None), (None, "OTHER other")], "item_id int, text string")
    found = rows(rs.search(rs.build_index(docs.repartition(7), block_bytes=100), items, k=5))
    assert [r[:3] for r in found if r[0] == 1] == [(1, n, n) for n in range(1, 6) for _ in range(2)]
    assert [r[:3] for r in found if r[0] is None] == [(None, 1, 99)] and len(found) == 11


def test_odd_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "quick fox 日本語 ünïcödé"), (2, "word no id a b"), (3, "x" * 30_000), (4, "")], "item_id long, text string")
    wanted = plain(pairs(odd_docs, "doc_id"), pairs(items, "item_id"), 10)
    found = rs.top_documents(odd_docs, items.withColumn("score", F.lit(1)))
    assert rows(found) == wanted and any(r[2] is None for r in wanted)
    assert rs.top_documents(no_docs, items).collect() == []
    assert rs.top_documents(odd_docs, items.limit(0)).collect() == []
    assert rs.top_documents(odd_docs.where("doc_id = 3"), items).collect() == []


def test_terms():
    for text in ("", "a", "A-b_c", "É x\x7fY z{0}9", "日本 語 x", "a\x00b", "`~AZaz09@[:/"):
        assert sorted(rs.counted(text).elements()) == sorted(t.encode() for t in terms(text))
