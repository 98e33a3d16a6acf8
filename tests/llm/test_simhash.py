import random

import numpy as np
import xxhash

from ledgerlight.llm import simhash
from ledgerlight.llm.components import components


def plain_fingerprint(text, words=3):
    found = text.encode().lower().split()
    shingles = [b" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] or ([b" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, ids, distance=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(prints)):
        groups.setdefault(find(i), []).append(i)
    out = [None] * len(prints)
    for members in groups.values():
        least = min((ids[i] for i in members if ids[i] is not None), default=None)
        for i in members:
            out[i] = least
    return out


def test_fingerprints_by_brute_force(some_docs, odd_docs):
    texts = [r["text"] or "" for r in some_docs.limit(60).collect()] + ["", "One", "one TWO", "a b c", "É é É"]
    assert [int(x) & (1 << 64) - 1 for x in simhash.fingerprints_of(texts, 3)] == [plain_fingerprint(t) for t in texts]


def test_a_long_text_is_hashed_in_parts(monkeypatch):
    text = " ".join(random.Random(1).choices(["alpha", "beta", "gamma", "delta"], k=4000))
    whole = simhash.fingerprints_of([text], 3)
    monkeypatch.setattr(simhash, "PART_BYTES", 100)
    assert simhash.fingerprints_of([text], 3) == whole


def test_links_by_brute_force(spark):
    picked = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        centre = picked.getrandbits(64)
        for _ in range(8):
            value = centre
            for bit in picked.sample(range(64), picked.randrange(6)):
                value ^= 1 << bit
            prints.add(value)
    prints = np.array(sorted(prints), np.uint64)
    table = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    for distance in (0, 1, 2, 3, 5, 8):
        found = {tuple(sorted((r["a"], r["b"]))) for r in simhash.links(table, distance).collect()}
        assert simhash.links(table, distance).count() == len(found)
        signed = prints.view(np.int64)
        wanted = {
            tuple(sorted((int(signed[i]), int(signed[j])))) for i in range(len(prints)) for j in range(i)
            if int(np.bitwise_count(prints[i] ^ prints[j])) <= distance
        }
        assert found == wanted


def test_links_are_joined_by_shuffle(spark):
    # a table that Spark sizes as small before its rows are exploded
    plan = simhash.links(spark.range(100).withColumnRenamed("id", "fp"), 3)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_groups_by_brute_force(some_docs):
    rows = simhash.near_duplicates(some_docs).collect()
    texts = {r["doc_id"]: r["text"] for r in some_docs.collect()}
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{p:016x}" for i, p in zip(ids, prints)}
    assert {r["doc_id"]: r["component_id"] for r in rows} == dict(zip(ids, plain_components(prints, ids)))


def test_odd_documents(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == 1
    assert by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == "0" * 16
    assert by_id[3]["component_id"] == by_id[4]["component_id"] == by_id[5]["component_id"] == 3
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    left = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    assert left == [1, 3, 6, 7, 8, 9, None, None]
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def test_rows_that_share_an_id_leave_one(spark):
    docs = spark.createDataFrame([(1, "same words here"), (1, "same words here"), (2, "other words there")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect()) == [1, 2]


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 560)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(path + star + [(7, 7)], "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {i: 500 for i in range(500, 560)}


def test_each_row_counts_by_its_own_text(spark):
    near, other = "one two three four five six", "nothing here is alike at all"
    rows = [(1, near), (5, near), (5, other), (None, "a third text without id")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(2)
        left = {(r["doc_id"], r["text"]) for r in simhash.one_of_each(docs).collect()}
        assert left == {(1, near), (5, other), (None, "a third text without id")}
