import math
import pickle
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerlight.llm import toxicity


@pytest.fixture(scope="module")
def labels(spark, folder):
    return spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.01')}/labels.parquet")


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.01')}/documents.parquet")


@pytest.fixture(scope="module")
def scored(docs, labels):
    return toxicity.scores(docs, labels).toPandas()


def test_every_document_has_a_score(scored, docs):
    assert sorted(scored.doc_id) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert scored.score.between(0, 1).all() and (scored.predicted == (scored.score >= 0.5)).all()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id]).all()


def test_held_out_labels_are_met(spark, folder):
    larger = folder.replace("sf0.001", "sf0.1")
    tables = [spark.read.parquet(f"{larger}/{name}.parquet") for name in ("documents", "labels")]
    known = toxicity.scores(*tables).toPandas()
    known = known[known.held_out].merge(tables[1].toPandas(), on="doc_id")
    assert len(known) > 700 and (known.predicted == known.toxic).mean() > 0.98
    toxic, clean = known[known.toxic == 1].score, known[known.toxic == 0].score
    assert np.mean([(t > clean).mean() + 0.5 * (t == clean).mean() for t in toxic]) > 0.95


def test_held_out_labels_are_not_read(docs, labels, scored):
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.crc32_mod("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.scores(docs, turned).toPandas()
    both = scored.merge(again, on="doc_id")
    assert np.allclose(both.score_x, both.score_y)


def test_block_bounds_find_what_brute_force_finds():
    picked = np.random.default_rng(4)
    idf = 1 + picked.random(40)
    vectors = []
    for _ in range(1500):
        ids = sorted(picked.choice(40, picked.integers(1, 6), replace=False).tolist())
        vectors.append((tuple(ids), tuple(picked.integers(1, 4, len(ids)).tolist()), int(picked.random() < 0.3)))
    index = toxicity.build_index(vectors, idf, 0.1)

    def dense(ids, times):
        out = np.zeros(40)
        out[list(ids)] = toxicity.weights(np.array(ids), np.array(times), idf)
        return out

    entries = sorted({(a, b) for a, b, _ in vectors})
    matrix = np.array([dense(*e) for e in entries])
    for ids, times, _ in vectors[:80]:
        query = dense(ids, times)
        near = matrix @ query
        order = np.argsort(-near)
        last = near[order[np.searchsorted(np.cumsum(index.size[order]), 25)]]
        found, scores = toxicity.nearest(index, np.array(ids), query[list(ids)], 25)
        assert sorted(found.tolist()) == np.flatnonzero(near >= last - 1e-9).tolist()
        assert np.allclose(scores, near[found])


def test_the_curve_keeps_the_order_and_the_share():
    picked = np.random.default_rng(1)
    votes = picked.random(4000)
    truth = (picked.random(4000) < votes**2).astype(float)
    slope, offset = toxicity.fit_curve(votes, truth)
    fitted = 1 / (1 + np.exp(-(slope * toxicity.logit(votes) + offset)))
    assert slope > 0 and math.isclose(fitted.mean(), truth.mean(), abs_tol=0.01)


def test_the_bound_on_examples(spark):
    many = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    assert 800 < toxicity.bounded_examples(many, 1000).count() <= 1000
    assert toxicity.bounded_examples(many.limit(100), 1000).count() <= 100


def test_odd_documents(spark, odd_docs, no_docs, labels):
    odd_labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (None, 1), (6, 0), (8, 0), (7, 0)], "doc_id long, toxic int",
    )
    rows = toxicity.scores(odd_docs, odd_labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.without_toxic(odd_docs, odd_labels).columns == odd_docs.columns
    assert toxicity.scores(no_docs, odd_labels).count() == 0
    unlabelled = toxicity.scores(odd_docs, labels.limit(0)).collect()
    assert all(r["predicted"] == 0 for r in unlabelled)


def test_the_filter_drops_what_is_predicted(docs, labels, scored):
    left = {r["doc_id"] for r in toxicity.without_toxic(docs, labels).select("doc_id").collect()}
    assert left == set(scored[scored.predicted == 0].doc_id)


def test_words_that_mark_no_label_find_neighbours(spark):
    """A text without any word that marks toxic examples is still compared with all examples."""
    picked = np.random.default_rng(8)
    rows, known = [], []
    for i in range(400):
        topic = "meadow river stone" if i % 2 else "engine piston valve"
        rows.append((i, f"{topic} word{picked.integers(50)} word{picked.integers(50)}" + " vile" * (i % 8 == 0)))
        known.append((i, int(i % 8 == 0)))
    rows += [(1000, "meadow river stone"), (1001, "engine piston"), (1002, "nothing known")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in toxicity.scores(docs, spark.createDataFrame(known, "doc_id long, toxic int")).collect()}
    assert found[1000]["evidence"] and found[1001]["evidence"] and not found[1002]["evidence"]
    assert all(0 < found[i]["score"] < 0.5 for i in (1000, 1001, 1002))


def test_every_word_of_the_examples_counts(spark, docs, labels):
    known = toxicity.bounded_examples(labels, toxicity.MAX_EXAMPLES)
    words, _, _ = toxicity.words_of([r["text"] or "" for r in docs.join(known, "doc_id").collect()])
    model = toxicity.fit(docs, labels)
    assert sorted(model.places.value) == sorted(words)
    index = pickle.loads(pickle.dumps(model.index.value))
    assert isinstance(index, toxicity.Index) and (index.idf >= 1).all() and len(np.unique(index.ids)) == len(words)


def test_whole_texts_find_what_brute_force_finds(monkeypatch):
    monkeypatch.setattr(toxicity, "DENSE_WORDS", 20)
    monkeypatch.setattr(toxicity, "POSTS_AT_ONCE", 500)
    picked = np.random.default_rng(9)
    idf = 1 + picked.random(900) * 3
    vectors = []
    for _ in range(700):
        ids = np.unique((900 * picked.random(picked.integers(5, 120)) ** 3).astype(int))
        vectors.append((ids, picked.integers(1, 9, len(ids)), int(picked.random() < 0.3)))
    index = toxicity.build_index(vectors, idf, 0.1)
    matrix = np.zeros((len(index.size), 900))
    matrix[np.repeat(np.arange(len(index.size)), np.diff(index.starts)), index.ids] = index.values
    assert len(index.size) == len({(tuple(a), tuple(b)) for a, b, _ in vectors})
    for ids, times, _ in vectors[:60]:
        vector = toxicity.weights(ids, times, idf)
        near = matrix[:, ids] @ vector
        last = np.sort(near)[-25]
        found, similar = toxicity.nearest(index, ids, vector, 25)
        assert found.tolist() == np.flatnonzero(near >= last - 1e-9).tolist()
        assert np.allclose(similar, near[found])


def test_the_filter_judges_each_row(spark):
    texts = [f"{'vile awful' if i % 4 == 0 else 'calm river'} word{i % 7}" for i in range(400)]
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    rows = list(enumerate(texts)) + [(1000, texts[0]), (1000, texts[1]), (None, texts[0]), (None, texts[1])]
    left = toxicity.without_toxic(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()
    assert [(r["doc_id"], r["text"]) for r in left if r["doc_id"] is None or r["doc_id"] >= 1000] == [(1000, texts[1]), (None, texts[1])]


def test_places_of_words(monkeypatch):
    """Each word's place by its hash, also where hashes are shared, and after a journey to another process."""
    words = sorted({f"{a}{b}é" for a in "abcx" for b in range(300)} | {"a", "日本"})
    asked = [*words[::-1], "never", "b", "", words[3]]
    wanted = [words.index(w) if w in words else -1 for w in asked]
    for alike in (hash, len, lambda w: 7):
        monkeypatch.setattr(toxicity, "hash", alike, raising=False)
        places = toxicity.Places(pa.array(words, pa.string()))
        for each in (places, pickle.loads(pickle.dumps(places))):
            assert each.find(asked).tolist() == wanted and len(each) == len(words) and list(each) == words
    assert toxicity.Places(pa.array([], pa.string())).find(["a"]).tolist() == [-1] and places.find([]).tolist() == []


def test_index_takes_little_room():
    """Opened in a worker, an index holds at most 16 bytes a word of an entry beside the matrix; before, 24 and more."""
    rng = np.random.default_rng(5)
    vectors = []
    for k in range(300):
        ids = np.sort(rng.choice(50_000, 400, replace=False))
        vectors.append((ids, rng.integers(1, 9, len(ids)), k % 2))
    idf = 1 + rng.random(50_000)
    index = pickle.loads(pickle.dumps(toxicity.entries_of(vectors, idf, 0.1)))
    held = sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray) and len(x) > len(idf) + 1)
    assert len(index.ids) == 120_000 and held <= 16 * len(index.ids)
    plain = toxicity.build_index(vectors, idf, 0.1)
    assert (plain.values == index.values).all() and plain.times.sum() == index.times.sum()
    for k in range(0, 300, 60):
        a, b = index.starts[k], index.starts[k + 1]
        assert (index.values[a:b] == toxicity.weights(index.ids[a:b], index.times[a:b].astype(int), idf)).all()
