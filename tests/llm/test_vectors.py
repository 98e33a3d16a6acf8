import numpy as np
import pytest

from ledgerlight.llm import collision_search, metric_tree, vectors


@pytest.fixture(scope="module")
def embeddings(spark, folder):
    return spark.read.parquet(f"{folder}/embeddings.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [0.0, 1.0]), (50, [0.5, 0.5]), (100, [0.5, 0.5]), (100, [0.5, 0.5]), (1, [0.5, 0.5]),
        (2, [0.5, 0.5]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [0.0, 0.0]), (None, [9.0, 9.0]),
        (8, []), (9, [3.0, 1.0, 2.0]), (150, [1.0, 1.0, 1.0]), (10, [-0.001, 0.0]),
    ]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "vec_id long, embedding array<double>, chunk string, v string")


def brute(ids, matrix, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = (matrix * matrix[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def table_of(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], float(r["score"])))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def arrays(frame):
    rows = frame.collect()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)


def test_metric_tree_is_exact(embeddings, monkeypatch):
    ids, matrix = arrays(embeddings)
    monkeypatch.setattr(vectors, "CHUNK_ROWS", 200)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 4)
    found = table_of(metric_tree.top_k(embeddings).collect())
    assert found == brute(ids, np.floor(matrix * 256), 50, 5)


def test_trees_of_clustered_vectors_skip_pages(monkeypatch):
    monkeypatch.setattr(metric_tree, "PAGE", 16)
    picked = np.random.default_rng(6)
    centres = picked.normal(size=(30, 8)) * 1000
    matrix = np.unique(np.floor(centres[picked.integers(0, 30, 3000)] + picked.normal(size=(3000, 8)) * 10), axis=0)
    tree = metric_tree.MetricTree(matrix)
    owners = [np.array([i]) for i in range(len(matrix))]
    taken = []
    for q in range(0, len(matrix), 300):
        best = vectors.Best(q, 5, owners)
        take = best.take
        best.take = lambda e, s: (taken.append(len(e)), take(e, s))
        tree.search(matrix[q], best)
        scores = matrix @ matrix[q]
        order = [j for j in np.lexsort((np.arange(len(matrix)), -scores)) if j != q][:5]
        assert best.ids.tolist() == order
    assert sum(taken) < 0.5 * len(matrix) * 10


def test_collision_search_recall_and_scores(embeddings, monkeypatch):
    ids, matrix = arrays(embeddings)
    monkeypatch.setattr(vectors, "CHUNK_ROWS", 300)
    found, wanted = table_of(collision_search.nearest(embeddings).collect()), brute(ids, matrix, 20, 20)
    assert found.keys() == wanted.keys() and all(len(x) == 20 for x in found.values())
    hits = [len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) / 20 for q in wanted]
    assert np.mean(hits) >= 0.9
    place = {int(i): n for n, i in enumerate(ids)}
    for q, pairs in found.items():
        for i, score in pairs:
            assert np.isclose(score, float(matrix[place[q]] @ matrix[place[i]]), rtol=1e-12, atol=1e-15)
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))


def test_windows_verify_only_a_part():
    picked = np.random.default_rng(8)
    centres = picked.normal(size=(40, 32))
    matrix = centres[picked.integers(0, 40, 4000)] + 0.1 * picked.normal(size=(4000, 32))
    index = collision_search.CollisionIndex(matrix)
    verified = []
    for q in range(0, 4000, 200):
        best = vectors.Best(q, 10, [np.array([i]) for i in range(4000)])
        take = best.take
        best.take = lambda e, s: (verified.append(len(e)), take(e, s))
        index.search(matrix[q], best)
    assert sum(verified) < 0.5 * 20 * 4000


def test_odd_vectors(odd, spark):
    exact = table_of(metric_tree.top_k(odd).collect())
    assert exact[0] == [(1, 32768.0), (2, 32768.0), (50, 32768.0), (100, 32768.0), (7, 0.0)]
    assert exact[100] == [(1, 32768.0), (2, 32768.0), (50, 32768.0), (0, 32768.0), (20, 32768.0)] or [
        i for i, _ in exact[100]] == [0, 1, 2, 20, 50]
    assert exact[150] == [(9, 393216.0)]
    near = table_of(collision_search.nearest(odd).collect())
    assert set(near) == {0, 20, 100}
    assert [i for i, _ in near[0]] == [1, 2, 50, 100, 20, 10]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert metric_tree.top_k(none).count() == collision_search.nearest(none).count() == 0


def test_many_copies_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK_ROWS", 100)
    rows = [(i, [1.0, 2.0, 2.0] if i % 3 else [float(i % 7), 1.0, -1.0]) for i in range(1000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ids, matrix = np.arange(1000), np.array([v for _, v in rows])
    assert table_of(metric_tree.top_k(table).collect()) == brute(ids, np.floor(matrix * 256), 50, 5)
    found, wanted = table_of(collision_search.nearest(table).collect()), brute(ids, matrix, 20, 20)
    assert np.mean([len(set(found[q]) & set(wanted[q])) / 20 for q in wanted]) > 0.99
