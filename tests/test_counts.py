import pytest
from pyspark.sql import functions as F

from ledgerlight.streaming import counts


def written(spark, folder, rows, mode="append"):
    spark.createDataFrame([(v, w) for v, w in rows], "a string, b string").coalesce(1).write.mode(mode).parquet(str(folder))


def stream(spark, folder):
    return counts.read_in_batches(spark, str(folder), spark.read.parquet(str(folder)).schema)


def found(spark, path):
    return {(r["column"], r["value"]): r["count"] for r in counts.latest_counts(spark, str(path)).collect()}


def wanted(spark, folder):
    rows = spark.read.parquet(str(folder)).select([F.coalesce(c, F.lit("__missing__")).alias(c) for c in ("a", "b")]).collect()
    out = {}
    for r in rows:
        for c in ("a", "b"):
            out[c, r[c]] = out.get((c, r[c]), 0) + 1
    return out


def delta_rows(spark, path):
    return {p.rsplit("=", 1)[1]: spark.read.parquet(p).count() for p in counts.deltas(spark, str(path))}


def test_a_batch_writes_only_the_values_it_touches(spark, tmp_path):
    files, path = tmp_path / "files", tmp_path / "counts"
    written(spark, files, [(f"v{i}", "x") for i in range(50)])
    counts.count_values(stream(spark, files), str(path), ["a", "b"])
    written(spark, files, [("v3", "x"), ("new", None), ("v3", "x")])
    counts.count_values(stream(spark, files), str(path), ["a", "b"])
    # v3, new, x and the word for a missing value
    assert delta_rows(spark, path) == {"0": 51, "1": 4}
    assert found(spark, path) == wanted(spark, files)


def test_merging_keeps_all_counts(spark, tmp_path):
    files, path = tmp_path / "files", tmp_path / "counts"
    for n in range(7):
        written(spark, files, [(f"v{n}", "x"), ("same", None)])
        counts.count_values(stream(spark, files), str(path), ["a", "b"], merge_every=3)
        assert found(spark, path) == wanted(spark, files)
    assert len(counts.deltas(spark, str(path))) == 1


def test_a_failed_batch_and_a_failed_merge_are_taken_up_again(spark, tmp_path, monkeypatch):
    files, path = tmp_path / "files", tmp_path / "counts"
    for n in range(4):
        written(spark, files, [(f"v{n}", "x"), ("same", None)])
    real, calls = counts.merge, []

    def failing(spark, path):
        calls.append(path)
        if len(calls) == 1:
            raise RuntimeError("before the merge")
        real(spark, path)
        if len(calls) == 2:
            raise RuntimeError("after the merge")

    monkeypatch.setattr(counts, "merge", failing)
    for _ in range(2):
        with pytest.raises(Exception, match="the merge"):
            counts.count_values(stream(spark, files), str(path), ["a", "b"], merge_every=2)
        # nothing counted so far is lost or counted twice
        assert found(spark, path)["a", "same"] in (2, 3)
    counts.count_values(stream(spark, files), str(path), ["a", "b"], merge_every=2)
    assert found(spark, path) == wanted(spark, files) and len(calls) >= 3


def test_no_counts_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        counts.latest_counts(spark, str(tmp_path / "nothing"))
