"""The operators that replace single-task work, forced onto their large-table paths."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlight.operators import lookups, profile, quantiles, sampling
from ledgerlight.operators.ordered import running_totals
from ledgerlight.operators.quantiles import exact_quantiles, grid_points


@pytest.fixture(scope="module")
def values(spark, folder):
    table = spark.read.parquet(f"{folder}/lineitem.parquet")
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(20_000.0)).otherwise(F.col("l_extendedprice"))
    return table.select(
        "l_quantity", "l_extendedprice", hot.alias("hot"), F.lit(7.0).alias("constant"),
        F.when(F.col("l_linenumber") > 3, F.col("l_tax")).alias("sparse"), F.lit(None).cast("double").alias("empty"),
        F.when(F.col("l_linenumber") == 1, float("nan")).otherwise(F.col("l_quantity")).alias("holes"),
    ).cache()


@pytest.mark.parametrize("small_rows", [10, 300, 10**9])
def test_quantiles_match_numpy_on_every_path(values, small_rows):
    wanted = [0.0, 1.0, 0.25, 0.5, 0.75, 0.995, *grid_points(37, 0.001, 0.999)]
    found = exact_quantiles(values, values.columns, wanted, small_rows)
    frame = values.toPandas()
    for name in values.columns:
        numbers = frame[name].dropna().to_numpy()
        if not len(numbers):
            assert found[name] == [None] * len(wanted)
            continue
        assert np.allclose(found[name], np.quantile(numbers, wanted), rtol=1e-12, atol=1e-9), name


def test_quantiles_of_few_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5, 0.25], small_rows=1)["x"] == [2.0, 1.5]
    assert exact_quantiles(df.where("x is null"), ["x"], [0.5])["x"] == [None]


def test_running_totals_equal_one_global_window(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    # a third of the rows share one score
    score = F.when(F.col("event_id") % 3 == 0, F.lit(1.0)).otherwise(F.round("value", 0))
    table = events.select("event_id", score.alias("score"), "value")
    order = [F.desc("score"), F.desc("event_id")]
    got = running_totals(table, order, {"n": F.lit(1), "total": "value"}, one_range_rows=0)
    plain = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = table.withColumns({"n": F.sum(F.lit(1)).over(plain), "total": F.sum("value").over(plain)})
    a = {r["event_id"]: (r["n"], round(r["total"], 6)) for r in got.collect()}
    b = {r["event_id"]: (r["n"], round(r["total"], 6)) for r in want.collect()}
    assert a == b


@pytest.fixture(scope="module")
def labelled(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.select(F.col("event_id").alias("id"), (F.col("value") > 100).alias("is_fraud")).cache()


def brute(df, quotas, seed=42):
    rows = [(r["is_fraud"], r["id"], r["digest"]) for r in df.withColumn("digest", sampling.hash_order("id", seed)).collect()]
    chosen = set()
    for value, quota in quotas.items():
        own = sorted((d, i) for f, i, d in rows if f == value)
        chosen |= {i for _, i in own[:quota]}
    return chosen


@pytest.mark.parametrize("ranked_rows", [0, 5, 10**6])
@pytest.mark.parametrize("quotas", [{True: 17, False: 333}, {True: 0, False: 1}, {True: 10**6, False: 10}])
def test_first_by_class(labelled, quotas, ranked_rows):
    counts = sampling.class_counts(labelled, "is_fraud")
    cuts = sampling.first_by_class(labelled, "is_fraud", "id", quotas, counts, ranked_rows=ranked_rows)
    taken = {r["id"] for r in cuts.take(labelled).collect()}
    rest = {r["id"] for r in cuts.rest(labelled).collect()}
    assert taken == brute(labelled, quotas)
    assert not taken & rest and len(taken) + len(rest) == labelled.count()


def test_sample_is_exact_repeatable_and_complains(labelled):
    counts = sampling.class_counts(labelled, "is_fraud")
    sample = sampling.sample_by_rate(labelled, "is_fraud", "id", 300, 0.05)
    assert sampling.class_counts(sample, "is_fraud") == {True: 15, False: 285}
    again = sampling.sample_by_rate(labelled.repartition(5), "is_fraud", "id", 300, 0.05)
    assert {r["id"] for r in sample.collect()} == {r["id"] for r in again.collect()}
    other = sampling.sample_by_rate(labelled, "is_fraud", "id", 300, 0.05, seed=7)
    assert {r["id"] for r in sample.collect()} != {r["id"] for r in other.collect()}
    with pytest.raises(ValueError, match="is_fraud=True"):
        sampling.sample_by_rate(labelled, "is_fraud", "id", (counts[True] + 1) * 2, 0.5)


def test_split_is_disjoint_complete_and_stratified(labelled):
    counts = sampling.class_counts(labelled, "is_fraud")
    train, test = sampling.split(labelled, "is_fraud", "id")
    a, b = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    total = sum(counts.values())
    assert not a & b and len(a | b) == total and len(b) == -(-total // 5)
    share = sampling.class_counts(test, "is_fraud")[True] / len(b)
    assert abs(share - counts[True] / total) <= 1 / len(b)


def test_quotas_use_largest_remainders():
    assert sampling.share_quotas({False: 947, True: 53}, 200) == {False: 189, True: 11}
    assert sampling.share_quotas({False: 1, True: 1}, 1) == {False: 1, True: 0}
    assert sampling.share_quotas({False: 10, True: 0}, 4) == {False: 4, True: 0}


def test_undersample_and_scatter(labelled):
    counts = sampling.class_counts(labelled, "is_fraud")
    under = sampling.class_counts(sampling.undersample(labelled, "is_fraud", "id", 2), "is_fraud")
    assert under == {True: counts[True], False: min(counts[False], 2 * counts[True])}
    scattered = sampling.class_counts(sampling.scatter(labelled, "is_fraud", "id", 10), "is_fraud")
    assert scattered == {True: counts[True], False: 10}


def test_fraction_then_trim(labelled):
    total = labelled.count()
    chosen = sampling.fraction_then_trim(labelled, "id", 400, total)
    assert 300 < chosen.count() <= 400
    assert sampling.fraction_then_trim(labelled, "id", total + 1, total).count() == total


def test_one_class_subsample(labelled):
    only = labelled.where("not is_fraud")
    assert sampling.subsample(only, "is_fraud", "id", 50).count() == 50


@pytest.mark.parametrize("how", ["inner", "left"])
def test_large_lookup_is_salted_without_losing_rows(spark, how):
    # one key holds half of the facts, one fact key is unknown, one is null
    facts = spark.range(1000).select(
        "id", F.when(F.col("id") % 2 == 0, 0).when(F.col("id") == 1, None).otherwise(F.col("id") % 50).alias("k")
    )
    lookup = spark.range(0, 45).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    assert 0 in lookups.hot_keys(facts, "k")
    rare = spark.range(300).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    assert lookups.hot_keys(rare, "k") == []
    want = lookups.lookup_join(rare, lookup, "k", how)
    got = lookups.lookup_join(rare, lookup, "k", how, broadcast_rows=3, salts=4)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    broadcast = lookups.lookup_join(facts, lookup, "k", how)
    salted = lookups.lookup_join(facts, lookup, "k", how, broadcast_rows=3, salts=4)
    assert salted.columns == broadcast.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, broadcast.collect()))


def test_frequencies(spark):
    train = spark.createDataFrame([("a", "1"), ("a", None), (None, "2"), ("b", "1")], "job string, zip string")
    maps = {c: lookups.frequency_map(train, c) for c in ("job", "zip")}
    assert {r["value"]: r["frequency"] for r in maps["job"].collect()} == {"a": 0.5, "b": 0.25, "__missing__": 0.25}
    new = spark.createDataFrame([(1, "a", "9"), (2, None, "1")], "id int, job string, zip string")
    for limit in (0, 1000):
        out = {r["id"]: r for r in lookups.frequency_encode(new, maps, limit).collect()}
        assert (out[1]["job_frequency"], out[1]["zip_frequency"]) == (0.5, 0.0)
        assert (out[2]["job_frequency"], out[2]["zip_frequency"]) == (0.25, 0.5)


def test_merged_counts_equal_one_count(spark):
    a = spark.createDataFrame([("x", 2), ("y", 1)], "value string, count bigint")
    b = spark.createDataFrame([("x", 3), ("z", 5)], "value string, count bigint")
    assert {r["value"]: r["count"] for r in lookups.merge_counts(a, b).collect()} == {"x": 5, "y": 1, "z": 5}


def test_alignment(spark):
    left = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_fraud boolean")
    right = spark.createDataFrame([(1, True), (2, True), (4, False)], "id int, is_fraud boolean")
    row = lookups.alignment(left, right, "id", "is_fraud").first().asDict()
    assert row == {"left_rows": 3, "right_rows": 3, "left_only": 1, "right_only": 1, "repeated_keys": 0, "label_mismatches": 1}
    lookups.require_alignment(left, left, "id", "is_fraud")
    with pytest.raises(ValueError, match="line up"):
        lookups.require_alignment(left, right, "id", "is_fraud")
    with pytest.raises(ValueError, match="line up"):
        lookups.require_alignment(left, left.union(left.limit(1)), "id", "is_fraud")
    null = spark.createDataFrame([(None, True)], "id int, is_fraud boolean")
    with pytest.raises(ValueError, match="line up"):
        lookups.require_alignment(null, null, "id", "is_fraud")


def test_row_keys_must_be_unique_and_there(spark):
    lookups.require_key(spark.createDataFrame([(1,), (2,)], "id int"), "id")
    for rows in ([(1,), (1,)], [(1,), (None,)]):
        with pytest.raises(ValueError, match="no row key"):
            lookups.require_key(spark.createDataFrame(rows, "id int"), "id")


def test_wide_lookups_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 1000)
    facts = spark.createDataFrame([(i % 5, i) for i in range(50)], "k int, x int")
    lookup = spark.createDataFrame([(i, "w" * 400) for i in range(5)], "k int, t string")
    joined = lookups.lookup_join(facts, lookup, "k")
    assert "_salt" in joined._jdf.queryExecution().analyzed().toString() and joined.count() == 50


def test_lookups_of_many_rows_are_not_broadcast_by_their_estimate(spark):
    facts = spark.range(50).select((F.col("id") % 5).alias("k"), F.col("id").alias("x"))
    lookup = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    for how in ("inner", "left"):
        joined = lookups.lookup_join(facts, lookup, "k", how, broadcast_rows=2)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert sorted(map(tuple, joined.select("k", "x", "y").collect())) == [(k, x, 2 * k) for k in range(5) for x in range(k, 50, 5)]


@pytest.mark.parametrize("hash_limit", [0, 10**6])
def test_duplicates_with_nulls(spark, hash_limit):
    df = spark.createDataFrame([(1, None)] * 5 + [(1, "a")] * 2 + [(2, "a"), (None, None)], "a int, b string")
    assert profile.duplicate_rows(df, hash_limit).first()[0] == 5
    assert profile.duplicate_rows(df.limit(0), hash_limit).first()[0] == 0


def test_many_quantiles_of_many_columns_leave_a_small_plan(spark, monkeypatch):
    df = spark.range(20_000).select(*[F.rand(i).alias(f"c{i}") for i in range(12)]).cache()
    points, plans, real = quantiles.grid_points(101, 0.0, 1.0), [], quantiles._inside
    monkeypatch.setattr(quantiles, "_inside", lambda *a: plans.append(real(*a)) or plans[-1])
    found = quantiles.exact_quantiles(df, df.columns, points, small_rows=100)
    plain = df.agg(*[F.percentile(c, F.array(*map(F.lit, points))) for c in df.columns]).first()
    assert all(found[c] == pytest.approx(list(v)) for c, v in zip(df.columns, plain))
    # the plan does not hold a literal per interval
    assert plans and all(len(p._jdf.queryExecution().analyzed().toJSON()) < 300_000 for p in plans)


@pytest.mark.parametrize("small_rows", [100, 2])
def test_many_intervals_share_a_bounded_number_of_cuts(spark, monkeypatch, small_rows):
    df = spark.range(20_000).select(*[F.rand(i).alias(f"c{i}") for i in range(12)]).cache()
    points, proposed, real = quantiles.grid_points(101, 0.0, 1.0), [], quantiles._propose

    def propose(numbers, intervals):
        cuts = real(numbers, intervals)
        proposed.append(sum(map(len, cuts.values())))
        return cuts

    monkeypatch.setattr(quantiles, "_propose", propose)
    found = quantiles.exact_quantiles(df, df.columns, points, small_rows=small_rows)
    plain = df.agg(*[F.percentile(c, F.array(*map(F.lit, points))) for c in df.columns]).first()
    assert all(found[c] == pytest.approx(list(v)) for c, v in zip(df.columns, plain))
    # intervals of few rows each are ranked as they are, however many there are
    assert not proposed if small_rows == 100 else proposed and max(proposed) < 60_000
