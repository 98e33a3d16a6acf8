import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import correlate, explore, impute, profile, scale
from ledgerlight.schema import REDUCED_AWAY


def keyed(df, key="column"):
    return {r[key]: r for r in df.collect()}


def test_imputation(spark):
    df = spark.createDataFrame(
        [("1", "b", "x", "07001"), ("4", "a", None, None), ("oops", "", "y", "07002"), (None, "b", None, ""), ("", "a", None, "1")],
        "amt string, category string, job string, zip string",
    ).withColumn("lat", F.lit(None).cast("double"))
    fitted = impute.fit_imputation(df)
    assert fitted.medians == {"amt": 2.5, "lat": 0.0}
    # the tie between a and b goes to the smaller; zip and job are never guessed
    assert fitted.words == {"category": "a", "zip": "Unknown", "job": "Unknown"}
    rows = fitted.apply(df).collect()
    assert [r["amt"] for r in rows] == [1.0, 4.0, 2.5, 2.5, 2.5]
    assert [r["category"] for r in rows] == ["b", "a", "a", "b", "a"]
    assert [r["zip"] for r in rows] == ["07001", "Unknown", "07002", "Unknown", "1"]
    assert profile.remaining_nulls(fitted.apply(df)).first()[0] == 0


def test_cleaning_equals_fitting_everything(spark):
    df = spark.createDataFrame(
        [("1", 1.0, "b", "k1"), ("x", float("nan"), "", "k2"), (None, 5.0, "b", "k3")],
        "amt string, lat double, category string, trans_num string",
    )
    cleaned = impute.clean(df)
    assert cleaned.dtypes[:2] == [("amt", "double"), ("lat", "double")]
    rows = [tuple(r) for r in cleaned.orderBy("trans_num").collect()]
    assert rows == [(1.0, 1.0, "b", "k1"), (1.0, 3.0, "b", "k2"), (1.0, 5.0, "b", "k3")]
    assert rows == [tuple(r) for r in impute.fit_imputation(df).apply(df).orderBy("trans_num").collect()]


def test_mode_of_nothing_is_unknown(spark):
    df = spark.createDataFrame([(None, 1.0), ("", 2.0)], "category string, amt double")
    assert impute.fit_imputation(df).words == {"category": "Unknown"}


def test_fitted_values_clean_a_later_batch(spark):
    first = spark.createDataFrame([(1.0,), (3.0,)], "amt double")
    later = spark.createDataFrame([(None,), (100.0,)], "amt double")
    assert [r["amt"] for r in impute.fit_imputation(first).apply(later).collect()] == [2.0, 100.0]


def test_missing_values_and_empty_input(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, "x"), (3, "y")], "a int, b string")
    rows = profile.missing_values(df).collect()
    assert [(r["column"], r["missing_count"], r["missing_percent"]) for r in rows] == [("b", 2, 50.0), ("a", 1, 25.0)]
    assert [r["missing_percent"] for r in profile.missing_values(df.limit(0)).collect()] == [0.0, 0.0]


def test_describe(spark):
    numbers = [1.0, 2.0, 4.0, 8.0]
    df = spark.createDataFrame([(n, t, n > 2) for n, t in zip(numbers, ["b", "b", "a", None])], "n double, t string, f boolean")
    rows = keyed(profile.describe_all(df))
    assert (rows["n"]["mean"], rows["n"]["q50"], rows["n"]["max"]) == (3.75, 3.0, 8.0)
    assert rows["n"]["std"] == pytest.approx(np.std(numbers, ddof=1))
    assert rows["n"]["top"] is None
    assert (rows["t"]["count"], rows["t"]["unique"], rows["t"]["top"], rows["t"]["freq"]) == (3, 2, "b", 2)
    assert (rows["f"]["top"], rows["f"]["freq"]) == ("false", 2)


def test_top_values_and_cardinality(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,), (None,)], "t string")
    top = [(r["value"], r["count"]) for r in profile.top_values(df, k=2).orderBy("rank").collect()]
    assert top == [(None, 3), ("b", 2)]
    assert keyed(profile.cardinality(df))["t"]["distinct_count"] == 2
    assert keyed(profile.cardinality(df, approximate=True))["t"]["distinct_count"] == 2


def test_metadata_reports(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "trans_num int, city string, amt double")
    assert [r["column"] for r in profile.column_list(df).orderBy("position").collect()] == df.columns
    assert {r["kind"]: r["count"] for r in profile.kind_counts(df).collect()} == {"int": 1, "string": 1, "double": 1}
    from ledgerlight.operators.encode import column_report
    from ledgerlight.plans.prepare import reduce_columns

    status = column_report(df, reduce_columns(df))
    rows = {r["column"]: r["status"] for r in status.collect()}
    assert rows["city"] == "dropped" and rows["merchant"] == "not_found" and rows["amt"] == "kept"
    assert status.count() == len(REDUCED_AWAY) + 1
    operations = {r["column"]: r["operation"] for r in scale.operation_report(spark).collect()}
    assert operations["amt"] == "log1p + RobustScaler" and len(operations) == 8


def test_correlations_match_numpy_with_holes(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3)) + 1e6
    x[:, 1] += x[:, 0]
    table = [[None if rng.random() < 0.1 else float(v) for v in row] + [5.0] for row in x]
    df = spark.createDataFrame(table, "a double, b double, c double, flat double").repartition(4)
    got = {(r["a"], r["b"]): r["correlation"] for r in correlate.matrix(df, df.columns).collect()}
    frame = df.toPandas().astype(float).corr()
    for i in df.columns:
        for j in df.columns:
            want = frame.loc[i, j]
            assert (got[i, j] is None) if math.isnan(want) else got[i, j] == pytest.approx(want, abs=1e-9)


def test_target_correlation_accepts_a_flag(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, False), (3.0, True), (9.0, False)], "a double, is_fraud boolean")
    want = np.corrcoef([1, 2, 3, 9], [1, 0, 1, 0])[0, 1]
    assert correlate.with_target(df, "is_fraud").first()["correlation"] == pytest.approx(want)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(2)
    numbers = np.round(rng.gamma(2.0, 30.0, 500), 1)
    df = spark.createDataFrame([(float(n),) for n in numbers] + [(None,)], "x double")
    rows = explore.histogram(df, "x", 80).orderBy("bin").collect()
    counts, _ = np.histogram(numbers, 80)
    assert [r["count"] for r in rows] == list(counts)
    flat = explore.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in flat] == list(np.histogram([3.0, 3.0], 4)[0])
    assert explore.histogram(df.limit(0), "x").count() == 0


def test_boxplot(spark):
    inner = [1.0, 2.0, 3.0, 4.0, 5.0]
    df = spark.createDataFrame([(v, True) for v in [*inner, 100.0, -50.0]] + [(7.0, False)], "x double, is_fraud boolean")
    rows = {r["is_fraud"]: r for r in explore.boxplot(df, "x").collect()}
    box = rows[True]
    assert (box["whisker_low"], box["whisker_high"], box["outliers"], box["q50"]) == (1.0, 5.0, 2, 3.0)
    assert rows[False]["q25"] == rows[False]["whisker_high"] == 7.0


def test_rates(spark):
    df = spark.createDataFrame([(0, True), (0, False), (3, False), (None, True)], "transaction_day_of_week int, is_fraud boolean")
    rows = {r["weekday"]: r["fraud_rate"] for r in explore.rate_by_weekday(df).collect()}
    assert rows == {"Mon": 0.5, "Tue": 0.0, "Wed": 0.0, "Thu": 0.0, "Fri": 0.0, "Sat": 0.0, "Sun": 0.0}


def test_scalers(spark):
    numbers = [0.0, 1.0, 3.0, 7.0, 15.0]
    df = spark.createDataFrame([(v, 5.0) for v in numbers], "x double, flat double")
    out = [r["x"] for r in scale.fit_log_robust(df, ["x", "flat"]).apply(df).collect()]
    logged = np.log1p(numbers)
    a, b, c = np.quantile(logged, [0.25, 0.5, 0.75])
    assert np.allclose(out, (logged - b) / (c - a))
    assert np.median(out) == pytest.approx(0)
    out = [r["x"] for r in scale.fit_standard(df, ["x", "flat"]).apply(df).collect()]
    assert np.allclose(out, (np.array(numbers) - np.mean(numbers)) / np.std(numbers))
    fitted = scale.fit_minmax(df, ["x", "flat"])
    assert [r["flat"] for r in fitted.apply(df).collect()] == [0.0] * 5
    # later rows are not clipped to the fitted range
    beyond = spark.createDataFrame([(30.0, 6.0)], "x double, flat double")
    assert list(fitted.apply(beyond).first()) == [2.0, 1.0]
