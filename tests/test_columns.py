import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import features as ft
from ledgerlight.functions import values as v
from ledgerlight.operators import encode, explore


def column(df, name="x"):
    return [row[name] for row in df.collect()]


def test_numbers_coerced_or_refused(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("",)], "t string")
    assert column(df.select(v.number_or_null("t").alias("x"))) == [1.5, None, None, None]
    good = spark.createDataFrame([("1.5",), (None,)], "t string")
    assert column(good.select(v.number_strict("t").alias("x"))) == [1.5, None]
    with pytest.raises(Exception, match="not a number"):
        df.select(v.number_strict("t").alias("x")).collect()


def test_flag_text_is_never_truthy(spark):
    words = ["True", "FALSE", "False", "1", "0", "yes", "no", None, ""]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    assert column(df.select(v.parse_flag("t").alias("x"))) == [True, False, False, True, False, True, False, False, False]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "t boolean")
    assert column(v.with_flag(flags, "t"), "t") == [True, False, False]


def test_empty_text_is_null_but_blank_is_not(spark):
    df = spark.createDataFrame([("",), (" ",), ("a",)], "t string")
    assert column(df.select(v.empty_to_null("t").alias("x"))) == [None, " ", "a"]


def test_align_adds_drops_and_orders(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "k int, a double, b double")
    out = v.align(df, ["b", "missing", "a"], keep=["k"])
    assert out.columns == ["k", "b", "missing", "a"]
    assert list(out.first()) == [1, 3.0, 0.0, 2.0]
    assert v.drop_present(df, ["a", "nothing"]).columns == ["k", "b"]


def seconds(text):
    return int(datetime.datetime.fromisoformat(text).replace(tzinfo=datetime.timezone.utc).timestamp())


def test_hours_weekdays_and_flags(spark):
    moments = [f"2024-01-0{d}T{h:02d}:30:00" for d, h in ((5, 21), (5, 22), (6, 5), (6, 6), (7, 7), (8, 0))]
    df = spark.createDataFrame([(i, seconds(m)) for i, m in enumerate(moments)] + [(9, None)], "i int, unix_time bigint")
    rows = ft.with_time_features(df).orderBy("i").collect()
    assert [r["is_night"] for r in rows] == [False, True, True, True, False, True, False]
    assert [r["transaction_day_of_week"] for r in rows] == [4, 4, 5, 5, 6, 0, None]
    assert [r["is_weekend"] for r in rows] == [False, False, True, True, True, False, False]
    assert [r["transaction_day_of_month"] for r in rows] == [5, 5, 6, 6, 7, 8, None]
    assert {r["transaction_month"] for r in rows} == {1, None}


def test_age_rounds_half_to_even_and_fills_with_median(spark):
    start = datetime.date(1970, 1, 1)
    # 365.25 * 2.5 = 913.125 days can never be hit in whole days, so compare with Python's rounding
    days = [913, 914, 1278, 1279, 10_000, 20_000]
    df = spark.createDataFrame(
        [(i, d * 86_400 + 3600, start) for i, d in enumerate(days)] + [(99, None, start), (98, 86_400, None)],
        "i int, unix_time bigint, dob date",
    )
    got = {r["i"]: r["customer_age"] for r in encode.with_age(df).collect()}
    ages = [round(d / 365.25) for d in days]
    assert [got[i] for i in range(len(days))] == ages
    middle = sorted(ages)
    assert got[99] == got[98] == int((middle[2] + middle[3]) / 2)


def test_age_half_is_even(spark):
    # 1461 days are four mean years; 8 * 1461 / 16 would be half way, so scale the rule itself
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert column(df.select(F.bround("x", 0).alias("x"))) == [0.0, 2.0, 2.0, 0.0]


def test_bad_birth_dates_are_null(spark):
    df = spark.createDataFrame([("2000-02-30",), ("x",), ("2000-02-29",)], "t string")
    assert column(df.select(ft.date_or_null("t").alias("x"))) == [None, None, datetime.date(2000, 2, 29)]


def test_distance(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 180.0), (52.0, 13.0, 52.0, 13.0), (0.0, 0.0, 0.0, 1.0), (None, 0.0, 0.0, 1.0)],
        "lat double, long double, merch_lat double, merch_long double",
    )
    got = column(encode.with_distance(df), "customer_merchant_distance_km")
    assert got[0] == pytest.approx(6371.0 * 3.141592653589793)
    assert got[1] == 0.0
    assert got[2] == pytest.approx(111.19492664455873)
    assert got[3] is None


def test_distance_buckets_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.0001,), (25.0,), (250.0,), (251.0,), (None,)], "d double")
    labels = column(df.select(ft.distance_bucket("d").alias("x")))
    assert labels == ["0-10", "0-10", "10-25", "10-25", "100-250", "250+", None]
    order = column(df.select(ft.distance_bucket_order(ft.distance_bucket("d")).alias("x")))
    assert order == [1, 1, 2, 2, 5, 6, None]


def test_one_hot_and_back(spark):
    df = spark.createDataFrame([("b", "F"), ("a", "M"), (None, "F"), ("c d", None)], "category string, gender string")
    vocabulary = encode.fit_vocabulary(df)
    assert vocabulary == {"category": ["a", "b", "c d"], "gender": ["F", "M"]}
    hot = ft.one_hot(df, vocabulary)
    assert hot.columns == ["category_a", "category_b", "category_c d", "gender_F", "gender_M"]
    assert list(hot.collect()[2])[:3] == [False, False, False]
    assert column(explore.with_category(hot), "category") == ["b", "a", "a", "c d"]
    unseen = ft.one_hot(spark.createDataFrame([("zzz", "F")], df.schema), vocabulary)
    assert list(unseen.first()) == [False, False, False, True, False]
    with pytest.raises(ValueError, match="more than 2"):
        encode.fit_vocabulary(df, ["category"], limit=2)


def test_cycles_close(spark):
    df = spark.createDataFrame([(0, 0, 12), (12, 7, 6)], "transaction_hour int, transaction_day_of_week int, transaction_month int")
    out = ft.with_cycles(df)
    assert out.columns[0::2] == ["transaction_hour_sin", "transaction_day_of_week_sin", "transaction_month_sin"]
    rows = out.collect()
    assert rows[1]["transaction_hour_cos"] == pytest.approx(-1)
    assert rows[1]["transaction_day_of_week_cos"] == pytest.approx(1)
    assert rows[0]["transaction_month_sin"] == pytest.approx(0, abs=1e-12)


def test_cap_keeps_nulls(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (None,)], "a double")
    assert column(df.select(v.cap("a", 5.0).alias("x"))) == [1.0, 5.0, None]
