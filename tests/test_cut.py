import math
import random
import string

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import cut


def asked(spark, values, kind, rows, one_task_rows=5, more=""):
    """The first rows of one column, with a number beside it that tells rows apart."""
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"v {kind}, i int").coalesce(2).cache()
    order = ["v", "i"] if more else ["v"]
    return df, cut.first_rows(df, order, rows, one_task_rows)


def plain(df, order, rows):
    return [tuple(r) for r in df.orderBy(*order).limit(rows).collect()]


def agrees(spark, values, kind, counts=(45,), one_task_rows=10):
    for rows in counts:
        df, found = asked(spark, values, kind, rows, one_task_rows, more="i")
        assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, plain(df, ["v", "i"], rows))), rows


def test_whole_numbers_of_any_range(spark):
    rng = random.Random(3)
    agrees(spark, [rng.randrange(-(1 << 63), 1 << 63) for _ in range(80)] + [None] * 10 + [-(1 << 63), (1 << 63) - 1], "long")
    agrees(spark, [rng.randrange(5) for _ in range(120)], "int")
    agrees(spark, list(range(1000, 1150)), "short")


def test_fractions_with_odd_values(spark):
    rng = random.Random(4)
    values = [rng.gauss(0, 1) * 10 ** rng.randrange(-300, 300) for _ in range(80)]
    agrees(spark, values + [math.inf, -math.inf, math.nan, math.nan, None, 0.0, -0.0, 5e-324] * 3, "double", (16, 60, 98))
    agrees(spark, [0.5] * 100 + [0.25, 0.75, math.nan], "float", (50, 102))


def test_texts_with_common_beginnings(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(12))) for _ in range(100)]
    agrees(spark, words + [None, None, ""], "string")
    agrees(spark, ["same beginning " * 20 + w for w in words], "string")
    agrees(spark, ["x" * n for n in range(150)], "string", (70,))
    agrees(spark, ["".join(rng.choice("aé日😀zZ￿") for _ in range(4)) for _ in range(120)], "string")
    agrees(spark, [bytes(rng.randrange(256) for _ in range(rng.randrange(4))) for _ in range(100)], "binary")


def test_times_flags_and_decimals(spark):
    base = spark.range(200).repartition(2).select(F.col("id").alias("i"), (F.col("id") * 7919 % 200).alias("n"))
    typed = base.select(
        F.expr("date_add(date'1960-01-01', cast(n as int) * 300)").alias("d"),
        F.timestamp_micros(F.col("n") * 1_234_567_890 - 10**14).alias("t"),
        (F.col("n") % 2 == 0).alias("b"), (F.col("n").cast("decimal(10,2)") / 7).cast("decimal(12,3)").alias("c"), "i",
    )
    for name in ("d", "t", "b", "c"):
        for rows in (77,):
            found = cut.first_rows(typed, [name, "i"], rows, 5)
            assert sorted(tuple(r) for r in found.collect()) == sorted(plain(typed, [name, "i"], rows)), (name, rows)


def test_one_key_holds_a_third_of_the_rows(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("same").alias("t"), (F.col("id") * 31 % 900).alias("i"),
    )
    for rows in (30, 400):
        found = cut.first_rows(df, ["k", "t", "i"], rows, 10)
        assert sorted(tuple(r) for r in found.collect()) == sorted(plain(df, ["k", "t", "i"], rows))


def test_rows_that_are_all_the_same(spark):
    df = spark.range(500).select(F.lit("x").alias("a"), F.lit(1).alias("b"))
    assert cut.first_rows(df, ["a", "b"], 300, 10).collect() == [("x", 1)] * 300
    part = df.withColumn("c", F.rand(1))
    assert cut.first_rows(part, ["a", "b"], 300, 10).count() == 300
    nested = spark.range(100).select(F.lit(1).alias("a"), F.array(F.col("id") * 37 % 100).alias("b"))
    found = cut.first_rows(nested, ["a", "b"], 60, 10)
    assert sorted(r["b"][0] for r in found.collect()) == list(range(60))


def test_more_rows_than_there_are_and_none(spark):
    df = spark.range(50)
    assert cut.first_rows(df, ["id"], 200, 10).count() == 50
    assert cut.first_rows(df.where("id < 0"), ["id"], 200, 10).count() == 0
    assert cut.first_rows(df, ["id"], 0, 10).count() == 0


def test_no_exchange_of_the_table(spark):
    letters = string.ascii_lowercase
    df = spark.range(5_000).select(F.concat(*[F.substring(F.lit(letters), (F.col("id") * p % 26 + 1).cast("int"), F.lit(1)) for p in (3, 7, 11)]).alias("t"), "id")
    found = cut.first_rows(df, ["t", "id"], 3_000, 50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Filter") >= 2
    assert found.count() == 3_000


@pytest.mark.parametrize("rows", [2_000, 4_999])
def test_passes_do_not_grow_with_the_rows_asked_for(spark, monkeypatch, rows):
    df, seen = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("n")), []
    real = cut._counted
    monkeypatch.setattr(cut, "_counted", lambda *a: seen.append(1) or real(*a))
    assert cut.first_rows(df, ["n"], rows, 10).agg(F.max("n")).first()[0] == rows - 1
    assert len(seen) <= 2
