"""A transaction table derived from the ``events`` and ``customer`` tables.

The tables hold no coordinates, birth dates or nulls, so these follow from the keys by fixed rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.operators.lookups import lookup_join
from ledgerlight.session import prepare
from ledgerlight.sources.tables import load

ID = "txn_id"


def _null_every(step: int, at: int, value: Column) -> Column:
    return F.when(F.col("event_id") % step != at, value)


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event, enriched with its customer."""
    prepare(spark)
    events = load(spark, folder, "events").withColumnRenamed("user_id", "customer_id")
    customers = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    joined = lookup_join(events, customers, "customer_id")
    event, user = F.col("event_id"), F.col("customer_id")
    lat = F.lit(26.0) + (user * 7919 % 2250).cast("double") / 100.0
    long = F.lit(-123.0) + (user * 104729 % 5400).cast("double") / 100.0
    reach = F.when(event % 11 == 0, 50.0).otherwise(2000.0)
    mixed = event * 7919 % 100
    return joined.select(
        event.alias(ID),
        "ts",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("unix_time"),
        "customer_id",
        _null_every(200, 7, F.col("event_type")).alias("category"),
        _null_every(150, 11, F.col("value")).alias("amt"),
        F.when(user % 2 == 0, "F").otherwise("M").alias("gender"),
        _null_every(100, 3, F.col("c_mktsegment")).alias("job"),
        _null_every(200, 5, F.col("c_nationkey").cast("string")).alias("zip"),
        _null_every(200, 9, F.abs("c_acctbal") * 10).alias("city_pop"),
        F.date_add(F.to_date(F.lit("1940-01-01")), (user * 397 % 23000).cast("int")).alias("dob"),
        lat.alias("lat"),
        long.alias("long"),
        (lat + (event * 31 % 401 - 200).cast("double") / reach).alias("merch_lat"),
        (long + (event * 37 % 401 - 200).cast("double") / reach).alias("merch_long"),
        (((F.col("value") > 150) & (mixed < 70)) | (mixed < 2)).alias("is_fraud"),
    )


# The same table for the SQL checks.
TXN_SQL = """
txn AS (
 SELECT e.event_id AS txn_id, e.ts AS ts, CAST(floor(epoch(e.ts)) AS BIGINT) AS unix_time,
  e.user_id AS customer_id,
  CASE WHEN e.event_id % 200 = 7 THEN NULL ELSE e.event_type END AS category,
  CASE WHEN e.event_id % 150 = 11 THEN NULL ELSE e.value END AS amt,
  CASE WHEN e.user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE WHEN e.event_id % 100 = 3 THEN NULL ELSE c.c_mktsegment END AS job,
  CASE WHEN e.event_id % 200 = 5 THEN NULL ELSE CAST(c.c_nationkey AS VARCHAR) END AS zip,
  CASE WHEN e.event_id % 200 = 9 THEN NULL ELSE abs(c.c_acctbal) * 10 END AS city_pop,
  DATE '1940-01-01' + CAST(e.user_id * 397 % 23000 AS INTEGER) AS dob,
  26 + CAST(e.user_id * 7919 % 2250 AS DOUBLE) / 100 AS lat,
  -123 + CAST(e.user_id * 104729 % 5400 AS DOUBLE) / 100 AS long,
  26 + CAST(e.user_id * 7919 % 2250 AS DOUBLE) / 100
   + CAST(e.event_id * 31 % 401 - 200 AS DOUBLE) / (CASE WHEN e.event_id % 11 = 0 THEN 50 ELSE 2000 END) AS merch_lat,
  -123 + CAST(e.user_id * 104729 % 5400 AS DOUBLE) / 100
   + CAST(e.event_id * 37 % 401 - 200 AS DOUBLE) / (CASE WHEN e.event_id % 11 = 0 THEN 50 ELSE 2000 END) AS merch_long,
  ((e.value > 150 AND e.event_id * 7919 % 100 < 70) OR (e.event_id * 7919 % 100 < 2)) AS is_fraud
 FROM events e JOIN customer c ON e.user_id = c.c_custkey
)"""
