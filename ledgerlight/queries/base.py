"""Registration, rounding and the SQL building blocks the checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.session import prepare
from ledgerlight.sources.txn import ID, TXN_SQL, transactions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6


def query(name: str, sql: str | None = None, digits: int = DIGITS):
    """Register a query; doubles are rounded, as two engines may differ in the last bit."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(build(prepare(spark), folder), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round doubles; adding zero turns a negative zero into zero."""
    return df.select(
        *[(F.round(F.col(f"`{n}`"), digits) + F.lit(0.0)).alias(n) if kind == "double" else F.col(f"`{n}`")
          for n, kind in df.dtypes]
    )


def r(expression: str, digits: int = DIGITS) -> str:
    return f"(round({expression}, {digits}) + 0.0)"


def with_txn(*rest: str) -> str:
    """WITH txn AS (...), further parts, final select."""
    *parts, final = rest
    return "WITH " + ",\n".join([TXN_SQL.strip(), *parts]) + "\n" + final


def txn(spark: SparkSession, folder: str) -> DataFrame:
    return transactions(spark, folder)


def unscaled(df: DataFrame) -> DataFrame:
    """(key, label, score, amount) with the amount itself as the score."""
    amount = F.coalesce("amt", F.lit(0.0))
    return df.select(ID, "is_fraud", amount.alias("score"), amount.alias("amt"))


SCORED_SQL = "scored AS (SELECT txn_id, is_fraud, coalesce(amt, 0) AS score, coalesce(amt, 0) AS amt FROM txn)"

CLEAN_SQL = """
fit AS (
 SELECT quantile_cont(amt, 0.5) AS amt, quantile_cont(lat, 0.5) AS lat, quantile_cont(long, 0.5) AS long,
  quantile_cont(city_pop, 0.5) AS city_pop, quantile_cont(CAST(unix_time AS DOUBLE), 0.5) AS unix_time,
  quantile_cont(merch_lat, 0.5) AS merch_lat, quantile_cont(merch_long, 0.5) AS merch_long,
  (SELECT category FROM txn WHERE category IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS category,
  (SELECT gender FROM txn WHERE gender IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS gender,
  (SELECT dob FROM txn WHERE dob IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS dob
 FROM txn),
clean AS (
 SELECT txn_id, customer_id, ts, is_fraud,
  coalesce(t.amt, f.amt, 0) AS amt, coalesce(t.lat, f.lat, 0) AS lat, coalesce(t.long, f.long, 0) AS long,
  coalesce(t.city_pop, f.city_pop, 0) AS city_pop,
  coalesce(CAST(t.unix_time AS DOUBLE), f.unix_time, 0) AS unix_time,
  coalesce(t.merch_lat, f.merch_lat, 0) AS merch_lat, coalesce(t.merch_long, f.merch_long, 0) AS merch_long,
  coalesce(t.category, f.category, 'Unknown') AS category, coalesce(t.gender, f.gender, 'Unknown') AS gender,
  coalesce(t.dob, f.dob) AS dob, coalesce(t.job, 'Unknown') AS job, coalesce(t.zip, 'Unknown') AS zip
 FROM txn t, fit f)"""

DISTANCE_SQL = """6371.0 * 2 * asin(sqrt(least(1.0, greatest(0.0,
  pow(sin((radians(merch_lat) - radians(lat)) / 2), 2)
  + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin((radians(merch_long) - radians(long)) / 2), 2)))))"""

AGE_SQL = "round_even(floor((unix_time - epoch(CAST(dob AS TIMESTAMP))) / 86400) / 365.25, 0)"

# The categories that occur in the shared tables.
CATEGORIES = ("click", "error", "purchase", "signup", "view")
GENDERS = ("F", "M")

FLAGS_SQL = ", ".join(
    [f"coalesce(category = '{c}', false) AS category_{c}" for c in CATEGORIES]
    + [f"coalesce(gender = '{g}', false) AS gender_{g}" for g in GENDERS]
)


def transformed_sql(source: str, name: str = "transformed") -> str:
    """Time, age, distance and one-hot columns on top of a table with the raw ones."""
    moment = "make_timestamp(CAST(floor(unix_time) AS BIGINT) * 1000000)"
    return f"""
{name}_age AS (SELECT quantile_cont({AGE_SQL}, 0.5) AS median_age FROM {source}),
{name} AS (
 SELECT *,
  CAST(hour({moment}) AS INTEGER) AS transaction_hour,
  CAST(isodow({moment}) - 1 AS INTEGER) AS transaction_day_of_week,
  CAST(day({moment}) AS INTEGER) AS transaction_day_of_month,
  CAST(month({moment}) AS INTEGER) AS transaction_month,
  coalesce(isodow({moment}) - 1 IN (5, 6), false) AS is_weekend,
  coalesce(hour({moment}) IN (22, 23, 0, 1, 2, 3, 4, 5, 6), false) AS is_night,
  CAST(trunc(coalesce({AGE_SQL}, median_age)) AS BIGINT) AS customer_age,
  {DISTANCE_SQL} AS customer_merchant_distance_km,
  {FLAGS_SQL}
 FROM {source}, {name}_age)"""


BUCKET_SQL = """CASE WHEN customer_merchant_distance_km <= 10 THEN '0-10'
  WHEN customer_merchant_distance_km <= 25 THEN '10-25' WHEN customer_merchant_distance_km <= 50 THEN '25-50'
  WHEN customer_merchant_distance_km <= 100 THEN '50-100' WHEN customer_merchant_distance_km <= 250 THEN '100-250'
  WHEN customer_merchant_distance_km > 250 THEN '250+' END"""


def ranked_sql(source: str, name: str = "ranked", seed: str = "42", columns: str = "*") -> str:
    """Rows with their place in the seeded order of their class and the class sizes."""
    return f"""
{name} AS (
 SELECT {columns},
  row_number() OVER (PARTITION BY is_fraud ORDER BY md5('{seed}:' || CAST(txn_id AS VARCHAR)), txn_id) AS rn,
  count(*) OVER (PARTITION BY is_fraud) AS class_rows,
  count(*) OVER () AS all_rows
 FROM {source})"""


def quota_sql(source: str, size: str, name: str = "quota") -> str:
    """Per-class share of ``size`` by largest remainder, ties to the negative class."""
    return f"""
{name}_parts AS (
 SELECT is_fraud, count(*) AS n, (SELECT count(*) FROM {source}) AS total, CAST({size} AS BIGINT) AS size
 FROM {source} GROUP BY is_fraud),
{name} AS (
 SELECT is_fraud, (size * n) // total
  + CASE WHEN row_number() OVER (ORDER BY (size * n) % total DESC, is_fraud)
     <= size - sum((size * n) // total) OVER () THEN 1 ELSE 0 END AS quota
 FROM {name}_parts)"""
