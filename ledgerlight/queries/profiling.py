"""Imputation, lookups, profiles and exploratory tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlight.functions.features import with_time_features
from ledgerlight.operators import correlate, encode, explore, impute, lookups, profile
from ledgerlight.operators.quantiles import exact_quantiles, grid_points
from ledgerlight.operators.sampling import union_parts
from ledgerlight.plans import report
from ledgerlight.plans.prepare import reduce_columns, reduction_summary, transform, transform_summary
from ledgerlight.queries.base import (
    BUCKET_SQL, CATEGORIES, CLEAN_SQL, query, r, transformed_sql, txn, with_txn,
)
from ledgerlight.schema import DISTANCE, GRID_SPAN, WEEKDAY_LABELS
from ledgerlight.session import materialise, scratch_path
from ledgerlight.sources.counted import counted
from ledgerlight.sources.tables import load
from ledgerlight.sources.txn import ID
from ledgerlight.streaming.counts import count_values, frequency_maps, read_in_batches

CLEANED = f"""txn_id, {r('amt')} AS amt, {r('city_pop')} AS city_pop, {r('unix_time')} AS unix_time, {r('lat')} AS lat,
 {r('long')} AS long, {r('merch_lat')} AS merch_lat, {r('merch_long')} AS merch_long"""


@query("impute_median", with_txn(CLEAN_SQL, f"SELECT {CLEANED} FROM clean"))
def impute_median(spark, folder):
    table = txn(spark, folder)
    return impute.clean(table, text=[]).select(
        ID, "amt", "city_pop", "unix_time", "lat", "long", "merch_lat", "merch_long"
    )


@query("impute_mode", with_txn(CLEAN_SQL, "SELECT txn_id, category, gender, dob, job, zip FROM clean"))
def impute_mode(spark, folder):
    return impute.clean(txn(spark, folder), numeric=[]).select(ID, "category", "gender", "dob", "job", "zip")


@query("clean_missing_values", with_txn(CLEAN_SQL, f"SELECT {CLEANED}, category, gender, dob, job, zip, is_fraud FROM clean"))
def clean_missing_values(spark, folder):
    return impute.clean(txn(spark, folder)).drop("ts", "customer_id")


@query(
    "enrich_dimension",
    """SELECT o_orderkey, c_custkey AS customer_id, c_name, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def enrich_dimension(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    customers = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_name", "c_mktsegment"
    )
    return lookups.lookup_join(orders, customers, "customer_id")


def frequency_sql(column: str, source: str = "txn") -> str:
    return f"""(SELECT coalesce({column}, '__missing__') AS value,
     count(*) / CAST((SELECT count(*) FROM {source}) AS DOUBLE) AS frequency FROM {source} GROUP BY 1)"""


@query(
    "frequency_map",
    with_txn(f"""SELECT 'job' AS "column", value, {r('frequency')} AS frequency FROM {frequency_sql('job')}
    UNION ALL SELECT 'zip', value, {r('frequency')} FROM {frequency_sql('zip')}"""),
)
def frequency_map(spark, folder):
    table = txn(spark, folder)
    maps = {c: lookups.frequency_map(table, c).withColumn("column", F.lit(c)) for c in ("job", "zip")}
    return maps["job"].unionByName(maps["zip"])


@query(
    "frequency_map_in_batches",
    f"""SELECT 'event_type' AS "column", event_type AS value,
    {r('count(*) / CAST((SELECT count(*) FROM events) AS DOUBLE)')} AS frequency FROM events GROUP BY event_type""",
)
def frequency_map_in_batches(spark, folder):
    # a stream takes a pattern, not a single file
    events = read_in_batches(spark, f"{folder}/[e]vents.parquet", load(spark, folder, "events").schema)
    path = scratch_path(spark, "counts")
    count_values(events, path, ["event_type"])
    maps = frequency_maps(spark, path, ["event_type"])
    return maps["event_type"].withColumn("column", F.lit("event_type"))


@query(
    "frequency_encode",
    with_txn(
        "train AS (SELECT * FROM txn WHERE zip IS NULL OR CAST(zip AS INTEGER) < 20)",
        f"""SELECT txn_id, {r('coalesce(j.frequency, 0)')} AS job_frequency, {r('coalesce(z.frequency, 0)')} AS zip_frequency
        FROM txn LEFT JOIN {frequency_sql('job', 'train')} j ON coalesce(job, '__missing__') = j.value
        LEFT JOIN {frequency_sql('zip', 'train')} z ON coalesce(zip, '__missing__') = z.value""",
    ),
)
def frequency_encode(spark, folder):
    table = txn(spark, folder).select(ID, "job", "zip")
    # fitted on part of the values, so that some are unseen
    train = table.where(F.col("zip").isNull() | (F.col("zip").cast("int") < 20))
    return lookups.frequency_encode(table, {c: lookups.frequency_map(train, c) for c in ("job", "zip")})


@query(
    "merge_counts",
    """SELECT l_shipdate AS value, count(*) AS count FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
    FROM lineitem) GROUP BY 1""",
)
def merge_counts(spark, folder):
    lines = load(spark, folder, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "l_orderkey"
    )
    batches = [lines.where(F.pmod("l_orderkey", F.lit(3)) == n) for n in range(3)]
    return lookups.merge_counts(*[lookups.value_counts_of(b, "day") for b in batches])


@query(
    "complete_calendar",
    with_txn(
        transformed_sql("txn"),
        f"""SELECT CAST(d.i AS INTEGER) AS transaction_day_of_week, d.weekday, {r('coalesce(x.rate, 0)')} AS fraud_rate
        FROM (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(WEEKDAY_LABELS))}) d(i, weekday)
        LEFT JOIN (SELECT transaction_day_of_week AS i, avg(CAST(is_fraud AS INTEGER)) AS rate FROM transformed
         WHERE transaction_day_of_week <> 2 GROUP BY 1) x ON d.i = x.i""",
    ),
)
def complete_calendar(spark, folder):
    # one weekday is left out, so that it has to be added
    timed = with_time_features(txn(spark, folder)).where(F.col("transaction_day_of_week") != 2)
    return explore.rate_by_weekday(timed)


@query(
    "dataset_summary",
    with_txn(f"""SELECT count(*) AS rows, count(*) FILTER (is_fraud) AS positives, count(*) FILTER (NOT is_fraud) AS negatives,
    {r('avg(CAST(is_fraud AS INTEGER))')} AS positive_rate, CAST(16 AS BIGINT) AS columns FROM txn"""),
)
def dataset_summary(spark, folder):
    return profile.summary(txn(spark, folder), "is_fraud")


@query("table_shape", "SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns FROM lineitem")
def table_shape(spark, folder):
    return profile.shape(load(spark, folder, "lineitem"))


TXN_COLUMNS = (
    "txn_id", "ts", "unix_time", "customer_id", "category", "amt", "gender", "job", "zip", "city_pop", "dob", "lat",
    "long", "merch_lat", "merch_long", "is_fraud",
)
MISSING_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
    {r(f'100.0 * (count(*) - count({c})) / count(*)')} AS missing_percent FROM txn"""
    for c in TXN_COLUMNS
)


@query("missing_value_summary", with_txn(MISSING_SQL))
def missing_value_summary(spark, folder):
    return profile.missing_values(txn(spark, folder))


@query(
    "remaining_nulls",
    with_txn(CLEAN_SQL, """SELECT count(*) * 13 - count(amt) - count(lat) - count(long) - count(city_pop) - count(unix_time)
    - count(merch_lat) - count(merch_long) - count(category) - count(gender) - count(dob) - count(job) - count(zip)
    - count(is_fraud) AS remaining_nulls FROM clean"""),
)
def remaining_nulls(spark, folder):
    return profile.remaining_nulls(impute.clean(txn(spark, folder)))


@query(
    "duplicate_row_count",
    """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_row_count FROM (SELECT count(*) AS n FROM (
     SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 50 = 0
     UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 100 = 0) GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
     l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)""",
)
def duplicate_row_count(spark, folder):
    """All columns; as the table has few copies of its own, some rows are appended once and some twice."""
    lines = load(spark, folder, "lineitem")
    copies = [lines.where(F.col("l_orderkey") % step == 0) for step in (50, 100)]
    return profile.duplicate_rows(union_parts([lines, *copies]))


@query(
    "target_distribution",
    with_txn(f"""SELECT is_fraud, count(*) AS count, {r('100.0 * count(*) / sum(count(*)) OVER ()')} AS percent
    FROM txn GROUP BY 1"""),
)
def target_distribution(spark, folder):
    return profile.target_distribution(txn(spark, folder), "is_fraud")


def moments_rounded(df):
    """Mean and deviation of large numbers agree to fewer digits between engines."""
    return df.withColumns({n: F.round(n, 4) for n in ("mean", "std")})


def describe_sql(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})', 4)} AS mean, {r(f'stddev_samp({c})', 4)} AS std,
        {r(f'CAST(min({c}) AS DOUBLE)')} AS min, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)')} AS q25,
        {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS q50, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)')} AS q75,
        {r(f'CAST(max({c}) AS DOUBLE)')} AS max FROM {table}"""
        for c in columns
    )


LINE_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)


@query("describe_numeric", describe_sql("lineitem", LINE_NUMBERS))
def describe_numeric(spark, folder):
    return moments_rounded(profile.describe_numeric(load(spark, folder, "lineitem")))


def describe_text_sql(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
        arg_min(value, (-n, value)) AS top, max(n) AS freq
        FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in columns
    )


TXN_NUMBERS = (
    "txn_id", "unix_time", "customer_id", "amt", "city_pop", "lat", "long", "merch_lat", "merch_long",
)
TXN_TEXTS = ("category", "gender", "job", "zip", "is_fraud")


@query(
    "describe_all",
    with_txn(f"""SELECT "column", count, mean, std, min, q25, q50, q75, max, NULL::BIGINT AS "unique", NULL::VARCHAR AS top,
    NULL::BIGINT AS freq FROM ({describe_sql('txn', TXN_NUMBERS)})
    UNION ALL SELECT "column", count, NULL, NULL, NULL, NULL, NULL, NULL, NULL, "unique", top, freq
    FROM ({describe_text_sql('txn', TXN_TEXTS)})"""),
)
def describe_all(spark, folder):
    return moments_rounded(profile.describe_all(txn(spark, folder)))


@query(
    "cardinality",
    """SELECT 'o_orderstatus' AS "column", count(DISTINCT o_orderstatus) AS distinct_count FROM orders
    UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders
    UNION ALL SELECT 'day', count(DISTINCT strftime(o_orderdate, '%Y-%m-%d')) FROM orders""",
)
def cardinality(spark, folder):
    orders = load(spark, folder, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return profile.cardinality(orders)


@query(
    "top_values",
    with_txn(" UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count,
        CAST(row_number() OVER (ORDER BY count(*) DESC, {c} NULLS LAST) AS INTEGER) AS rank FROM txn GROUP BY {c})
        WHERE rank <= 10""" for c in ("category", "gender", "job", "zip"))),
)
def top_values(spark, folder):
    return profile.top_values(txn(spark, folder))


@query(
    "corr_with_target",
    with_txn(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {r(f'corr(CAST({c} AS DOUBLE), CAST(is_fraud AS INTEGER))')} AS correlation FROM txn"""
        for c in TXN_NUMBERS)),
)
def corr_with_target(spark, folder):
    return correlate.with_target(txn(spark, folder), "is_fraud")


CORRELATED = (
    "amt", "customer_merchant_distance_km", "transaction_hour", "transaction_day_of_week",
    "transaction_month", "is_night", "is_weekend", "customer_age", "city_pop", "gender_F", "gender_M", "is_fraud",
    *[f"category_{c}" for c in CATEGORIES],
)


def correlation_sql(columns) -> str:
    pairs = [(a, b) for a in columns for b in columns]
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, CASE WHEN min({a}) < max({a}) AND min({b}) < max({b})
         THEN {r(f'corr({a}, {b})')} END AS correlation FROM numbers""" for a, b in pairs
    )


NUMBERS_SQL = "numbers AS MATERIALIZED (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in CORRELATED) + " FROM transformed)"


@query("corr_matrix", with_txn(transformed_sql("txn"), NUMBERS_SQL, correlation_sql(CORRELATED)))
def corr_matrix(spark, folder):
    return correlate.matrix(transform(txn(spark, folder)), CORRELATED)


def rate_sql(group: str, name: str) -> str:
    return f"""SELECT {group} AS {name}, {r('avg(CAST(is_fraud AS INTEGER))')} AS fraud_rate FROM transformed
    WHERE {group} IS NOT NULL GROUP BY 1"""


@query("rate_by_hour", with_txn(transformed_sql("txn"), rate_sql("transaction_hour", "transaction_hour")))
def rate_by_hour(spark, folder):
    return explore.rate_by(with_time_features(txn(spark, folder)), "transaction_hour", "transaction_hour")


@query(
    "rate_by_weekday",
    with_txn(
        transformed_sql("txn"),
        f"""SELECT CAST(d.i AS INTEGER) AS transaction_day_of_week, d.weekday, {r('coalesce(x.rate, 0)')} AS fraud_rate
        FROM (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(WEEKDAY_LABELS))}) d(i, weekday)
        LEFT JOIN (SELECT transaction_day_of_week AS i, avg(CAST(is_fraud AS INTEGER)) AS rate FROM transformed
         GROUP BY 1) x ON d.i = x.i""",
    ),
)
def rate_by_weekday(spark, folder):
    return explore.rate_by_weekday(with_time_features(txn(spark, folder)))


@query("rate_by_night", with_txn(transformed_sql("txn"), rate_sql("is_night", "is_night")))
def rate_by_night(spark, folder):
    return explore.rate_by(with_time_features(txn(spark, folder)), "is_night", "is_night")


@query("rate_by_distance_bucket", with_txn(transformed_sql("txn"), rate_sql(BUCKET_SQL, "distance_bucket")))
def rate_by_distance_bucket(spark, folder):
    return explore.rate_by_distance(encode.with_distance(txn(spark, folder)))


CATEGORY_SQL = f"""SELECT category, count(*) AS transaction_count, CAST(sum(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_count,
 {r('avg(CAST(is_fraud AS INTEGER)) * 100', 4)} AS fraud_rate_percent FROM txn WHERE category IS NOT NULL GROUP BY 1"""


@query("category_summary", with_txn(CATEGORY_SQL))
def category_summary(spark, folder):
    return explore.category_summary(txn(spark, folder))


@query(
    "amount_summary_by_class",
    with_txn(f"""SELECT CASE WHEN is_fraud THEN 'True' ELSE 'False' END AS is_fraud, count(amt) AS count,
    {r('avg(amt)', 2)} AS mean, {r('quantile_cont(amt, 0.5)', 2)} AS median, {r('quantile_cont(amt, 0.9)', 2)} AS q90,
    {r('quantile_cont(amt, 0.95)', 2)} AS q95, {r('quantile_cont(amt, 0.99)', 2)} AS q99, {r('max(amt)', 2)} AS max
    FROM txn GROUP BY is_fraud"""),
)
def amount_summary_by_class(spark, folder):
    return explore.amount_summary(txn(spark, folder))


@query("quantile", f"SELECT {r('quantile_cont(l_extendedprice, 0.995)')} AS value FROM lineitem")
def quantile(spark, folder):
    found = exact_quantiles(load(spark, folder, "lineitem"), ["l_extendedprice"], [0.995])
    return spark.createDataFrame([(found["l_extendedprice"][0],)], "value double")


GRID = grid_points(300, *GRID_SPAN)


def grid_sql(points) -> str:
    return "[" + ", ".join(f"{p!r}::DOUBLE" for p in points) + "]"


@query(
    "quantile_grid",
    f"""SELECT CAST(unnest(range(300)) AS INTEGER) AS point,
    round(unnest(quantile_cont(l_extendedprice, {grid_sql(GRID)})), 6) AS value FROM lineitem""",
)
def quantile_grid(spark, folder):
    found = exact_quantiles(load(spark, folder, "lineitem"), ["l_extendedprice"], GRID)["l_extendedprice"]
    return spark.createDataFrame(list(enumerate(found)), "point int, value double")


def histogram_sql(value: str, source: str, bins: int) -> str:
    """Counts between equally spaced edges, the last bin closed."""
    return f"""
 SELECT CAST(i AS INTEGER) AS bin, {r('e_low')} AS low, {r('e_high')} AS high, count(x.v) AS count
 FROM (SELECT i, lo + i * ((hi - lo) / {bins}) AS e_low,
        CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * ((hi - lo) / {bins}) END AS e_high
       FROM range({bins}) t(i), (SELECT min({value}) AS lo, max({value}) AS hi FROM {source})) e
 LEFT JOIN (SELECT {value} AS v FROM {source} WHERE {value} IS NOT NULL) x
  ON x.v >= e_low AND (x.v < e_high OR (i = {bins - 1} AND x.v <= e_high))
 GROUP BY i, e_low, e_high"""


HISTOGRAMS_SQL = [
    transformed_sql("txn"),
    "capped AS (SELECT least(amt, (SELECT quantile_cont(amt, 0.995) FROM transformed)) AS v FROM transformed WHERE amt IS NOT NULL)",
    "logged AS (SELECT ln(1 + amt) AS v FROM transformed)",
    """far AS (SELECT least(customer_merchant_distance_km,
      (SELECT quantile_cont(customer_merchant_distance_km, 0.995) FROM transformed)) AS v FROM transformed)""",
    "whole AS (SELECT customer_merchant_distance_km AS v FROM transformed)",
]


@query(
    "histogram",
    with_txn(*HISTOGRAMS_SQL, " UNION ALL ".join(
        f"SELECT '{name}' AS chart, * FROM ({histogram_sql('v', source, bins)})"
        for name, source, bins in (("amount", "capped", 80), ("log_amount", "logged", 80), ("distance", "far", 80),
                                   ("distance_full", "whole", 40)))),
)
def histogram(spark, folder):
    table = encode.with_distance(txn(spark, folder))
    charts = {
        "amount": explore.histogram(explore.capped(table, "amt"), "amt"),
        "log_amount": explore.histogram(table, explore.log_amount()),
        "distance": explore.histogram(explore.capped(table, DISTANCE), DISTANCE),
        "distance_full": explore.histogram(table, DISTANCE, 40),
    }
    named = [df.withColumn("chart", F.lit(name)) for name, df in charts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


def boxplot_sql(value: str, source: str) -> str:
    return f"""
 SELECT t.is_fraud, count(*) AS count, {r('min(CASE WHEN inside THEN v END)')} AS whisker_low,
  {r('max(CASE WHEN inside THEN v END)')} AS whisker_high, count(*) FILTER (NOT inside) AS outliers,
  {r('min(a)')} AS q25, {r('min(b)')} AS q50, {r('min(c)')} AS q75
 FROM (SELECT s.is_fraud, {value} AS v, a, b, c, {value} BETWEEN a - 1.5 * (c - a) AND c + 1.5 * (c - a) AS inside
  FROM {source} s JOIN (SELECT is_fraud, quantile_cont({value}, 0.25) AS a, quantile_cont({value}, 0.5) AS b,
   quantile_cont({value}, 0.75) AS c FROM {source} GROUP BY 1) q ON s.is_fraud = q.is_fraud
  WHERE {value} IS NOT NULL) t GROUP BY t.is_fraud"""


@query(
    "boxplot_stats",
    with_txn(transformed_sql("txn"), f"""SELECT 'log_amount' AS chart, * FROM ({boxplot_sql('ln(1 + amt)', 'transformed')})
    UNION ALL SELECT 'distance', * FROM ({boxplot_sql('customer_merchant_distance_km', 'transformed')})"""),
)
def boxplot_stats(spark, folder):
    table = encode.with_distance(txn(spark, folder))
    amount = explore.boxplot(table, explore.log_amount()).withColumn("chart", F.lit("log_amount"))
    return amount.unionByName(explore.boxplot(table, DISTANCE).withColumn("chart", F.lit("distance")))


@query(
    "stage_summary",
    with_txn("""SELECT stage, metric, CAST(value AS DOUBLE) AS value FROM (SELECT count(*) AS n,
      count(DISTINCT category) + count(DISTINCT gender) AS encoded FROM txn) x,
      LATERAL (VALUES ('transform', 'rows', n), ('transform', 'columns', 16 - 2 + 8 + encoded),
       ('transform', 'created_time_features', 6), ('transform', 'created_age_features', 1),
       ('transform', 'created_distance_features', 1), ('transform', 'created_encoded_features', encoded),
       ('reduce', 'input_rows', n), ('reduce', 'input_columns', 22 + encoded), ('reduce', 'output_rows', n),
       ('reduce', 'output_columns', 22 + encoded - 6), ('reduce', 'dropped_columns', 6),
       ('reduce', 'missing_requested_columns', 11)) v(stage, metric, value)"""),
)
def stage_summary(spark, folder):
    transformed, known = counted(transform(txn(spark, folder)), materialise)
    one = transform_summary(transformed, known.rows).withColumn("stage", F.lit("transform"))
    two = reduction_summary(transformed, reduce_columns(transformed), known.rows).withColumn("stage", F.lit("reduce"))
    return one.unionByName(two)


@query(
    "sort_report",
    with_txn(f"""SELECT *, CAST(row_number() OVER (ORDER BY fraud_rate_percent DESC, category) AS INTEGER) AS place
    FROM ({CATEGORY_SQL})"""),
)
def sort_report(spark, folder):
    summary = explore.category_summary(txn(spark, folder))
    # as many rows as there are categories
    order = Window.orderBy(F.desc("fraud_rate_percent"), "category")
    return summary.withColumn("place", F.row_number().over(order))


@query("top_k", f"""SELECT l_orderkey, l_linenumber, {r('l_extendedprice')} AS l_extendedprice FROM lineitem
    ORDER BY lineitem.l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10""")
def top_k(spark, folder):
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"]
    return load(spark, folder, "lineitem").orderBy(*order).limit(10).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("union_all", with_txn(f"""SELECT txn_id, is_fraud, {r('amt')} AS amt FROM txn WHERE is_fraud
    UNION ALL SELECT txn_id, is_fraud, {r('amt')} FROM txn WHERE NOT is_fraud"""))
def union_all(spark, folder):
    table = txn(spark, folder).select(ID, "is_fraud", "amt")
    return union_parts([table.where("is_fraud"), table.where("not is_fraud")])


@query("distinct_values", f"SELECT DISTINCT {r('l_discount')} AS l_discount, {r('l_tax')} AS l_tax FROM lineitem")
def distinct_values(spark, folder):
    return load(spark, folder, "lineitem").select("l_discount", "l_tax").distinct()


def told(report: str, column: str, item: str, value: str, source: str) -> str:
    """One report as (report, column, item, value)."""
    return f"""SELECT '{report}' AS report, CAST({column} AS VARCHAR) AS "column", CAST({item} AS VARCHAR) AS item,
     CAST({value} AS DOUBLE) AS value FROM ({source})"""


# The types of the columns of the transaction view.
TXN_KINDS = {"double": 6, "string": 4, "bigint": 3, "boolean": 1, "date": 1, "timestamp_ntz": 1}
NUMBER_SQL = describe_sql("txn", TXN_NUMBERS)
TEXT_SQL = describe_text_sql("txn", TXN_TEXTS)
TOP_SQL = " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count,
    row_number() OVER (ORDER BY count(*) DESC, {c} NULLS LAST) AS rank FROM txn GROUP BY {c}) WHERE rank <= 10"""
    for c in ("category", "gender", "job", "zip")
)
CORRELATED_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {r(f'corr(CAST({c} AS DOUBLE), CAST(is_fraud AS INTEGER))')} AS correlation FROM txn"""
    for c in TXN_NUMBERS
)
PROFILE_SQL = " UNION ALL ".join([
    told("general_information", "''", "'rows'", "rows", "SELECT count(*) AS rows FROM txn"),
    told("columns", "name", "'position'", "i", "SELECT * FROM (VALUES "
         + ", ".join(f"('{n}', {i})" for i, n in enumerate(TXN_COLUMNS)) + ") v(name, i)"),
    told("data_types", "kind", "'count'", "n", "SELECT * FROM (VALUES " + ", ".join(f"('{k}', {n})" for k, n in TXN_KINDS.items()) + ") v(kind, n)"),
    told("head", "txn_id", "'customer_id'", "customer_id", "SELECT txn_id, customer_id FROM txn ORDER BY txn_id LIMIT 5"),
    *[told("describe", '"column"', f"'{m}'", m, NUMBER_SQL) for m in ("count", "std", "min", "max")],
    told("describe", '"column"', "top", "freq", TEXT_SQL),
    told("missing_values", '"column"', "'count'", "missing_count", MISSING_SQL),
    told("missing_values", '"column"', "'percent'", "missing_percent", MISSING_SQL),
    told("duplicate_rows", "''", "'rows'", "n", "SELECT count(*) - count(DISTINCT txn_id) AS n FROM txn"),
    *[told("numeric_summary", '"column"', f"'{m}'", m, NUMBER_SQL) for m in ("mean", "q25", "q50", "q75")],
    told("cardinality", '"column"', "'distinct'", '"unique"', describe_text_sql("txn", ("category", "gender", "job", "zip"))),
    told("top_values", '"column"', "value", "count", TOP_SQL),
    told("target_distribution", "is_fraud", "'count'", "n", "SELECT is_fraud, count(*) AS n FROM txn GROUP BY is_fraud"),
    told("target_correlation", '"column"', "'correlation'", "correlation", CORRELATED_SQL),
])


def flat(tables, report: str, column: str | None, item, value: str):
    """The Spark side of told()."""
    text = lambda c: F.lit(c) if c.startswith("'") else F.col(f"`{c}`").cast("string")
    named = F.lit(item[1:-1]) if item.startswith("'") else text(item)
    return tables[report].select(
        F.lit(report).alias("report"), (F.lit("") if column is None else text(column)).alias("column"),
        named.alias("item"), F.col(f"`{value}`").cast("double").alias("value"),
    )


@query("profile_job", with_txn(PROFILE_SQL))
def profile_job(spark, folder):
    """All twelve tables of the job."""
    tables = report.profile_tables(materialise(txn(spark, folder)), key=ID)
    for name in ("numeric_summary", "describe"):
        tables[name] = moments_rounded(tables[name])
    numbers = dict(tables, describe=tables["describe"].where("freq is null"))
    texts = dict(tables, describe=tables["describe"].where("freq is not null"))
    parts = [
        flat(tables, "general_information", None, "'rows'", "rows"),
        flat(tables, "columns", "column", "'position'", "position"),
        flat(tables, "data_types", "kind", "'count'", "count"),
        flat(tables, "head", "txn_id", "'customer_id'", "customer_id"),
        *[flat(numbers, "describe", "column", f"'{m}'", m) for m in ("count", "std", "min", "max")],
        flat(texts, "describe", "column", "top", "freq"),
        flat(tables, "missing_values", "column", "'count'", "missing_count"),
        flat(tables, "missing_values", "column", "'percent'", "missing_percent"),
        flat(tables, "duplicate_rows", None, "'rows'", "duplicate_row_count"),
        *[flat(tables, "numeric_summary", "column", f"'{m}'", m) for m in ("mean", "q25", "q50", "q75")],
        flat(tables, "cardinality", "column", "'distinct'", "distinct_count"),
        flat(tables, "top_values", "column", "value", "count"),
        flat(tables, "target_distribution", "is_fraud", "'count'", "count"),
        flat(tables, "target_correlation", "column", "'correlation'", "correlation"),
    ]
    return union_parts(parts)


FILLED_CATEGORY = f"coalesce(category, '{CATEGORIES[0]}')"
EDA_CATEGORY_SQL = f"""SELECT {FILLED_CATEGORY} AS category, count(*) AS n, {r('avg(CAST(is_fraud AS INTEGER)) * 100', 4)} AS rate
 FROM txn GROUP BY 1"""
EDA_AMOUNT_SQL = """SELECT CASE WHEN is_fraud THEN 'True' ELSE 'False' END AS label, round(avg(amt), 2) AS mean,
 round(quantile_cont(amt, 0.5), 2) AS median, round(quantile_cont(amt, 0.99), 2) AS q99 FROM txn GROUP BY is_fraud"""
EDA_WEEKDAY_SQL = f"""SELECT d.weekday, {r('coalesce(x.rate, 0)')} AS rate
 FROM (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(WEEKDAY_LABELS))}) d(i, weekday)
 LEFT JOIN (SELECT transaction_day_of_week AS i, avg(CAST(is_fraud AS INTEGER)) AS rate FROM transformed GROUP BY 1) x ON d.i = x.i"""
EDA_SQL = [
    *HISTOGRAMS_SQL,
    NUMBERS_SQL,
    " UNION ALL ".join([
        told("target_distribution", "is_fraud", "'count'", "n", "SELECT is_fraud, count(*) AS n FROM txn GROUP BY is_fraud"),
        *[told(f"{chart}", "bin", "'count'", "count", histogram_sql("v", source, bins)) for chart, source, bins in (
            ("amount_histogram", "capped", 80), ("log_amount_histogram", "logged", 80), ("distance_histogram", "far", 80),
            ("distance_histogram_full", "whole", 40))],
        *[told(f"{chart}", "is_fraud", f"'{m}'", m, boxplot_sql(value, "transformed"))
          for chart, value in (("amount_boxplot", "ln(1 + amt)"), ("distance_boxplot", "customer_merchant_distance_km"))
          for m in ("q25", "q50", "whisker_high", "outliers")],
        *[told("amount_summary", "label", f"'{m}'", m, EDA_AMOUNT_SQL) for m in ("mean", "median", "q99")],
        told("category_rates", "category", "'rate'", "rate", EDA_CATEGORY_SQL),
        told("category_counts", "category", "'count'", "n", EDA_CATEGORY_SQL),
        told("distance_rates", "distance_bucket", "'rate'", "fraud_rate", rate_sql(BUCKET_SQL, "distance_bucket")),
        told("amount_and_distance", "is_fraud", "'count'", "n",
             "SELECT is_fraud, CASE WHEN is_fraud THEN count(*) ELSE least(count(*), 60000) END AS n FROM txn GROUP BY is_fraud"),
        told("hour_rates", "transaction_hour", "'rate'", "fraud_rate", rate_sql("transaction_hour", "transaction_hour")),
        told("weekday_rates", "weekday", "'rate'", "rate", EDA_WEEKDAY_SQL),
        told("night_rates", "is_night", "'rate'", "fraud_rate", rate_sql("is_night", "is_night")),
        told("correlation", "a", "b", "correlation", correlation_sql(CORRELATED)),
    ]),
]


@query("eda_job", with_txn(*EDA_SQL))
def eda_job(spark, folder):
    """All sixteen charts of the job."""
    tables = report.explore_tables(materialise(transform(txn(spark, folder))), key=ID)
    tables["amount_and_distance"] = tables["amount_and_distance"].groupBy("is_fraud").count()
    histograms = ("amount_histogram", "log_amount_histogram", "distance_histogram", "distance_histogram_full")
    parts = [
        flat(tables, "target_distribution", "is_fraud", "'count'", "count"),
        *[flat(tables, name, "bin", "'count'", "count") for name in histograms],
        *[flat(tables, name, "is_fraud", f"'{m}'", m) for name in ("amount_boxplot", "distance_boxplot")
          for m in ("q25", "q50", "whisker_high", "outliers")],
        *[flat(tables, "amount_summary", "is_fraud", f"'{m}'", m) for m in ("mean", "median", "q99")],
        flat(tables, "category_rates", "category", "'rate'", "fraud_rate_percent"),
        flat(tables, "category_counts", "category", "'count'", "transaction_count"),
        flat(tables, "distance_rates", "distance_bucket", "'rate'", "fraud_rate"),
        flat(tables, "amount_and_distance", "is_fraud", "'count'", "count"),
        flat(tables, "hour_rates", "transaction_hour", "'rate'", "fraud_rate"),
        flat(tables, "weekday_rates", "weekday", "'rate'", "fraud_rate"),
        flat(tables, "night_rates", "is_night", "'rate'", "fraud_rate"),
        flat(tables, "correlation", "a", "b", "correlation"),
    ]
    return union_parts(parts)
