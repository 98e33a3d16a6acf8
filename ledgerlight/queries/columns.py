"""Scans, projections, casts, time, geometry and encodings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.functions import features as ft
from ledgerlight.functions import values as v
from ledgerlight.operators import encode, explore, profile
from ledgerlight.operators.cut import first_rows
from ledgerlight.plans.prepare import reduce_columns, transform
from ledgerlight.queries.base import (
    AGE_SQL, BUCKET_SQL, CATEGORIES, DISTANCE_SQL, FLAGS_SQL, query, r, transformed_sql, txn, with_txn,
)
from ledgerlight.schema import CYCLES, DISTANCE
from ledgerlight.session import scratch_path
from ledgerlight.sources.tables import load, read_csv, read_table, write_table
from ledgerlight.sources.txn import ID

LINE_ORDER = "l_returnflag, l_shipdate, l_quantity, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice"

CSV_SCHEMA = T.StructType(
    [
        T.StructField("txn_id", T.LongType()),
        T.StructField("zip", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("dob", T.DateType()),
        T.StructField("amt", T.DoubleType()),
        T.StructField("is_fraud", T.BooleanType()),
    ]
)


@query(
    "scan_csv_typed",
    with_txn(f"""SELECT txn_id, '0' || zip AS zip, job, CASE WHEN txn_id % 17 <> 0 THEN dob END AS dob,
    CASE WHEN txn_id % 13 <> 0 THEN {r('amt')} END AS amt, is_fraud FROM txn"""),
)
def scan_csv_typed(spark, folder):
    path = scratch_path(spark, "typed") + "_csv"
    # another column order than the schema, identifiers that look like numbers, numbers and dates that are
    # none, flags in several spellings and keys written with a decimal point
    key = F.col(ID)
    words = F.when(F.col("is_fraud"), F.element_at(F.array(*map(F.lit, ("yes", "1", "TRUE"))), (key % 3 + 1).cast("int")))
    flags = words.otherwise(F.element_at(F.array(*map(F.lit, ("no", "0", "n/a"))), (key % 3 + 1).cast("int")))
    table = txn(spark, folder).select(
        flags.alias("is_fraud"), F.concat(F.lit("0"), "zip").alias("zip"), "job",
        F.when(key % 17 == 0, "n/a").otherwise(F.col("dob").cast("string")).alias("dob"),
        F.when(key % 13 == 0, "abc").otherwise(F.col("amt").cast("string")).alias("amt"),
        F.when(key % 7 == 0, F.concat(key.cast("string"), F.lit(".0"))).otherwise(key.cast("string")).alias("txn_id"),
    )
    write_table(table, path)
    return read_csv(spark, path, CSV_SCHEMA).select("txn_id", "zip", "job", "dob", "amt", "is_fraud")


@query("scan_limit", f"SELECT event_id, user_id, event_type, {r('value')} AS value FROM events ORDER BY event_id LIMIT 1000")
def scan_limit(spark, folder):
    rows = read_table(spark, f"{folder}/events.parquet", rows=1000, key="event_id")
    return rows.select("event_id", "user_id", "event_type", "value")


@query("scan_limit_counted", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag FROM lineitem "
       f"ORDER BY {LINE_ORDER} LIMIT 30000")
def scan_limit_counted(spark, folder):
    """A limit that is cut off by counting: numbers, dates and texts decide between rows of the same key."""
    names = LINE_ORDER.split(", ")
    rows = load(spark, folder, "lineitem")
    return first_rows(rows, names, 30_000, one_task_rows=500).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
    )


@query("scan_pruned", f"SELECT l_orderkey, l_linenumber, {r('l_extendedprice')} AS l_extendedprice FROM lineitem")
def scan_pruned(spark, folder):
    return read_table(spark, f"{folder}/lineitem.parquet", columns=["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("preview", f"SELECT event_id, user_id, event_type, {r('value')} AS value, props FROM events ORDER BY event_id LIMIT 10")
def preview(spark, folder):
    return profile.preview(load(spark, folder, "events").drop("ts"), "event_id")


@query("sink_overwrite", with_txn(f"SELECT txn_id, category, {r('amt')} AS amt, is_fraud FROM txn"))
def sink_overwrite(spark, folder):
    path = scratch_path(spark, "replaced")
    table = txn(spark, folder).select("txn_id", "category", "amt", "is_fraud")
    write_table(table.select("txn_id"), path)
    write_table(table, path)
    return spark.read.parquet(path)


@query(
    "cast_numeric_coerce",
    f"""SELECT event_id, {r("try_cast(CASE WHEN event_id % 7 = 0 THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE)")}
    AS amount FROM events""",
)
def cast_numeric_coerce(spark, folder):
    mixed = F.when(F.col("event_id") % 7 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))
    return load(spark, folder, "events").select("event_id", v.number_or_null(mixed).alias("amount"))


@query("cast_numeric_strict", f"SELECT o_orderkey, {r('CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE)')} AS price FROM orders")
def cast_numeric_strict(spark, folder):
    texts = load(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("text"))
    return texts.select("o_orderkey", v.number_strict("text").alias("price"))


@query(
    "empty_to_null",
    "SELECT c_custkey, nullif(CASE WHEN c_custkey % 13 = 0 THEN '' ELSE c_mktsegment END, '') AS job FROM customer",
)
def empty_to_null(spark, folder):
    blanked = F.when(F.col("c_custkey") % 13 == 0, "").otherwise(F.col("c_mktsegment"))
    return load(spark, folder, "customer").select("c_custkey", v.empty_to_null(blanked).alias("job"))


@query("fill_constant", with_txn("SELECT txn_id, coalesce(job, 'Unknown') AS job, coalesce(zip, 'Unknown') AS zip FROM txn"))
def fill_constant(spark, folder):
    return txn(spark, folder).select(ID, *[v.fill_constant(c, "Unknown").alias(c) for c in ("job", "zip")])


@query(
    "cast_string_cols",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus FROM orders",
)
def cast_string_cols(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return v.cast_columns(orders, ["o_orderkey", "o_custkey", "not_there"], "string")


SPELLED_SQL = """CASE event_id % 6 WHEN 0 THEN 'True' WHEN 1 THEN 'FALSE' WHEN 2 THEN '1' WHEN 3 THEN 'YES'
 WHEN 4 THEN NULL ELSE '0' END"""


@query(
    "parse_bool_text",
    f"SELECT event_id, coalesce(lower({SPELLED_SQL}) IN ('true', '1', 'yes'), false) AS flag FROM events",
)
def parse_bool_text(spark, folder):
    words = F.array(*map(F.lit, ["True", "FALSE", "1", "YES", None, "0"]))
    spelled = F.get(words, (F.col("event_id") % 6).cast("int"))
    return load(spark, folder, "events").select("event_id", v.parse_flag(spelled).alias("flag"))


@query("bool_to_int", with_txn("SELECT txn_id, CAST(is_fraud AS INTEGER) AS is_fraud FROM txn"))
def bool_to_int(spark, folder):
    return txn(spark, folder).select(ID, v.flag_to_int("is_fraud").alias("is_fraud"))


@query(
    "drop_columns_tolerant",
    with_txn(f"""SELECT txn_id, customer_id, category, gender, job, zip, {r('amt')} AS amt,
    {r('city_pop')} AS city_pop, is_fraud FROM txn"""),
)
def drop_columns_tolerant(spark, folder):
    return reduce_columns(txn(spark, folder)).drop("ts")


@query(
    "align_features",
    f"""SELECT l_orderkey, l_linenumber, {r('l_tax')} AS l_tax, CAST(0 AS DOUBLE) AS absent,
    {r('l_quantity')} AS l_quantity FROM lineitem""",
)
def align_features(spark, folder):
    return v.align(load(spark, folder, "lineitem"), ["l_tax", "absent", "l_quantity"], keep=["l_orderkey", "l_linenumber"])


@query(
    "filter_class",
    f"SELECT l_orderkey, l_linenumber, {r('l_extendedprice')} AS l_extendedprice FROM lineitem WHERE l_returnflag = 'R'",
)
def filter_class(spark, folder):
    returned = load(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return returned.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "clip_upper_quantile",
    f"""WITH c AS (SELECT quantile_cont(l_extendedprice, 0.995) AS cap FROM lineitem)
    SELECT l_orderkey, l_linenumber, {r('least(l_extendedprice, cap)')} AS l_extendedprice FROM lineitem, c""",
)
def clip_upper_quantile(spark, folder):
    return explore.capped(load(spark, folder, "lineitem"), "l_extendedprice").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query(
    "epoch_to_timestamp",
    with_txn("""SELECT txn_id, strftime(make_timestamp(unix_time * 1000000), '%Y-%m-%d %H:%M:%S') AS moment FROM txn"""),
)
def epoch_to_timestamp(spark, folder):
    moment = F.date_format(ft.epoch_to_timestamp("unix_time"), "yyyy-MM-dd HH:mm:ss")
    return txn(spark, folder).select(ID, moment.alias("moment"))


@query(
    "parse_date_coerce",
    with_txn("""SELECT txn_id, strftime(try_cast(CASE WHEN txn_id % 9 = 0 THEN 'not a date' ELSE CAST(dob AS VARCHAR) END
    AS DATE), '%Y-%m-%d') AS born FROM txn"""),
)
def parse_date_coerce(spark, folder):
    text = F.when(F.col(ID) % 9 == 0, "not a date").otherwise(F.col("dob").cast("string"))
    return txn(spark, folder).select(ID, ft.date_or_null(text).cast("string").alias("born"))


@query(
    "time_features",
    with_txn(
        transformed_sql("txn"),
        """SELECT txn_id, transaction_hour, transaction_day_of_week, transaction_day_of_month, transaction_month
        FROM transformed""",
    ),
)
def time_features(spark, folder):
    parts = ("transaction_hour", "transaction_day_of_week", "transaction_day_of_month", "transaction_month")
    return ft.with_time_features(txn(spark, folder)).select(ID, *parts)


@query("weekend_night_flags", with_txn(transformed_sql("txn"), "SELECT txn_id, is_weekend, is_night FROM transformed"))
def weekend_night_flags(spark, folder):
    return ft.with_time_features(txn(spark, folder)).select(ID, "is_weekend", "is_night")


@query(
    "customer_age",
    with_txn(
        "partly AS (SELECT txn_id, unix_time, CASE WHEN txn_id % 50 = 3 THEN NULL ELSE dob END AS dob FROM txn)",
        f"m AS (SELECT quantile_cont({AGE_SQL}, 0.5) AS median_age FROM partly)",
        f"SELECT txn_id, CAST(trunc(coalesce({AGE_SQL}, median_age)) AS BIGINT) AS customer_age FROM partly, m",
    ),
)
def customer_age(spark, folder):
    some = txn(spark, folder).withColumn("dob", F.when(F.col(ID) % 50 != 3, F.col("dob")))
    return encode.with_age(some).select(ID, "customer_age")


@query("haversine_km", with_txn(f"SELECT txn_id, {r(DISTANCE_SQL)} AS customer_merchant_distance_km FROM txn"))
def haversine_km(spark, folder):
    return encode.with_distance(txn(spark, folder)).select(ID, DISTANCE)


@query("log1p_cols", f"SELECT l_orderkey, l_linenumber, {r('ln(1 + l_extendedprice)')} AS log_price FROM lineitem")
def log1p_cols(spark, folder):
    return load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", v.log1p("l_extendedprice").alias("log_price"))


CYCLE_SQL = ", ".join(
    f"{r(f'{f}(2 * pi() * {c} / {p})')} AS {c}_{f}" for c, p in CYCLES.items() for f in ("sin", "cos")
)


@query("cyclic_encode", with_txn(transformed_sql("txn"), f"SELECT txn_id, {CYCLE_SQL} FROM transformed"))
def cyclic_encode(spark, folder):
    timed = ft.with_time_features(txn(spark, folder)).select(ID, *CYCLES)
    return ft.with_cycles(timed)


@query("one_hot", with_txn(f"SELECT txn_id, {FLAGS_SQL} FROM txn"))
def one_hot(spark, folder):
    table = txn(spark, folder).select(ID, "category", "gender")
    return ft.one_hot(table, encode.fit_vocabulary(table))


@query("one_hot_decode", with_txn(f"SELECT txn_id, coalesce(category, '{CATEGORIES[0]}') AS category FROM txn"))
def one_hot_decode(spark, folder):
    table = txn(spark, folder).select(ID, "category")
    encoded = ft.one_hot(table, encode.fit_vocabulary(table, ["category"]))
    return explore.with_category(encoded).select(ID, "category")


@query(
    "encoded_columns",
    with_txn("""SELECT 'category_' || category AS encoded_column FROM txn WHERE category IS NOT NULL GROUP BY 1
    UNION ALL SELECT 'gender_' || gender FROM txn GROUP BY 1"""),
)
def encoded_columns(spark, folder):
    table = txn(spark, folder)
    names = encode.vocabulary_columns(encode.fit_vocabulary(table))
    return spark.createDataFrame([(n,) for n in names], "encoded_column string")


@query("bucketize_distance", with_txn(transformed_sql("txn"), f"SELECT txn_id, {BUCKET_SQL} AS bucket FROM transformed"))
def bucketize_distance(spark, folder):
    return encode.with_distance(txn(spark, folder)).select(ID, ft.distance_bucket(DISTANCE).alias("bucket"))


TRANSFORMED_COLUMNS = f"""txn_id, customer_id, job, zip, {r('amt')} AS amt, {r('city_pop')} AS city_pop,
 transaction_hour, transaction_day_of_week, transaction_day_of_month, transaction_month, is_weekend, is_night,
 customer_age, {r('customer_merchant_distance_km')} AS customer_merchant_distance_km, is_fraud,
 {', '.join(f'category_{c}' for c in CATEGORIES)}, gender_F, gender_M"""


@query("transform_job", with_txn(transformed_sql("txn"), f"SELECT {TRANSFORMED_COLUMNS} FROM transformed"))
def transform_job(spark, folder):
    return reduce_columns(transform(txn(spark, folder))).drop("ts")
