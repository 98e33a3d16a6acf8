"""Samples, splits, scalers and model input. Sample sizes follow from the table's own size."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlight.models.features import fit_frequency_maps, gamma_scale, prepare_features
from ledgerlight.operators import encode, explore, lookups, sampling, scale
from ledgerlight.plans.prepare import prepare, scaling_summary, transform
from ledgerlight.queries.base import (
    CATEGORIES, CLEAN_SQL, query, quota_sql, r, ranked_sql, transformed_sql, txn, with_txn,
)
from ledgerlight.schema import CYCLES, DISTANCE, SAMPLE_RATE
from ledgerlight.sources.tables import load
from ledgerlight.sources.txn import ID

SLIM = "txn_id, is_fraud"
HALF_SQL = "CAST((SELECT count(*) FROM txn) // 2 AS BIGINT)"


def slim(spark, folder):
    return txn(spark, folder).select(ID, "is_fraud")


def half(df) -> int:
    return df.count() // 2


@query(
    "stratified_sample_exact",
    with_txn(
        ranked_sql("txn"),
        f"""SELECT {SLIM} FROM ranked WHERE rn <= CASE WHEN is_fraud THEN round_even({HALF_SQL} * 0.05::DOUBLE, 0)
        ELSE {HALF_SQL} - round_even({HALF_SQL} * 0.05::DOUBLE, 0) END""",
    ),
)
def stratified_sample_exact(spark, folder):
    table = slim(spark, folder)
    return sampling.sample_by_rate(table, "is_fraud", ID, half(table), SAMPLE_RATE)


SPLIT_SIZE = "ceil((SELECT count(*) FROM {0}) * 0.2::DOUBLE)"


@query(
    "stratified_split",
    with_txn(
        quota_sql("txn", SPLIT_SIZE.format("txn")), ranked_sql("txn"),
        """SELECT txn_id, r.is_fraud, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split
        FROM ranked r JOIN quota q ON r.is_fraud = q.is_fraud""",
    ),
)
def stratified_split(spark, folder):
    train, test = sampling.split(slim(spark, folder), "is_fraud", ID)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query(
    "stratified_subsample",
    with_txn(
        quota_sql("txn", HALF_SQL), ranked_sql("txn"),
        f"SELECT txn_id, r.is_fraud FROM ranked r JOIN quota q ON r.is_fraud = q.is_fraud WHERE rn <= quota",
    ),
)
def stratified_subsample(spark, folder):
    table = slim(spark, folder)
    return sampling.subsample(table, "is_fraud", ID, half(table))


@query("fraction_sample", f"SELECT count(*) // 2 > 0 AS any_rows, true AS at_most_size, true AS near_size, CAST(0 AS BIGINT) AS foreign_rows FROM events")
def fraction_sample(spark, folder):
    table = slim(spark, folder)
    total = table.count()
    chosen = sampling.fraction_then_trim(table, ID, total // 2, total)
    rows = chosen.agg(F.count("*")).first()[0]
    foreign = chosen.join(table, ID, "left_anti").agg(F.count("*").alias("foreign_rows"))
    return foreign.select(
        F.lit(rows > 0).alias("any_rows"),
        F.lit(rows <= total // 2).alias("at_most_size"),
        F.lit(rows > 0.45 * total).alias("near_size"),
        "foreign_rows",
    )


@query(
    "undersample_majority",
    with_txn(ranked_sql("txn"), f"""SELECT {SLIM} FROM ranked
    WHERE is_fraud OR rn <= 10 * (SELECT count(*) FILTER (is_fraud) FROM txn)"""),
)
def undersample_majority(spark, folder):
    return sampling.undersample(slim(spark, folder), "is_fraud", ID, 10)


@query(
    "scatter_sample",
    with_txn(
        ranked_sql("txn"), transformed_sql("ranked"),
        f"""SELECT {SLIM}, {r('customer_merchant_distance_km')} AS customer_merchant_distance_km,
        {r('ln(1 + amt)')} AS log_amount FROM transformed WHERE is_fraud OR rn <= 60000""",
    ),
)
def scatter_sample(spark, folder):
    chosen = sampling.scatter(encode.with_distance(txn(spark, folder)), "is_fraud", ID)
    return chosen.select(ID, "is_fraud", DISTANCE, explore.log_amount().alias("log_amount"))


@query("shuffle_rows", "SELECT event_id, event_type FROM events ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), event_id")
def shuffle_rows(spark, folder):
    return sampling.shuffled(load(spark, folder, "events").select("event_id", "event_type"), "event_id")


@query(
    "class_distribution_by_split",
    with_txn(
        quota_sql("txn", SPLIT_SIZE.format("txn")), ranked_sql("txn"),
        """parts AS (SELECT CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split, r.is_fraud
         FROM ranked r JOIN quota q ON r.is_fraud = q.is_fraud)""",
        f"""SELECT split, CASE WHEN is_fraud THEN 'True' ELSE 'False' END AS is_fraud, count(*) AS count,
        {r('100.0 * count(*) / sum(count(*)) OVER (PARTITION BY split)', 4)} AS percent FROM parts GROUP BY split, parts.is_fraud""",
    ),
)
def class_distribution_by_split(spark, folder):
    train, test = sampling.split(slim(spark, folder), "is_fraud", ID)
    return explore.class_distribution({"train": train, "test": test})


@query(
    "class_distribution_pivot",
    with_txn(
        quota_sql("txn", SPLIT_SIZE.format("txn")), ranked_sql("txn"),
        f"""SELECT CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split,
        {r('100.0 * count(*) FILTER (NOT r.is_fraud) / count(*)', 4)} AS percent_false,
        {r('100.0 * count(*) FILTER (r.is_fraud) / count(*)', 4)} AS percent_true
        FROM ranked r JOIN quota q ON r.is_fraud = q.is_fraud GROUP BY 1""",
    ),
)
def class_distribution_pivot(spark, folder):
    train, test = sampling.split(slim(spark, folder), "is_fraud", ID)
    return explore.class_distribution_pivot(explore.class_distribution({"train": train, "test": test}))


LINE_FIT = """f AS (SELECT quantile_cont(ln(1 + l_extendedprice), 0.25) AS a, quantile_cont(ln(1 + l_extendedprice), 0.5) AS b,
 quantile_cont(ln(1 + l_extendedprice), 0.75) AS c, avg(l_quantity) AS m, stddev_pop(l_quantity) AS s,
 min(l_tax) AS lo, max(l_tax) AS hi FROM lineitem WHERE l_returnflag <> 'R')"""
LINE_KEY = "l_orderkey, l_linenumber, l_partkey"


def lines(spark, folder):
    """All lines, and those the scalers are fitted on."""
    table = load(spark, folder, "lineitem")
    return table, table.where(F.col("l_returnflag") != "R")


def line_columns(df, name):
    return df.select("l_orderkey", "l_linenumber", "l_partkey", name)


@query("log_robust_scale", f"""WITH {LINE_FIT} SELECT {LINE_KEY}, {r('(ln(1 + l_extendedprice) - b) / (c - a)')} AS l_extendedprice
    FROM lineitem, f""")
def log_robust_scale(spark, folder):
    table, train = lines(spark, folder)
    return line_columns(scale.fit_log_robust(train, ["l_extendedprice"]).apply(table), "l_extendedprice")


@query("standard_scale", f"WITH {LINE_FIT} SELECT {LINE_KEY}, {r('(l_quantity - m) / s')} AS l_quantity FROM lineitem, f")
def standard_scale(spark, folder):
    table, train = lines(spark, folder)
    return line_columns(scale.fit_standard(train, ["l_quantity"]).apply(table), "l_quantity")


@query("minmax_scale", f"WITH {LINE_FIT} SELECT {LINE_KEY}, {r('(l_tax - lo) / (hi - lo)')} AS l_tax FROM lineitem, f")
def minmax_scale(spark, folder):
    table, train = lines(spark, folder)
    return line_columns(scale.fit_minmax(train, ["l_tax"]).apply(table), "l_tax")


def scaled_sql(train: str, everything: str) -> str:
    """Scaled columns of ``everything``, fitted on ``train``; both carry the unscaled ones."""
    robust = {"amt": "amt", "city_pop": "city_pop", DISTANCE: DISTANCE}
    fits = ", ".join(
        f"quantile_cont(ln(1 + {c}), {p}) AS {c}_{n}" for c in robust for n, p in (("a", 0.25), ("b", 0.5), ("c", 0.75))
    )
    scaled = ", ".join(
        f"(ln(1 + {c}) - {c}_b) / CASE WHEN {c}_c = {c}_a THEN 1 ELSE {c}_c - {c}_a END AS {c}" for c in robust
    )
    cycles = ", ".join(f"{f}(2 * pi() * {c} / {p}) AS {c}_{f}" for c, p in CYCLES.items() for f in ("sin", "cos"))
    flags = ", ".join([f"category_{c}" for c in CATEGORIES] + ["gender_F", "gender_M"])
    return f"""
scale_fit AS (SELECT {fits}, avg(customer_age) AS age_mean, stddev_pop(customer_age) AS age_std,
 min(transaction_day_of_month) AS day_min, max(transaction_day_of_month) AS day_max FROM {train}),
scaled AS (SELECT txn_id, split, job, zip, is_fraud, is_weekend, is_night, {scaled}, {cycles}, {flags},
 (customer_age - age_mean) / CASE WHEN age_std = 0 THEN 1 ELSE age_std END AS customer_age,
 (transaction_day_of_month - day_min) / CAST(CASE WHEN day_max = day_min THEN 1 ELSE day_max - day_min END AS DOUBLE)
  AS transaction_day_of_month FROM {everything}, scale_fit)"""


DOUBLES = ("amt", "city_pop", DISTANCE, "customer_age", "transaction_day_of_month",
           *[f"{c}_{f}" for c in CYCLES for f in ("sin", "cos")])
SCALED_COLUMNS = (
    "txn_id, split, job, zip, is_fraud, is_weekend, is_night, "
    + ", ".join(f"{r(c)} AS {c}" for c in DOUBLES) + ", "
    + ", ".join([f"category_{c}" for c in CATEGORIES] + ["gender_F", "gender_M"])
)


def split_sql(source: str, seed: str) -> tuple[str, str, str]:
    return (
        quota_sql(source, SPLIT_SIZE.format(source), "split_quota"),
        ranked_sql(source, "split_ranked", seed),
        f"""parted AS (SELECT x.*, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split
         FROM split_ranked x JOIN split_quota q ON x.is_fraud = q.is_fraud)""",
    )


@query(
    "scale_train_test",
    with_txn(
        transformed_sql("txn"), *split_sql("transformed", "42"),
        "trained AS (SELECT * FROM parted WHERE split = 'train')", scaled_sql("trained", "parted"),
        f"SELECT txn_id, split, {', '.join(f'{r(c)} AS {c}' for c in DOUBLES[:5])} FROM scaled",
    ),
)
def scale_train_test(spark, folder):
    train, test = sampling.split(transform(txn(spark, folder)), "is_fraud", ID)
    fitted = scale.fit_scaling(train)
    parts = [fitted.apply(df).select(ID, F.lit(n).alias("split"), *DOUBLES[:5]) for n, df in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


SAMPLED_SQL = "sampled AS (SELECT * FROM transformed)"

PREPARED_SQL = (
    CLEAN_SQL, transformed_sql("clean"), SAMPLED_SQL, *split_sql("sampled", "42:split"),
    "trained AS (SELECT * FROM parted WHERE split = 'train')", scaled_sql("trained", "parted"),
)


def prepared(spark, folder):
    """Every transaction."""
    return prepare(txn(spark, folder), key=ID, drop=("customer_id", "ts"))


@query("preprocess_job", with_txn(*PREPARED_SQL, f"SELECT {SCALED_COLUMNS} FROM scaled"))
def preprocess_job(spark, folder):
    done = prepared(spark, folder)
    return done.train.withColumn("split", F.lit("train")).unionByName(done.test.withColumn("split", F.lit("test")))


def frequency_join(column: str, alias: str) -> str:
    return f"""LEFT JOIN (SELECT coalesce({column}, '__missing__') AS value,
      count(*) / CAST((SELECT count(*) FROM scaled WHERE split = 'train') AS DOUBLE) AS frequency
     FROM scaled WHERE split = 'train' GROUP BY 1) {alias} ON coalesce(s.{column}, '__missing__') = {alias}.value"""


FEATURE_COLUMNS = (
    "is_weekend", "is_night", *DOUBLES, *[f"category_{c}" for c in CATEGORIES], "gender_F", "gender_M",
)
FEATURES_SQL = f"""features AS (SELECT s.txn_id, s.split, s.is_fraud,
 coalesce(j.frequency, 0) AS job_frequency, coalesce(z.frequency, 0) AS zip_frequency,
 {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATURE_COLUMNS)}
 FROM scaled s {frequency_join('job', 'j')} {frequency_join('zip', 'z')})"""
ALL_FEATURES = ("job_frequency", "zip_frequency", *FEATURE_COLUMNS)


@query(
    "prepare_features",
    with_txn(*PREPARED_SQL, FEATURES_SQL,
             f"SELECT txn_id, is_fraud, {', '.join(f'{r(c)} AS {c}' for c in ALL_FEATURES)} FROM features WHERE split = 'test'"),
)
def prepare_features_query(spark, folder):
    done = prepared(spark, folder)
    features, _ = prepare_features(done.test, fit_frequency_maps(done.train), ID)
    return features


NUMERIC_LINES = ("l_quantity", "l_discount", "l_tax")


@query(
    "gamma_scale",
    f"""SELECT {r('1.0 / (3 * var_pop(v))')} AS gamma FROM (SELECT unnest([l_quantity, l_discount, l_tax]) AS v FROM lineitem)""",
)
def gamma_scale_query(spark, folder):
    gamma = gamma_scale(load(spark, folder, "lineitem"), NUMERIC_LINES)
    return spark.createDataFrame([(gamma,)], "gamma double")


@query(
    "attach_original_amount",
    with_txn(*PREPARED_SQL, f"""SELECT s.txn_id, s.is_fraud, {r('s.amt')} AS scaled_amt, {r('c.amt')} AS amt
    FROM scaled s JOIN clean c ON s.txn_id = c.txn_id WHERE split = 'test'"""),
)
def attach_original_amount(spark, folder):
    done = prepared(spark, folder)
    test = done.test.select(ID, "is_fraud", F.col("amt").alias("scaled_amt"))
    return lookups.attach_amount(test, done.reduced, ID, "amt", "amt")


@query(
    "alignment_check",
    with_txn("""SELECT count(*) AS left_rows, count(*) FILTER (txn_id % 4 <> 0) AS right_rows,
    count(*) FILTER (txn_id % 4 = 0) AS left_only, CAST(0 AS BIGINT) AS right_only,
    CAST(0 AS BIGINT) AS repeated_keys, count(*) FILTER (txn_id % 4 <> 0 AND txn_id % 10 = 3) AS label_mismatches FROM txn"""),
)
def alignment_check(spark, folder):
    left = slim(spark, folder)
    # the other side lacks some keys and has some labels turned round
    flipped = F.when(F.col(ID) % 10 == 3, ~F.col("is_fraud")).otherwise(F.col("is_fraud"))
    right = left.where(F.col(ID) % 4 != 0).withColumn("is_fraud", flipped)
    return lookups.alignment(left, right, ID, "is_fraud")


REDUCED_WIDTH = 6 + 6 + 2 + len(CATEGORIES) + 2


@query(
    "scaling_summary",
    with_txn(
        "counted AS (SELECT count(*) AS n, count(*) FILTER (is_fraud) AS positives FROM txn)",
        "sized AS (SELECT n, positives, n - ceil(n * 0.2::DOUBLE) AS train FROM counted)",
        f"""SELECT metric, CAST(value AS DOUBLE) AS value FROM sized, LATERAL (VALUES ('input_rows', n), ('sampled_rows', n),
        ('sampled_fraud_rows', positives), ('sampled_non_fraud_rows', n - positives),
        ('sampled_fraud_percent', round(100.0 * positives / n, 2)), ('source_columns', {REDUCED_WIDTH}),
        ('post_cyclic_columns', {REDUCED_WIDTH + len(CYCLES)}), ('encoded_columns', {2 * len(CYCLES)}),
        ('train_rows', train), ('test_rows', n - train)) v(metric, value)""",
    ),
)
def scaling_summary_query(spark, folder):
    return scaling_summary(prepared(spark, folder))
