"""Fits, scoring and the jobs around them. Fits are iterative, so their checks are properties.

The SQL twin states how many rows a fit must have seen and that each property holds. Scoring itself is checked row by
row, with models of given numbers.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.models import artifact as art
from ledgerlight.models.kernel import FourierMap, KernelModel
from ledgerlight.models.linear import LinearModel
from ledgerlight.models.tuning import (
    KERNEL, LINEAR, MODEL_TYPES, ONE_CLASS, FeatureTable, fit, fit_final, fit_rows, param_grid, tune, tuning_report,
)
from ledgerlight.operators import evaluate as ev
from ledgerlight.plans import detect
from ledgerlight.queries.base import query, quota_sql, r, with_txn
from ledgerlight.queries.sampling import ALL_FEATURES, FEATURES_SQL, PREPARED_SQL, prepared
from ledgerlight.session import materialise, scratch_path
from ledgerlight.sources.tables import load
from ledgerlight.sources.txn import ID

NU = 0.05


def features(spark, folder) -> FeatureTable:
    """Model input: the training part of the preparation job."""
    return detect.feature_table(prepared(spark, folder).train, ID)


def scores(table: FeatureTable, model) -> ev.Scored:
    df = table.df.select(ID, "is_fraud", model.score().alias("score"), F.lit(0.0).alias("amt"))
    return ev.Scored(df, key=ID)


def auc(table: FeatureTable, model) -> float:
    return ev.ranking_metrics(scores(table, model)).first()["roc_auc"]


def one_row(spark, **values) -> DataFrame:
    kinds = {bool: "boolean", int: "bigint", float: "double", str: "string"}
    schema = ", ".join(f"{n} {kinds[type(v)]}" for n, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema)


def fitted_on(final: str) -> str:
    """Check query over the training part of the prepared table."""
    return with_txn(*PREPARED_SQL, FEATURES_SQL, final + " FROM features WHERE split = 'train'")


POSITIVES = "count(*) FILTER (is_fraud)"
UNDERSAMPLED = f"""SELECT least(count(*) - {POSITIVES}, 20 * {POSITIVES}) + {POSITIVES} AS fit_rows,
 {POSITIVES} AS fit_fraud_rows, true AS ranks_well"""


def fit_query(spark, folder, kind, params) -> DataFrame:
    table = features(spark, folder)
    chosen = fit_rows(kind, table, params, 42)
    model = fit(kind, chosen, params)
    counts = chosen.df.agg(F.count("*"), F.count_if("is_fraud")).first()
    return one_row(spark, fit_rows=counts[0], fit_fraud_rows=counts[1], ranks_well=auc(table, model) > 0.75)


@query("linear_fit_logloss", fitted_on(UNDERSAMPLED))
def linear_fit_logloss(spark, folder):
    return fit_query(spark, folder, LINEAR, {**param_grid(LINEAR, "fast")[0], "loss": "log_loss"})


@query("linear_fit_huber", fitted_on(UNDERSAMPLED))
def linear_fit_huber(spark, folder):
    return fit_query(spark, folder, LINEAR, param_grid(LINEAR, "fast")[0])


@query("kernel_fit", fitted_on(UNDERSAMPLED))
def kernel_fit(spark, folder):
    return fit_query(spark, folder, KERNEL, param_grid(KERNEL, "fast")[0])


@query("rff_map", """SELECT vec_id, CAST(400 AS BIGINT) AS dimensions, true AS unit_length, true AS near_kernel
 FROM embeddings""")
def rff_map(spark, folder):
    """Map every embedding; z(x).z(c) must be close to the kernel value against one fixed point c."""
    table = load(spark, folder, "embeddings")
    names = [f"x{i}" for i in range(64)]
    flat = table.select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    mapping = FourierMap.draw(names, 1.0, 400)
    centre = list(flat.agg(*[F.avg(n) for n in names]).first())
    z_centre = mapping.z(np.array([centre]))[0]
    squared = sum(((F.col(n) - F.lit(c)) ** 2 for n, c in zip(names, centre)), F.lit(0.0))
    mapped = flat.select("vec_id", mapping.mapped().alias("z"), F.exp(-squared).alias("kernel"))
    total = lambda column: F.aggregate(column, F.lit(0.0), lambda a, v: a + v)
    weights = F.array(*[F.lit(float(v)) for v in z_centre])
    dot = total(F.zip_with("z", weights, lambda a, b: a * b))
    length = total(F.transform("z", lambda v: v * v))
    return mapped.select(
        "vec_id",
        F.size("z").cast("bigint").alias("dimensions"),
        (F.abs(length - 1) < 0.25).alias("unit_length"),
        (F.abs(dot - F.col("kernel")) < 0.25).alias("near_kernel"),
    )


@query("oneclass_fit", fitted_on(f"""SELECT count(*) FILTER (NOT is_fraud) AS fit_rows, true AS flags_nu_of_fit_rows,
 true AS ranks_above_chance"""))
def oneclass_fit(spark, folder):
    table = features(spark, folder)
    normal = table.normal()
    model = fit(ONE_CLASS, normal, param_grid(ONE_CLASS, "fast")[0])
    row = scores(normal, model).df.agg(F.count("*"), F.avg((F.col("score") >= 0).cast("double"))).first()
    return one_row(
        spark, fit_rows=row[0], flags_nu_of_fit_rows=abs(row[1] - NU) < 2.0 / row[0],
        ranks_above_chance=auc(table, model) > 0.6,
    )


# Models of given numbers: a weight per feature, and four Fourier features.
LINEAR_WEIGHTS = [(i % 5 - 2) / 4 for i in range(len(ALL_FEATURES))]
FREQUENCIES = [[((3 * i + 5 * j) % 7 - 3) / 10 for j in range(4)] for i in range(len(ALL_FEATURES))]
PHASES, FOURIER_WEIGHTS = [j / 2 for j in range(4)], [0.25, -0.5, 0.75, -1.0]


def sum_sql(weights) -> str:
    return " + ".join(f"({w!r}) * {n}" for w, n in zip(weights, ALL_FEATURES))


FOURIER_SQL = " + ".join(
    f"({w!r}) * sqrt(0.5) * cos({sum_sql([row[j] for row in FREQUENCIES])} + {PHASES[j]!r})" for j, w in enumerate(FOURIER_WEIGHTS)
)


@query("score", fitted_on(f"SELECT txn_id, is_fraud, {r(f'0.25 + {sum_sql(LINEAR_WEIGHTS)}')} AS linear, {r(f'-(({FOURIER_SQL}) - 0.1)')} AS kernel"))
def score(spark, folder):
    table = features(spark, folder)
    linear = LinearModel(ALL_FEATURES, tuple(LINEAR_WEIGHTS), 0.25)
    mapping = FourierMap(ALL_FEATURES, 1.0, np.array(FREQUENCIES), np.array(PHASES))
    kernel = KernelModel(mapping, np.array(FOURIER_WEIGHTS), -0.1, -1.0)
    return table.df.select(ID, "is_fraud", linear.score().alias("linear"), kernel.score().alias("kernel"))


@query("fit_final", fitted_on(f"""SELECT count(*) AS scored_rows, 'unsupervised_oneclass_rbf_svm' AS model_type,
 CAST({len(ALL_FEATURES)} AS BIGINT) AS features, 'non_fraud_only' AS fit_scope, CAST(0.25 AS DOUBLE) AS threshold"""))
def fit_final_query(spark, folder):
    table = features(spark, folder)
    done = fit_final(ONE_CLASS, table, param_grid(ONE_CLASS, "fast")[0], 0.25)
    rows = art.with_prediction(art.with_score(table.df, done), done).where("predicted is not null").count()
    return one_row(
        spark, scored_rows=rows, model_type=done.model_type, features=len(done.columns()),
        fit_scope=done.fit_scope, threshold=done.threshold,
    )


@query("model_save_load", fitted_on("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing, CAST(0.5 AS DOUBLE) AS threshold"))
def model_save_load(spark, folder):
    table = features(spark, folder)
    params = {**param_grid(KERNEL, "fast")[0]}
    model = fit(KERNEL, fit_rows(KERNEL, table, params, 42), params)
    path = scratch_path(spark, "model")
    art.save(spark, art.Artifact(model, art.KERNEL, 0.5, table.columns, params), path)
    loaded = art.load(spark, path)
    both = table.df.select(model.score().alias("before"), loaded.score().alias("after"))
    row = both.agg(F.count("*"), F.count_if(F.abs(F.col("before") - F.col("after")) > 1e-9)).first()
    return one_row(spark, rows=row[0], differing=row[1], threshold=loaded.threshold)


TUNING_SQL = (
    *PREPARED_SQL, FEATURES_SQL, "learning AS (SELECT txn_id, is_fraud FROM features WHERE split = 'train')",
    quota_sql("learning", "ceil((SELECT count(*) FROM learning) * 0.2::DOUBLE)", "valid"),
    """sizes AS (SELECT sum(quota) AS scored_rows, sum(quota) FILTER (is_fraud) AS scored_fraud_rows,
     (SELECT count(*) FILTER (is_fraud) FROM learning) - sum(quota) FILTER (is_fraud) AS p,
     (SELECT count(*) FILTER (NOT is_fraud) FROM learning) - sum(quota) FILTER (NOT is_fraud) AS n FROM valid)""",
)


def tuning_sql(names, grid, fit_rows: str, fraud_rows: str | None = None) -> str:
    """Every grid point with the rows it must have learned from and been judged on."""
    points = ", ".join("(" + ", ".join(f"'{p[n]}'" for n in names) + ")" for p in grid)
    extra = "" if fraud_rows is None else f", CAST({fraud_rows} AS BIGINT) AS fit_fraud_rows"
    return with_txn(*TUNING_SQL, f"grid({', '.join(names)}) AS (VALUES {points})", f"""SELECT {', '.join(names)},
     CAST({fit_rows} AS BIGINT) AS fit_rows{extra}, CAST(scored_rows AS BIGINT) AS scored_rows,
     CAST(scored_fraud_rows AS BIGINT) AS scored_fraud_rows, true AS measures_hold, true AS best_first FROM grid, sizes""")


def tuned(spark, folder, kind, grid, names) -> DataFrame:
    """Grid points, rows learned from, rows counted, whether measures follow from the counts and the report is in order."""
    table = features(spark, folder)
    _, _, results = tune(kind, table, grid)
    first = [r["f1"] for r in tuning_report(spark, results).collect()]
    rows = []
    for found in results:
        tn, fp, fn, tp = (found[c] for c in ev.COUNTS)
        hold = abs(found["recall"] - tp / (tp + fn)) < 1e-9 and abs(found["false_positive_rate"] - fp / (fp + tn)) < 1e-9
        own = [found["fit_fraud_rows"]] if kind != ONE_CLASS else []
        rows.append((
            *[str(found[n]) for n in names], found["fit_rows"], *own, tn + fp + fn + tp, tp + fn, hold,
            first == sorted(first, reverse=True),
        ))
    counted = "fit_rows long, " + ("fit_fraud_rows long, " if kind != ONE_CLASS else "") + "scored_rows long, scored_fraud_rows long"
    schema = ", ".join(f"{n} string" for n in names) + f", {counted}, measures_hold boolean, best_first boolean"
    return spark.createDataFrame(rows, schema)


LINEAR_NAMES = ("loss", "alpha", "penalty", "fraud_weight", "non_fraud_ratio")
LINEAR_ROWS = ("p + least(n, CAST(non_fraud_ratio AS BIGINT) * p)", "p")
REPORTED_SQL = ", ".join(
    f"('{p['loss']}', {p['alpha']!r}::DOUBLE, {p['fraud_weight']}::DOUBLE, {p['non_fraud_ratio']}::DOUBLE)" for p in param_grid(LINEAR)
)


@query("tune_supervised", tuning_sql(LINEAR_NAMES, param_grid(LINEAR), *LINEAR_ROWS))
def tune_supervised(spark, folder):
    return tuned(spark, folder, LINEAR, param_grid(LINEAR), LINEAR_NAMES)


KERNEL_NAMES = ("C", "gamma", "fraud_weight", "non_fraud_ratio")


@query("tune_kernel", tuning_sql(KERNEL_NAMES, param_grid(KERNEL), *LINEAR_ROWS))
def tune_kernel(spark, folder):
    return tuned(spark, folder, KERNEL, param_grid(KERNEL), KERNEL_NAMES)


@query("tune_oneclass", tuning_sql(("kernel", "nu", "gamma"), param_grid(ONE_CLASS), "n"))
def tune_oneclass(spark, folder):
    return tuned(spark, folder, ONE_CLASS, param_grid(ONE_CLASS), ("kernel", "nu", "gamma"))


@query(
    "tuning_report",
    with_txn(*TUNING_SQL, f"""SELECT loss, alpha, fraud_weight, non_fraud_ratio,
     CAST(p + least(n, non_fraud_ratio * p) AS DOUBLE) AS fit_rows, true AS in_range
     FROM sizes, (VALUES {REPORTED_SQL}) v(loss, alpha, fraud_weight, non_fraud_ratio)"""),
)
def tuning_report_query(spark, folder):
    _, _, results = tune(LINEAR, features(spark, folder), param_grid(LINEAR))
    report = tuning_report(spark, results)
    measures = ("recall", "false_positive_rate", "precision", "f1", "average_precision", "roc_auc", "predicted_fraud_rate")
    inside = reduce(and_, [F.col(m).between(0, 1) for m in measures])
    return report.select("loss", "alpha", "fraud_weight", "non_fraud_ratio", "fit_rows", inside.alias("in_range"))


SCOPES = {LINEAR: None, KERNEL: None, ONE_CLASS: "non_fraud_only"}
KINDS_SQL = ", ".join(
    f"('{k}', '{MODEL_TYPES[k]}', {'NULL' if s is None else repr(s)})" for k, s in SCOPES.items()
)


@query("train_job", fitted_on(f"""SELECT kind, model_type, CAST({len(ALL_FEATURES)} AS BIGINT) AS features,
 fit_scope, count(*) AS scored_rows, CAST(0 AS BIGINT) AS differing_after_reload, true AS chosen_from_grid""").replace(
    " FROM features WHERE split = 'train'",
    f" FROM features, (VALUES {KINDS_SQL}) k(kind, model_type, fit_scope) WHERE split = 'train' GROUP BY ALL",
))
def train_job(spark, folder):
    """All three models, each from its whole default grid, saved and loaded again."""
    table = features(spark, folder)
    path = scratch_path(spark, "models")
    trained = detect.train(table, ["all"], "default", folder=path)
    rows = []
    for kind, result in trained.items():
        saved, loaded = result.artifact, art.load(spark, f"{path}/{kind}")
        both = table.df.select(saved.score().alias("a"), loaded.score().alias("b"))
        n, differing = both.agg(F.count("a"), F.count_if(F.abs(F.col("a") - F.col("b")) > 1e-9)).first()
        in_grid = saved.params in param_grid(kind) and result.tuning.count() == len(param_grid(kind))
        rows.append((
            kind, loaded.model_type, len(loaded.columns()), loaded.fit_scope, n,
            differing + (loaded.threshold != saved.threshold), in_grid,
        ))
    return spark.createDataFrame(
        rows, "kind string, model_type string, features long, fit_scope string, scored_rows long, "
        "differing_after_reload long, chosen_from_grid boolean",
    )


@query(
    "evaluate_job",
    with_txn(*PREPARED_SQL, f"""SELECT kind, count(*) AS rows, count(*) FILTER (s.is_fraud) AS fraud_rows,
     round(sum(c.amt) FILTER (s.is_fraud), 2) AS total_fraud_amount, count(*) AS curve_rows, true AS reports_agree
     FROM scaled s JOIN clean c ON s.txn_id = c.txn_id, (VALUES ('linear'), ('kernel'), ('oneclass')) k(kind)
     WHERE split = 'test' GROUP BY kind"""),
)
def evaluate_job(spark, folder):
    """All three models trained, then evaluated with every report written."""
    done = prepared(spark, folder)
    train, test = materialise(done.train), materialise(done.test)
    trained = detect.train(detect.feature_table(train, ID), ["all"], "fast")
    path = scratch_path(spark, "evaluation")
    rows = []
    for kind, result in trained.items():
        report = detect.evaluate(test, train, done.reduced, result.artifact, ID, folder=path)
        value = {r["metric"]: r["value"] for r in report.summary.collect()}
        counted = [int(value[c]) for c in ev.COUNTS]
        written = spark.read.option("header", True).csv(f"{path}/{result.artifact.model_type}/thresholds").count()
        end = report.pr_curve.agg(F.max("recall"), F.min("precision")).first()
        agree = written == report.thresholds.count() and abs(end[0] - 1) < 1e-9 and 0 < value["auprc"] <= 1
        rows.append((
            kind, sum(counted), counted[2] + counted[3], round(value["total_fraud_amount"], 2),
            report.loss_capture.count(), agree,
        ))
    return spark.createDataFrame(
        rows, "kind string, rows long, fraud_rows long, total_fraud_amount double, curve_rows long, reports_agree boolean",
    )
