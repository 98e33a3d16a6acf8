"""Measures of a score. The amount itself serves as the score, so plain SQL can check every number."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlight.models.tuning import selection_score
from ledgerlight.operators import evaluate as ev
from ledgerlight.operators.quantiles import grid_points
from ledgerlight.queries.base import SCORED_SQL, query, r, txn, unscaled, with_txn
from ledgerlight.queries.profiling import grid_sql
from ledgerlight.schema import EVAL_GRID_POINTS, GRID_SPAN, TRAIN_GRID_POINTS
from ledgerlight.session import scratch_path
from ledgerlight.sources.tables import write_report
from ledgerlight.sources.txn import ID

THRESHOLD = 150.0


def scored(spark, folder) -> ev.Scored:
    return ev.Scored(unscaled(txn(spark, folder)), key=ID)


COUNTS_SQL = """count(*) FILTER (NOT is_fraud AND NOT hit) AS tn, count(*) FILTER (NOT is_fraud AND hit) AS fp,
 count(*) FILTER (is_fraud AND NOT hit) AS fn, count(*) FILTER (is_fraud AND hit) AS tp,
 coalesce(sum(amt) FILTER (is_fraud), 0) AS total_fraud_amount,
 coalesce(sum(amt) FILTER (is_fraud AND hit), 0) AS captured_fraud_amount"""


def ratio_sql(part: str, whole: str) -> str:
    return f"CASE WHEN ({whole}) <> 0 THEN ({part}) / CAST(({whole}) AS DOUBLE) ELSE 0.0 END"


RATES = {
    "accuracy": ratio_sql("tp + tn", "tp + tn + fp + fn"),
    "recall": ratio_sql("tp", "tp + fn"),
    "false_positive_rate": ratio_sql("fp", "fp + tn"),
    "precision": ratio_sql("tp", "tp + fp"),
    "f1_score": ratio_sql("2 * tp", "2 * tp + fp + fn"),
    "predicted_fraud_rate": ratio_sql("tp + fp", "tp + tn + fp + fn"),
    "fraud_loss_capture_rate": ratio_sql("captured_fraud_amount", "total_fraud_amount"),
}
HIT_SQL = f"hits AS (SELECT *, score >= {THRESHOLD} AS hit FROM scored)"
CONFUSED_SQL = f"confused AS (SELECT {COUNTS_SQL} FROM hits)"
RATED_SQL = "rated AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in RATES.items()) + " FROM confused)"


@query("predict_threshold", with_txn(SCORED_SQL, HIT_SQL, "SELECT txn_id, hit AS predicted FROM hits"))
def predict_threshold(spark, folder):
    return scored(spark, folder).predicted(THRESHOLD).select(ID, "predicted")


@query("confusion_matrix", with_txn(SCORED_SQL, HIT_SQL, CONFUSED_SQL, "SELECT tn, fp, fn, tp FROM confused"))
def confusion_matrix(spark, folder):
    return ev.confusion(scored(spark, folder), THRESHOLD).select(*ev.COUNTS)


@query(
    "classification_metrics",
    with_txn(SCORED_SQL, HIT_SQL, CONFUSED_SQL, RATED_SQL, f"""SELECT {r('accuracy')} AS accuracy, {r('recall')} AS recall,
    {r('false_positive_rate')} AS false_positive_rate, {r('precision')} AS precision, {r('f1_score')} AS f1_score,
    {r('predicted_fraud_rate')} AS predicted_fraud_rate FROM rated"""),
)
def classification_metrics(spark, folder):
    return ev.rates(ev.confusion(scored(spark, folder), THRESHOLD)).select(
        "accuracy", "recall", "false_positive_rate", "precision", "f1_score", "predicted_fraud_rate"
    )


@query(
    "fraud_loss_capture",
    with_txn(SCORED_SQL, HIT_SQL, CONFUSED_SQL, RATED_SQL, f"""SELECT {r('total_fraud_amount', 4)} AS total_fraud_amount,
    {r('captured_fraud_amount', 4)} AS captured_fraud_amount, {r('fraud_loss_capture_rate', 4)} AS fraud_loss_capture_rate
    FROM rated"""),
    digits=4,
)
def fraud_loss_capture(spark, folder):
    return ev.rates(ev.confusion(scored(spark, folder), THRESHOLD)).select(
        "total_fraud_amount", "captured_fraud_amount", "fraud_loss_capture_rate"
    )


CUMULATED_SQL = """
by_score AS (SELECT score, count(*) FILTER (is_fraud) AS pos, count(*) FILTER (NOT is_fraud) AS neg FROM scored GROUP BY 1),
cumulated AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
 sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM by_score)"""
AP_SQL = "(SELECT sum(pos * tp / CAST(tp + fp AS DOUBLE)) / sum(pos) FROM cumulated)"
AUC_SQL = "(SELECT sum(neg * (tp - pos / 2.0)) / CAST(any_value(p) AS DOUBLE) / any_value(n) FROM cumulated)"


@query("average_precision", with_txn(SCORED_SQL, CUMULATED_SQL, f"SELECT {r(AP_SQL)} AS average_precision"))
def average_precision(spark, folder):
    return ev.ranking_metrics(scored(spark, folder)).select("average_precision")


@query("roc_auc", with_txn(SCORED_SQL, CUMULATED_SQL, f"SELECT {r(AUC_SQL)} AS roc_auc"))
def roc_auc(spark, folder):
    return ev.ranking_metrics(scored(spark, folder)).select("roc_auc")


@query(
    "pr_curve",
    with_txn(SCORED_SQL, CUMULATED_SQL, f"""SELECT {r('score')} AS threshold, {r('tp / CAST(tp + fp AS DOUBLE)')} AS precision,
    {r('tp / CAST(p AS DOUBLE)')} AS recall FROM cumulated UNION ALL SELECT NULL, 1.0, 0.0"""),
)
def pr_curve(spark, folder):
    return ev.pr_curve(scored(spark, folder))


@query(
    "roc_curve",
    with_txn(SCORED_SQL, CUMULATED_SQL, f"""SELECT {r('score')} AS threshold, {r('fp / CAST(n AS DOUBLE)')} AS fpr,
    {r('tp / CAST(p AS DOUBLE)')} AS tpr FROM cumulated UNION ALL SELECT NULL, 0.0, 0.0"""),
)
def roc_curve(spark, folder):
    return ev.roc_curve(scored(spark, folder))


@query(
    "loss_capture_curve",
    with_txn(SCORED_SQL, f"""SELECT txn_id,
    {r('100.0 * row_number() OVER (ORDER BY score DESC, txn_id DESC) / count(*) OVER ()')} AS flagged_percent,
    {r('100.0 * sum(CASE WHEN is_fraud THEN amt ELSE 0 END) OVER (ORDER BY score DESC, txn_id DESC) / sum(CASE WHEN is_fraud THEN amt ELSE 0 END) OVER ()')}
    AS captured_percent FROM scored"""),
)
def loss_capture_curve(spark, folder):
    return ev.loss_capture_curve(scored(spark, folder))


def sweep_sql(points: int, table: str = "swept") -> str:
    """Every threshold applied to every row, the plain way."""
    grid = grid_sql(grid_points(points, *GRID_SPAN))
    rates = ", ".join(f"{e} AS {n}" for n, e in RATES.items())
    return f"""
thresholds AS (SELECT DISTINCT threshold FROM (SELECT unnest(quantile_cont(score, {grid})) AS threshold FROM scored
 UNION ALL SELECT 0.0)),
applied AS (SELECT threshold, {COUNTS_SQL} FROM (SELECT threshold, is_fraud, amt, score >= threshold AS hit
 FROM thresholds, scored) GROUP BY threshold),
{table} AS (SELECT *, {rates} FROM applied)"""


TRAIN_REPORT = [SCORED_SQL, CUMULATED_SQL, sweep_sql(TRAIN_GRID_POINTS), f"""report AS (SELECT threshold, tn, fp, fn, tp,
 recall, false_positive_rate, precision, f1_score AS f1, {AP_SQL} AS average_precision, {AUC_SQL} AS roc_auc,
 predicted_fraud_rate FROM swept)"""]
TRAIN_COLUMNS = "tn, fp, fn, tp, " + ", ".join(
    f"{r(c)} AS {c}" for c in ("threshold", "recall", "false_positive_rate", "precision", "f1", "average_precision",
                               "roc_auc", "predicted_fraud_rate"))


@query("threshold_report_train", with_txn(*TRAIN_REPORT, f"SELECT {TRAIN_COLUMNS} FROM report"))
def threshold_report_train(spark, folder):
    return ev.training_report(scored(spark, folder))


EVAL_NAMES = ("threshold", "recall", "false_positive_rate", "precision", "f1_score", "fraud_loss_capture_rate",
              "predicted_fraud_rate")
EVAL_COLUMNS = ", ".join(f"{r(c)} AS {c}" for c in EVAL_NAMES) + """,
 tp + fp AS fraud_predictions, tp AS true_fraud_captured"""
EVAL_REPORT = [SCORED_SQL, sweep_sql(EVAL_GRID_POINTS)]


@query("threshold_report_eval", with_txn(*EVAL_REPORT, f"SELECT {EVAL_COLUMNS} FROM swept"))
def threshold_report_eval(spark, folder):
    return ev.evaluation_report(scored(spark, folder))


@query("sink_report", with_txn(*EVAL_REPORT, f"SELECT {EVAL_COLUMNS} FROM swept"))
def sink_report(spark, folder):
    report = ev.evaluation_report(scored(spark, folder))
    path = scratch_path(spark, "report")
    write_report(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query(
    "select_threshold",
    with_txn(*TRAIN_REPORT, f"""SELECT {TRAIN_COLUMNS} FROM (SELECT * FROM report ORDER BY recall >= 0.8 DESC,
    CASE WHEN recall >= 0.8 THEN false_positive_rate END, CASE WHEN recall >= 0.8 THEN precision END DESC,
    f1 DESC, threshold LIMIT 1)"""),
)
def select_threshold(spark, folder):
    return ev.select_threshold(ev.training_report(scored(spark, folder)))


def operating_sql(goal: float) -> str:
    return f"""SELECT CAST({goal} AS DOUBLE) AS goal, {EVAL_COLUMNS} FROM (SELECT * FROM swept WHERE recall >= {goal}
    AND false_positive_rate <= 0.02 ORDER BY round(f1_score, 12) DESC, precision DESC, fraud_loss_capture_rate DESC,
    threshold LIMIT 1)"""


@query("select_operating_threshold", with_txn(*EVAL_REPORT, f"{operating_sql(0.8)} UNION ALL {operating_sql(0.5)}"))
def select_operating_threshold(spark, folder):
    # the amount alone does not reach the default recall goal: that part has no row
    report = ev.evaluation_report(scored(spark, folder))
    chosen = [
        ev.select_operating_threshold(report, **({} if goal == 0.8 else {"recall": goal})).withColumn("goal", F.lit(goal))
        for goal in (0.8, 0.5)
    ]
    return chosen[0].unionByName(chosen[1])


@query(
    "selection_score",
    with_txn(*TRAIN_REPORT, f"""SELECT {r('threshold')} AS threshold, {r('CASE WHEN recall >= 0.8 THEN 10 - false_positive_rate + precision ELSE recall END')}
    AS selection FROM report"""),
)
def selection(spark, folder):
    report = ev.training_report(scored(spark, folder))
    score = selection_score(F.col("recall"), F.col("false_positive_rate"), F.col("precision"))
    return report.select("threshold", score.alias("selection"))


@query(
    "evaluation_summary",
    with_txn(SCORED_SQL, CUMULATED_SQL, HIT_SQL, CONFUSED_SQL, RATED_SQL,
             " UNION ALL ".join(
                 f"SELECT {i} AS position, '{n}' AS metric, {r(f'CAST({dict(auprc=AP_SQL, roc_auc=AUC_SQL).get(n, n)} AS DOUBLE)', 4)} AS value FROM rated"
                 for i, n in enumerate(ev.SUMMARY_ORDER))),
    digits=4,
)
def evaluation_summary(spark, folder):
    return ev.summary(scored(spark, folder), THRESHOLD)
