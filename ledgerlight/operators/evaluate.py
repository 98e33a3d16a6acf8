"""Measures of a score against a label: confusion counts, curves, threshold sweeps, captured loss.

Input is one row per transaction with a boolean label, a score, an amount and a unique key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.operators.ordered import running_totals
from ledgerlight.operators.quantiles import exact_quantiles, grid_points, interval_index
from ledgerlight.schema import EVAL_GRID_POINTS, FPR_GOAL, GRID_SPAN, RECALL_GOAL, TRAIN_GRID_POINTS

COUNTS = ("tn", "fp", "fn", "tp")
# The order in which measures are reported.
SUMMARY_ORDER = (
    "tn", "fp", "fn", "tp", "accuracy", "recall", "false_positive_rate", "precision", "f1_score",
    "auprc", "roc_auc", "predicted_fraud_rate", "total_fraud_amount", "captured_fraud_amount",
    "fraud_loss_capture_rate",
)


@dataclass(frozen=True)
class Scored:
    """A scored table and the names of its columns."""

    df: DataFrame
    label: str = "is_fraud"
    score: str = "score"
    amount: str = "amt"
    key: str = "trans_num"

    def value(self) -> Column:
        """The score. A row without one would vanish from every count, so it fails the job instead."""
        score = F.col(self.score).cast("double")
        told = F.concat(F.lit("no score for "), F.coalesce(F.col(self.key).cast("string"), F.lit("a row without a key")))
        return F.when(score.isNull() | F.isnan(score), F.raise_error(told).cast("double")).otherwise(score)

    def predicted(self, threshold: float) -> DataFrame:
        """Flag every row whose score reaches the threshold."""
        return self.df.withColumn("predicted", F.col(self.score) >= F.lit(float(threshold)))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing to divide by."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def confusion(scored: Scored, threshold: float) -> DataFrame:
    """tn, fp, fn, tp and the total and captured positive amount in one aggregate."""
    truth, flagged = F.col(scored.label), scored.value() >= F.lit(float(threshold))
    amount = F.col(scored.amount)
    count = lambda c: F.count_if(c).cast("bigint")
    return scored.df.agg(
        count(~truth & ~flagged).alias("tn"),
        count(~truth & flagged).alias("fp"),
        count(truth & ~flagged).alias("fn"),
        count(truth & flagged).alias("tp"),
        F.coalesce(F.sum(F.when(truth, amount)), F.lit(0.0)).alias("total_fraud_amount"),
        F.coalesce(F.sum(F.when(truth & flagged, amount)), F.lit(0.0)).alias("captured_fraud_amount"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Add the usual rates to rows that carry tn, fp, fn and tp."""
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    with_rates = counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "recall": ratio(tp, tp + fn),
            "false_positive_rate": ratio(fp, fp + tn),
            "precision": ratio(tp, tp + fp),
            "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
            "predicted_fraud_rate": ratio(tp + fp, tp + tn + fp + fn),
        }
    )
    if "total_fraud_amount" not in counts.columns:
        return with_rates
    share = ratio(F.col("captured_fraud_amount"), F.col("total_fraud_amount"))
    return with_rates.withColumn("fraud_loss_capture_rate", share)


def ranked_totals(ranked: DataFrame) -> tuple[int, int]:
    row = ranked.agg(F.sum("pos"), F.sum("neg")).first()
    return row[0] or 0, row[1] or 0


def ranked_rows(scored: Scored) -> DataFrame:
    """Every row with what is flagged, caught and captured down to it, the highest score first, ties by key.

    One ranking that serves all curves; write it down if more than one of them is wanted.
    """
    loss = F.coalesce(F.when(F.col(scored.label), F.col(scored.amount)), F.lit(0.0))
    slim = scored.df.select(
        F.col(scored.key), scored.value().alias("score"), loss.alias("loss"), F.col(scored.label).cast("int").alias("positive"),
    )
    order = [F.desc("score"), F.desc(scored.key)]
    return running_totals(slim, order, {"flagged": F.lit(1), "tp": "positive", "captured": "loss"}, scored.df.count())


def ranked_scores(scored: Scored, ranking: DataFrame | None = None) -> DataFrame:
    """One row per distinct score: positives and negatives at it, and at it or above.

    ``ranking`` is what ranked_rows gave, if that has been worked out already; then nothing is sorted again.
    """
    if ranking is not None:
        tp, flagged = F.max("tp"), F.max("flagged")
        return ranking.groupBy("score").agg(
            F.sum("positive").alias("pos"), F.sum(1 - F.col("positive")).alias("neg"), tp.alias("tp"), (flagged - tp).alias("fp"),
        )
    truth = F.col(scored.label)
    grouped = scored.df.groupBy(scored.value().alias("score")).agg(
        F.count_if(truth).cast("bigint").alias("pos"), F.count_if(~truth).cast("bigint").alias("neg")
    )
    return running_totals(grouped, [F.desc("score")], {"tp": "pos", "fp": "neg"}, scored.df.count())


def ranking_metrics(scored: Scored, ranked: DataFrame | None = None) -> DataFrame:
    """Average precision (step sum) and the tie-aware area under the ROC curve, as one row.

    Here and below, ``ranked`` is what ranked_scores gave, if that has been worked out already.
    """
    step = F.col("pos") * F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")
    area = F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0))
    sums = (ranked or ranked_scores(scored)).agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum(step).alias("steps"), F.sum(area).alias("area")
    )
    both = (F.col("p") > 0) & (F.col("n") > 0)
    return sums.select(
        ratio(F.col("steps"), F.col("p")).alias("average_precision"),
        F.when(both, F.col("area") / (F.col("p").cast("double") * F.col("n"))).alias("roc_auc"),
    )


def pr_curve(scored: Scored, ranked: DataFrame | None = None) -> DataFrame:
    """Precision and recall at each distinct score, and the end point (precision 1, recall 0)."""
    ranked = ranked or ranked_scores(scored)
    positives, _ = ranked_totals(ranked)
    points = ranked.select(
        F.col("score").alias("threshold"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        (ratio(F.col("tp"), F.lit(positives)) if positives else F.lit(1.0)).alias("recall"),
    )
    end = scored.df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)


def roc_curve(scored: Scored, ranked: DataFrame | None = None) -> DataFrame:
    """False and true positive rate at each distinct score, from the origin."""
    ranked = ranked or ranked_scores(scored)
    positives, negatives = ranked_totals(ranked)
    points = ranked.select(
        F.col("score").alias("threshold"),
        ratio(F.col("fp"), F.lit(negatives)).alias("fpr"),
        ratio(F.col("tp"), F.lit(positives)).alias("tpr"),
    )
    start = scored.df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(start)


def loss_capture_curve(scored: Scored, ranking: DataFrame | None = None) -> DataFrame:
    """Highest scores first: percent of rows flagged against percent of the positive amount captured.

    ``ranking`` is what ranked_rows gave, if that has been worked out already.
    """
    ranked = ranked_rows(scored) if ranking is None else ranking
    ends = ranked.agg(F.count("*").alias("rows"), F.sum("loss").alias("loss")).first()
    return ranked.select(
        scored.key,
        (F.col("flagged") * 100.0 / F.lit(float(ends["rows"]))).alias("flagged_percent"),
        (F.col("captured") * 100.0 / F.lit(float(ends["loss"]))
         if ends["loss"] else F.lit(0.0)).alias("captured_percent"),
    )


def score_thresholds(scored: Scored, points: int) -> list[float]:
    """Evenly spaced exact score quantiles and zero, without repeats."""
    return with_zero(exact_quantiles(scored.df, {"score": scored.value()}, grid_points(points, *GRID_SPAN))["score"])


def with_zero(found: Sequence[float | None]) -> list[float]:
    return sorted({v for v in found if v is not None} | {0.0})


def sweep(scored: Scored, thresholds: Sequence[float]) -> DataFrame:
    """Counts and rates at every threshold, from one pass over the rows.

    Each row is counted once, in the interval between two thresholds it lies in. What a threshold
    flags is then the sum of all intervals above it, taken over as many rows as there are thresholds.
    """
    edges = [-math.inf, *thresholds, math.inf]
    truth = F.col(scored.label)
    slim = scored.df.select(
        scored.value().alias("score"),
        truth.alias("truth"),
        F.when(truth, F.col(scored.amount)).alias("loss"),
    )
    slots = interval_index(slim, "score", edges, "slot").groupBy("slot").agg(
        F.count_if("truth").cast("bigint").alias("pos"),
        F.count_if(~F.col("truth")).cast("bigint").alias("neg"),
        F.coalesce(F.sum("loss"), F.lit(0.0)).alias("loss"),
    )
    every = scored.df.sparkSession.createDataFrame(
        [(i, None if i == 0 else float(edges[i])) for i in range(len(edges) - 1)], "slot int, threshold double"
    )
    filled = every.join(F.broadcast(slots), "slot", "left").na.fill(0, ["pos", "neg", "loss"])
    above = Window.orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, 0)  # one row per threshold
    whole = Window.orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = filled.select(
        "threshold",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("loss").over(above).alias("captured_fraud_amount"),
        F.sum("pos").over(whole).alias("_p"),
        F.sum("neg").over(whole).alias("_n"),
        F.sum("loss").over(whole).alias("total_fraud_amount"),
    ).where(F.col("threshold").isNotNull())
    counted = summed.withColumns({"fn": F.col("_p") - F.col("tp"), "tn": F.col("_n") - F.col("fp")}).drop("_p", "_n")
    return rates(counted)


def training_report(scored: Scored, thresholds: Sequence[float] | None = None) -> DataFrame:
    """Sweep used while tuning. Average precision and AUC do not depend on the threshold: computed once."""
    ranking = ranking_metrics(scored).first()
    report = sweep(scored, score_thresholds(scored, TRAIN_GRID_POINTS) if thresholds is None else thresholds)
    return report.select(
        "threshold", *COUNTS, "recall", "false_positive_rate", "precision", F.col("f1_score").alias("f1"),
        F.lit(ranking["average_precision"]).cast("double").alias("average_precision"),
        F.lit(ranking["roc_auc"]).cast("double").alias("roc_auc"),
        "predicted_fraud_rate",
    )


def training_reports(scored: Scored, names: Sequence[str], thresholds: Sequence[Sequence[float]]) -> DataFrame:
    """The training reports of many scores of the same rows, ``names`` being their columns: (point, ...) for each.

    One aggregate counts all (score column, interval between thresholds) cells, and one ranking orders all
    (score column, score) pairs; the number of jobs doesn't depend on the number of scores.
    """
    spark, truth, points = scored.df.sparkSession, F.col(scored.label), range(len(names))
    values = [Scored(scored.df, scored.label, n, key=scored.key).value() for n in names]
    wide = scored.df.select(truth.alias("truth"), *[v.alias(f"v{i}") for i, v in enumerate(values)])
    pos, neg = F.count_if("truth").cast("bigint").alias("pos"), F.count_if(~F.col("truth")).cast("bigint").alias("neg")

    each = F.array(*[F.struct(F.lit(i).alias("point"), F.col(f"v{i}").alias("score")) for i in points])
    ties = wide.select("truth", F.inline(each)).groupBy("point", "score").agg(pos, neg)
    totals = wide.agg(pos, neg).first()
    rows = len(names) * sum(totals)
    ranked = running_totals(ties, [F.asc("point"), F.desc("score")], {"tp": "pos", "fp": "neg"}, rows)
    # every point before has ranked the same rows
    own = {c: F.col(c) - F.col("point") * F.lit(n) for c, n in zip(("tp", "fp"), totals)}
    step = F.col("pos") * F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")
    area = F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0))
    ranking = ranked.withColumns(own).groupBy("point").agg(F.sum(step).alias("steps"), F.sum(area).alias("area")).select(
        "point",
        ratio(F.col("steps"), F.lit(totals["pos"])).alias("average_precision"),
        (F.col("area") / F.lit(float(totals["pos"]) * totals["neg"]) if totals["pos"] and totals["neg"] else
         F.lit(None).cast("double")).alias("roc_auc"),
    )

    edges = [[-math.inf, *t, math.inf] for t in thresholds]
    slotted = Bucketizer(
        splitsArray=edges, inputCols=[f"v{i}" for i in points], outputCols=[f"s{i}" for i in points],
    ).transform(wide)
    cells = F.array(*[F.struct(F.lit(i).alias("point"), F.col(f"s{i}").cast("int").alias("slot")) for i in points])
    slots = slotted.select("truth", F.inline(cells)).groupBy("point", "slot").agg(pos, neg)
    listed = [(i, n, None if n == 0 else float(own[n])) for i, own in enumerate(edges) for n in range(len(own) - 1)]
    every = spark.createDataFrame(listed, "point int, slot int, threshold double")
    filled = every.join(F.broadcast(slots), ["point", "slot"], "left").na.fill(0, ["pos", "neg"])
    above = Window.partitionBy("point").orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, 0)
    counted = filled.select(
        "point", "threshold", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
    ).where("threshold is not null").withColumns(
        {"fn": F.lit(totals["pos"]) - F.col("tp"), "tn": F.lit(totals["neg"]) - F.col("fp")}
    )
    return rates(counted).join(F.broadcast(ranking), "point").select(
        "point", "threshold", *COUNTS, "recall", "false_positive_rate", "precision", F.col("f1_score").alias("f1"),
        "average_precision", "roc_auc", "predicted_fraud_rate",
    )


def evaluation_report(scored: Scored) -> DataFrame:
    """Sweep reported for a finished model, ordered by threshold."""
    report = sweep(scored, score_thresholds(scored, EVAL_GRID_POINTS))
    return report.select(
        "threshold", "recall", "false_positive_rate", "precision", "f1_score", "fraud_loss_capture_rate",
        "predicted_fraud_rate", (F.col("tp") + F.col("fp")).alias("fraud_predictions"),
        F.col("tp").alias("true_fraud_captured"),
    ).orderBy("threshold")


def _threshold_order(goal: float) -> list[Column]:
    met = F.col("recall") >= F.lit(goal)
    only_if_met = lambda c: F.when(met, F.col(c))
    return [
        F.desc(met),
        only_if_met("false_positive_rate").asc(),
        only_if_met("precision").desc(),
        F.desc("f1"),
        F.desc("average_precision"),
        F.desc("roc_auc"),
        F.asc("threshold"),
    ]


def select_threshold(report: DataFrame, goal: float = RECALL_GOAL) -> DataFrame:
    """Recall goal met: lowest false positive rate, then precision, F1. Otherwise the best F1."""
    return report.orderBy(*_threshold_order(goal)).limit(1)


def select_thresholds(reports: DataFrame, by: str, goal: float = RECALL_GOAL) -> DataFrame:
    """The same choice in each group of rows that share ``by``; a group holds one row per threshold."""
    order = Window.partitionBy(by).orderBy(*_threshold_order(goal))
    return reports.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def select_operating_threshold(report: DataFrame, recall: float = RECALL_GOAL, fpr: float = FPR_GOAL) -> DataFrame:
    """Best F1, precision and captured loss among thresholds that meet both goals; no row if none does.

    Measures that agree to twelve digits count as equal.
    """
    candidates = report.where((F.col("recall") >= F.lit(recall)) & (F.col("false_positive_rate") <= F.lit(fpr)))
    order = ["f1_score", "precision", "fraud_loss_capture_rate"]
    return candidates.orderBy(*[F.desc(F.round(c, 12)) for c in order], "threshold").limit(1)


def metrics(scored: Scored, threshold: float, ranked: DataFrame | None = None) -> DataFrame:
    """All measures of one threshold as one row."""
    ranking = ranking_metrics(scored, ranked).first()
    row = rates(confusion(scored, threshold))
    return row.withColumns(
        {
            "auprc": F.lit(ranking["average_precision"]).cast("double"),
            "roc_auc": F.lit(ranking["roc_auc"]).cast("double"),
        }
    )


def summary(scored: Scored, threshold: float, ranked: DataFrame | None = None) -> DataFrame:
    """(position, metric, value) in the fixed reporting order."""
    row = metrics(scored, threshold, ranked)
    items = [
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
        for i, n in enumerate(SUMMARY_ORDER)
    ]
    return row.select(F.inline(F.array(*items)))
