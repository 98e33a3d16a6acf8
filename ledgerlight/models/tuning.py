"""Parameter search on a validation split, and the final fit."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.models import artifact as art
from ledgerlight.models.features import gamma_scale
from ledgerlight.models.kernel import KernelModel, fit_kernel_many, fit_one_class_many, with_scores
from ledgerlight.models.linear import LinearModel, Setting, fit_linear
from ledgerlight.operators import evaluate as ev
from ledgerlight.operators import sampling
from ledgerlight.operators.quantiles import exact_quantiles, grid_points
from ledgerlight.schema import GRID_SPAN, RECALL_GOAL, SEED, TEST_SHARE, TRAIN_GRID_POINTS

LINEAR, KERNEL, ONE_CLASS = "linear", "kernel", "oneclass"

# The search grids.
GRIDS = {
    ("fast", LINEAR): {
        "loss": ["modified_huber"], "alpha": [0.001], "penalty": ["l2"],
        "fraud_weight": [200], "non_fraud_ratio": [20],
    },
    ("default", LINEAR): {
        "loss": ["modified_huber", "log_loss"], "alpha": [0.001], "penalty": ["l2"],
        "fraud_weight": [50, 100, 200, 300], "non_fraud_ratio": [10, 20, 50],
    },
    ("fast", KERNEL): {
        "kernel": ["rbf"], "C": [1.0], "gamma": ["scale"], "fraud_weight": [20], "non_fraud_ratio": [20],
    },
    ("default", KERNEL): {
        "kernel": ["rbf"], "C": [0.5, 1.0, 2.0], "gamma": ["scale"], "fraud_weight": [10, 20],
        "non_fraud_ratio": [20],
    },
    ("fast", ONE_CLASS): {"kernel": ["rbf"], "nu": [0.05], "gamma": ["scale"]},
    ("default", ONE_CLASS): {"kernel": ["rbf"], "nu": [0.03, 0.05, 0.08], "gamma": ["scale", 0.05]},
}
MODEL_GROUPS = {"all": (LINEAR, KERNEL, ONE_CLASS), "both": (LINEAR, KERNEL)}
MODEL_TYPES = {LINEAR: art.LINEAR, KERNEL: art.KERNEL, ONE_CLASS: art.ONE_CLASS}


def param_grid(kind: str, preset: str = "default") -> list[dict]:
    axes = GRIDS[preset, kind]
    return [dict(zip(axes, point)) for point in itertools.product(*axes.values())]


def chosen_models(names: Sequence[str]) -> list[str]:
    """A group name stands for its members and overrides single names."""
    for name in names:
        if name in MODEL_GROUPS:
            return list(MODEL_GROUPS[name])
    return [k for k in (LINEAR, KERNEL, ONE_CLASS) if k in names]


@dataclass(frozen=True)
class FeatureTable:
    """Numeric model input: unique key, boolean label, one double per feature."""

    df: DataFrame
    key: str
    label: str
    columns: tuple[str, ...]

    def with_rows(self, df: DataFrame) -> FeatureTable:
        return FeatureTable(df, self.key, self.label, self.columns)

    def normal(self) -> FeatureTable:
        return self.with_rows(self.df.where(~F.col(self.label)))

    def undersampled(self, ratio: int, seed: int) -> FeatureTable:
        return self.with_rows(sampling.undersample(self.df, self.label, self.key, ratio, seed))


def fit(kind: str, table: FeatureTable, params: dict, seed: int = SEED) -> LinearModel | KernelModel:
    """One model on exactly the rows given."""
    return fit_all(kind, table, [params], seed)[0]


def fit_all(
    kind: str, table: FeatureTable, points: Sequence[dict], seed: int = SEED, members: Sequence[str | None] | None = None,
) -> list[LinearModel | KernelModel]:
    """One model per point on exactly the rows given, in passes that all points share.

    ``members`` names, for each point, a flag column of the table: its rows are those where it holds. The rows
    are read many times, so they are kept while fitting.
    """
    members = list(members or [None] * len(points))
    rows = table.df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if kind == LINEAR:
            settings = [Setting(p["loss"], p["alpha"], p["fraud_weight"], m) for p, m in zip(points, members)]
            return fit_linear(rows, table.columns, table.label, settings)
        scales = {
            m: gamma_scale(rows if m is None else rows.where(m), table.columns)
            for m in dict.fromkeys(m for p, m in zip(points, members) if p["gamma"] == "scale")
        }
        gammas = [scales[m] if p["gamma"] == "scale" else p["gamma"] for p, m in zip(points, members)]
        if kind == KERNEL:
            settings = [(p["C"], p["fraud_weight"]) for p in points]
            return fit_kernel_many(rows, table.columns, table.label, settings, gammas, seed=seed, members=members)
        # equal points are fitted once
        wanted = [(p["nu"], g) for p, g in zip(points, gammas)]
        distinct = list(dict.fromkeys(wanted))
        found = fit_one_class_many(rows, table.columns, [nu for nu, _ in distinct], [g for _, g in distinct], seed=seed)
        return [dict(zip(distinct, found))[w] for w in wanted]
    finally:
        rows.unpersist()


def fit_rows(kind: str, table: FeatureTable, params: dict, seed: int) -> FeatureTable:
    """The rows a model of this kind learns from."""
    if kind == ONE_CLASS:
        return table.normal()
    return table.undersampled(params["non_fraud_ratio"], seed)


def selection_score(recall: Column, fpr: Column, precision: Column, goal: float = RECALL_GOAL) -> Column:
    """Recall until the goal is met; from there on low false positive rate and high precision count."""
    return F.when(recall >= F.lit(goal), F.lit(10.0) - fpr + precision).otherwise(recall)


def tune(
    kind: str, table: FeatureTable, grid: Sequence[dict], validation_share: float = TEST_SHARE, seed: int = SEED
) -> tuple[dict, float, list[dict]]:
    """Fit every grid point on the training part, sweep thresholds on the rest, keep the best point.

    Of equal points the first wins.
    """
    train, valid = sampling.split(table.df, table.label, table.key, validation_share, seed)
    models, fitted_on = _fit_grid(kind, table.with_rows(train), grid, seed)
    # all points score the validation rows in one pass, and share the passes that find the thresholds
    names = [f"score{i}" for i in range(len(grid))]
    if kind == LINEAR:
        scores = valid.select(table.key, table.label, *[m.score().alias(n) for n, m in zip(names, models)])
    else:
        scores = with_scores(valid, models, names).select(table.key, table.label, *names)
    scores = scores.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        quantiles = exact_quantiles(scores, names, grid_points(TRAIN_GRID_POINTS, *GRID_SPAN))
        reports = ev.training_reports(
            ev.Scored(scores, table.label, key=table.key), names, [ev.with_zero(quantiles[n]) for n in names],
        )
        chosen = ev.select_thresholds(reports, "point").withColumn(
            "selection", selection_score(F.col("recall"), F.col("false_positive_rate"), F.col("precision"))
        )
        best = {row["point"]: row.asDict() for row in chosen.collect()}
    finally:
        scores.unpersist()
    results = []
    for i, (params, model, counts) in enumerate(zip(grid, models, fitted_on)):
        measures = {n: v for n, v in best[i].items() if n != "point"}
        result = {**params, "fit_rows": sum(counts.values()), **measures, "converged": model.converged}
        if kind != ONE_CLASS:
            result["fit_fraud_rows"] = counts[True]
        results.append(result)
    winner = max(range(len(results)), key=lambda i: (results[i]["selection"], -i))
    return grid[winner], results[winner]["threshold"], results


def _fit_grid(
    kind: str, table: FeatureTable, grid: Sequence[dict], seed: int
) -> tuple[list[LinearModel | KernelModel], list[dict[bool, int]]]:
    """A model for every point, and the class counts of the rows it learned from. Rows are counted and cut for all
    points at once; a flag per ratio says which of them a point learns from.
    """
    counts = sampling.class_counts(table.df, table.label)
    if kind == ONE_CLASS:
        return fit_all(kind, table.normal(), grid, seed), [{True: 0, False: counts[False]}] * len(grid)
    ratios = {f"_ratio{r}": r for r in dict.fromkeys(p["non_fraud_ratio"] for p in grid)}
    rows = sampling.with_undersamples(table.df, table.label, table.key, ratios, counts, seed)
    members = [f"_ratio{p['non_fraud_ratio']}" for p in grid]
    models = fit_all(kind, table.with_rows(rows), grid, seed, members)
    used = [{True: counts[True], False: min(counts[False], p["non_fraud_ratio"] * counts[True])} for p in grid]
    return models, used


def fit_final(kind: str, table: FeatureTable, params: dict, threshold: float, seed: int = SEED) -> art.Artifact:
    model = fit(kind, fit_rows(kind, table, params, seed), params, seed)
    return art.Artifact(
        model, MODEL_TYPES[kind], threshold, table.columns, params, table.label,
        "non_fraud_only" if kind == ONE_CLASS else None,
    )


# The columns of the report, in order.
REPORT_COLUMNS = (
    "loss", "kernel", "C", "nu", "gamma", "alpha", "fraud_weight", "non_fraud_ratio", "fit_rows", "threshold",
    "recall", "false_positive_rate", "precision", "f1", "average_precision", "roc_auc", "predicted_fraud_rate",
    "converged",
)


def tuning_report(spark: SparkSession, results: Sequence[dict]) -> DataFrame:
    """One row per grid point, best F1 first. Parameters are text, measures are numbers."""
    present = [c for c in REPORT_COLUMNS if c in results[0]]
    kinds = {"loss": "string", "kernel": "string", "gamma": "string", "converged": "boolean"}
    values = {"string": str, "boolean": bool, "double": float}
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in present)
    rows = [tuple(values[kinds.get(c, "double")](r[c]) for c in present) for r in results]
    return spark.createDataFrame(rows, schema).orderBy(F.desc("f1"))
