"""A fitted model with everything needed to score a new table, stored as one Parquet row."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.models.kernel import FourierMap, KernelModel
from ledgerlight.models.linear import LinearModel
from ledgerlight.schema import TARGET
from ledgerlight.sources.commit import replace, settled

# Model type names.
LINEAR, KERNEL, ONE_CLASS = "supervised_sgd_svm", "supervised_rbf_svm", "unsupervised_oneclass_rbf_svm"
UNNAMED = "unsupervised"

ROW = (
    "model_type string, threshold double, feature_columns array<string>, params map<string,string>, "
    "target_column string, fit_scope string, weights array<double>, intercept double, sign double, "
    "gamma double, frequencies array<double>, phases array<double>, converged boolean, steps int"
)


@dataclass(frozen=True)
class Artifact:
    model: LinearModel | KernelModel
    model_type: str = UNNAMED
    threshold: float | None = None
    feature_columns: tuple[str, ...] | None = None
    params: dict = field(default_factory=dict)
    target_column: str = TARGET
    fit_scope: str | None = None

    @property
    def cut(self) -> float:
        """Threshold of the predictions; a model without one decides at 0."""
        return 0.0 if self.threshold is None else self.threshold

    def columns(self) -> list[str]:
        """Names the scoring table must carry: the saved list, or those the model was fitted on."""
        own = self.model.columns if isinstance(self.model, LinearModel) else self.model.features.columns
        return list(self.feature_columns or own)

    def score(self) -> Column:
        return self.model.score()


def bare(model: LinearModel | KernelModel) -> Artifact:
    """A model without metadata is still usable."""
    return Artifact(model)


def save(spark: SparkSession, artifact: Artifact, path: str) -> None:
    """Replace the model at path as a whole; a save that fails leaves the old model as it was."""
    model = artifact.model
    kernel = isinstance(model, KernelModel)
    row = (
        artifact.model_type,
        artifact.threshold,
        artifact.columns(),
        {k: json.dumps(v) for k, v in artifact.params.items()},
        artifact.target_column,
        artifact.fit_scope,
        [float(v) for v in model.weights],
        float(model.intercept),
        model.sign if kernel else 1.0,
        model.features.gamma if kernel else None,
        [float(v) for v in model.features.frequencies.ravel()] if kernel else None,
        [float(v) for v in model.features.phases] if kernel else None,
        bool(model.converged),
        int(model.steps),
    )
    one = spark.createDataFrame([row], ROW).coalesce(1)
    replace(spark, path, lambda place: one.write.parquet(place))


def load(spark: SparkSession, path: str) -> Artifact:
    row = spark.read.schema(ROW).parquet(settled(spark, path)).first()
    if row is None:
        raise FileNotFoundError(f"no model in {path}")
    columns = tuple(row["feature_columns"])
    # models saved without them say nothing about convergence
    ending = {"converged": row["converged"] is not False, "steps": row["steps"] or 0}
    if row["phases"] is None:
        model = LinearModel(columns, tuple(row["weights"]), row["intercept"], **ending)
    else:
        phases = np.array(row["phases"])
        frequencies = np.array(row["frequencies"]).reshape(len(columns), len(phases))
        features = FourierMap(columns, row["gamma"], frequencies, phases)
        model = KernelModel(features, np.array(row["weights"]), row["intercept"], row["sign"], **ending)
    params = {k: json.loads(v) for k, v in (row["params"] or {}).items()}
    return Artifact(
        model, row["model_type"], row["threshold"], columns, params, row["target_column"], row["fit_scope"]
    )


def with_score(df: DataFrame, artifact: Artifact, name: str = "score") -> DataFrame:
    return df.withColumn(name, artifact.score())


def with_prediction(df: DataFrame, artifact: Artifact, score: str = "score") -> DataFrame:
    return df.withColumn("predicted", F.col(score) >= F.lit(float(artifact.cut)))
