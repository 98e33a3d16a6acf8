"""Train and evaluate the detectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlight.functions.values import with_flag
from ledgerlight.models import artifact as art
from ledgerlight.models.features import fit_frequency_maps, prepare_features
from ledgerlight.models.tuning import (
    KERNEL, ONE_CLASS, FeatureTable, chosen_models, fit_final, param_grid, tune, tuning_report,
)
from ledgerlight.operators import evaluate as ev
from ledgerlight.operators import sampling
from ledgerlight.operators.lookups import attach_amount, require_alignment
from ledgerlight.schema import KEY, SEED, TARGET, TEST_SHARE
from ledgerlight.session import materialise
from ledgerlight.sources.tables import write_report, write_table


@dataclass(frozen=True)
class Trained:
    artifact: art.Artifact
    tuning: DataFrame


def feature_table(train: DataFrame, key: str = KEY, label: str = TARGET, rows: int | None = None, seed: int = SEED) -> FeatureTable:
    """Numeric training input, written down once because every fit reads it many times."""
    if label not in train.columns:
        raise ValueError(f"{label} is needed for training")
    maps = fit_frequency_maps(train)
    if rows is not None:
        train = sampling.fraction_then_trim(train, key, rows, train.count(), seed)
    features, names = prepare_features(train, maps, key, label)
    return FeatureTable(materialise(features, spread_by=key), key, label, tuple(names))


def train(
    table: FeatureTable,
    models: Sequence[str] = (ONE_CLASS,),
    preset: str = "default",
    validation_share: float = TEST_SHARE,
    model_rows: Mapping[str, int] | None = None,
    folder: str | None = None,
    seed: int = SEED,
) -> dict[str, Trained]:
    """Tune and fit the chosen models. ``folder=None`` is a dry run: nothing is saved.

    ``model_rows`` limits the kernel and one-class fits to a stratified number of rows.
    """
    spark = table.df.sparkSession
    trained = {}
    for kind in chosen_models(models):
        limit = (model_rows or {}).get(kind) if kind in (KERNEL, ONE_CLASS) else None
        rows = table.with_rows(sampling.subsample(table.df, table.label, table.key, limit, seed)) if limit else table
        params, threshold, results = tune(kind, rows, param_grid(kind, preset), validation_share, seed)
        fitted = fit_final(kind, rows, params, threshold, seed)
        if folder is not None:
            art.save(spark, fitted, f"{folder.rstrip('/')}/{kind}")
        trained[kind] = Trained(fitted, tuning_report(spark, results))
    return trained


def score_table(
    test: DataFrame, train_table: DataFrame, source: DataFrame, artifact: art.Artifact,
    key: str = KEY, label: str = TARGET,
) -> DataFrame:
    """(key, label, score, amount): frequencies come from the training rows, amounts by key from the source."""
    maps = fit_frequency_maps(train_table)
    features, _ = prepare_features(test, maps, key, label, artifact.columns())
    scored = features.select(key, label, artifact.score().alias("score"))
    return attach_amount(scored, source, key, "amt", "amt")


@dataclass(frozen=True)
class Evaluated:
    summary: DataFrame
    thresholds: DataFrame
    operating_point: DataFrame
    pr_curve: DataFrame
    roc_curve: DataFrame
    loss_capture: DataFrame


def evaluate(
    test: DataFrame, train_table: DataFrame, source: DataFrame, artifact: art.Artifact,
    key: str = KEY, label: str = TARGET, rows: int | None = None, folder: str | None = None, seed: int = SEED,
) -> Evaluated:
    """Score the test rows, or ``rows`` of them, and report on them.

    Raises unless each has exactly one row of the source, which holds the same label. A source written by
    ``keyed_table`` is neither shuffled nor sorted for that, nor to bring the amounts. Rows are ranked once; all curves
    are read from that.
    """
    if rows is not None:
        test = materialise(sampling.subsample(test, label, key, rows, seed))
    matched = source.join(test.select(key), key, "left_semi")
    require_alignment(with_flag(test, label).select(key, label), with_flag(matched, label).select(key, label), key, label)
    # written down once, as is the ranking: every report below reads them
    scores = materialise(score_table(test, train_table, source, artifact, key, label))
    scored = ev.Scored(scores, label, key=key)
    ranking = materialise(ev.ranked_rows(scored))
    ranked = materialise(ev.ranked_scores(scored, ranking))
    thresholds = materialise(ev.evaluation_report(scored))
    result = Evaluated(
        ev.summary(scored, artifact.cut, ranked),
        thresholds.orderBy("threshold"),
        ev.select_operating_threshold(thresholds),
        ev.pr_curve(scored, ranked),
        ev.roc_curve(scored, ranked),
        ev.loss_capture_curve(scored, ranking),
    )
    if folder is not None:
        base = f"{folder.rstrip('/')}/{artifact.model_type}"
        for name in ("summary", "thresholds", "operating_point"):
            write_report(getattr(result, name), f"{base}/{name}")
        for name in ("pr_curve", "roc_curve", "loss_capture"):
            write_table(getattr(result, name), f"{base}/{name}")
    return result
