"""Clean, transform, reduce, sample, split and scale a raw transaction table."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlight.functions.features import one_hot, with_cycles, with_time_features
from ledgerlight.functions.values import cast_columns, drop_present, with_flag
from ledgerlight.operators import encode, sampling, scale
from ledgerlight.operators.explore import class_distribution
from ledgerlight.operators.impute import fit_table
from ledgerlight.operators.lookups import require_key
from ledgerlight.operators.profile import columns_with_prefix, stage_metrics
from ledgerlight.schema import (
    BIRTH_COLUMN, CYCLES, KEY, ONE_HOT, REDUCED_AWAY, SAMPLE_RATE, SEED, TARGET, TEST_SHARE, TEXT_IDENTIFIERS,
    TIME_COLUMN,
)
from ledgerlight.session import dealt, keyed_table
from ledgerlight.sources.counted import ClassCounts, counted
from ledgerlight.sources.tables import write_table


def transform(
    df: DataFrame, vocabulary: Mapping[str, Sequence[str]] | None = None, label: str = TARGET,
    vocabulary_limit: int = encode.VOCABULARY_LIMIT, ages_known: bool = False,
) -> DataFrame:
    """Types, time, age, distance and one-hot columns. The vocabulary is the caller's, or found in the table;
    one of more than ``vocabulary_limit`` values in a column is then an error, as each becomes a column.
    ``ages_known`` says that every row has a time and a date of birth, so that no median age is looked for.
    """
    vocabulary = vocabulary or encode.fit_vocabulary(df, [c for c in ONE_HOT if c in df.columns], vocabulary_limit)
    return (
        with_flag(cast_columns(df, TEXT_IDENTIFIERS, "string"), label)
        .transform(with_time_features)
        .transform(encode.with_age, median=0.0 if ages_known else None)
        .transform(encode.with_distance)
        .transform(one_hot, vocabulary)
    )


def reduce_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop identifiers and raw columns. ``keep`` saves the row key for later joins."""
    return drop_present(df, [n for n in REDUCED_AWAY if n not in keep])


@dataclass(frozen=True)
class Prepared:
    """The tables of the preparation, and the rows of each class in all of them, by name."""

    reduced: DataFrame
    sampled: DataFrame
    train: DataFrame
    test: DataFrame
    scaling: scale.Scaling
    counts: Mapping[str, ClassCounts]


def prepare(
    raw: DataFrame,
    key: str = KEY,
    label: str = TARGET,
    sample_rows: int | None = None,
    sample_rate: float = SAMPLE_RATE,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    drop: Sequence[str] = (),
    vocabulary_limit: int = encode.VOCABULARY_LIMIT,
) -> Prepared:
    """The whole preparation of every row, or of a sample of ``sample_rows``.

    The raw table is scanned three times: twice to fit, and once to write the reduced table. That is in buckets by its
    key, because fitting, sampling, both splits and later joins by key read it.
    The row key is carried along, so that scores can be joined to the original amounts later. Quotas,
    splits and that join rest on it, so null or repeated keys are an error.
    """
    fitted = fit_table(raw, one_hot=ONE_HOT, limit=vocabulary_limit)
    kinds = dict(raw.dtypes)
    # a date of birth that is a date is filled like any other column; text may hold what is none
    ages_known = kinds.get(BIRTH_COLUMN) == "date" and TIME_COLUMN in kinds and BIRTH_COLUMN not in fitted.open
    vocabulary = fitted.vocabulary if all(n in fitted.vocabulary for n in ONE_HOT if n in kinds) else None
    transformed = transform(fitted.imputation.apply(raw), vocabulary, label, vocabulary_limit, ages_known)
    rows = dealt(reduce_columns(transformed, keep=[key]).drop(*drop), key)
    reduced, known = counted(rows, lambda df: keyed_table(df, key), label)
    require_key(reduced, key)
    sampled, counts = reduced, known.by_class()
    if sample_rows is not None:
        sampled = sampling.sample_by_rate(reduced, label, key, sample_rows, sample_rate, seed, counts)
        counts = sampling.rate_quotas(sample_rows, sample_rate)
    # Another order than the sample's, which has already cut each class by it.
    train, test = sampling.split(with_cycles(sampled), label, key, test_share, f"{seed}:split", counts)
    scaling = scale.fit_scaling(train)
    return Prepared(
        reduced, sampled, scaling.apply(train), scaling.apply(test), scaling, {"reduced": known, **split_counts(counts, test_share)}
    )


def split_counts(sampled: Mapping[bool, int], test_share: float = TEST_SHARE) -> dict[str, ClassCounts]:
    """The rows of each class in a sample and in its two parts, which follow from the quotas."""
    test = sampling.share_quotas(sampled, math.ceil(sum(sampled.values()) * test_share))
    train = {v: n - test[v] for v, n in sampled.items()}
    parts = {"sampled": sampled, "train": train, "test": test}
    return {name: ClassCounts(sum(part.values()), part[True], part[False]) for name, part in parts.items()}


def write_prepared(prepared: Prepared, folder: str) -> None:
    for name in ("reduced", "sampled", "train", "test"):
        write_table(getattr(prepared, name), f"{folder.rstrip('/')}/{name}")


def transform_summary(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``rows`` is what the write of the table has counted; without it the table is scanned."""
    encoded = columns_with_prefix(df, "category_", "gender_")
    return stage_metrics(
        df.sparkSession,
        {
            "rows": df.count() if rows is None else rows,
            "columns": len(df.columns),
            "created_time_features": 6,
            "created_age_features": 1,
            "created_distance_features": 1,
            "created_encoded_features": len(encoded),
        },
    )


def reduction_summary(before: DataFrame, after: DataFrame, rows: int | None = None) -> DataFrame:
    """``rows`` is what the write of either table has counted; dropping columns keeps every row."""
    dropped = [n for n in REDUCED_AWAY if n in before.columns]
    rows = before.count() if rows is None else rows
    return stage_metrics(
        before.sparkSession,
        {
            "input_rows": rows,
            "input_columns": len(before.columns),
            "output_rows": rows,
            "output_columns": len(after.columns),
            "dropped_columns": len(dropped),
            "missing_requested_columns": len(REDUCED_AWAY) - len(dropped),
        },
    )


def scaling_summary(prepared: Prepared) -> DataFrame:
    """All rows were counted while the tables were written; nothing is scanned."""
    sampled, total = prepared.counts["sampled"], prepared.counts["sampled"].rows
    return stage_metrics(
        prepared.reduced.sparkSession,
        {
            "input_rows": prepared.counts["reduced"].rows,
            "sampled_rows": total,
            "sampled_fraud_rows": sampled.positives,
            "sampled_non_fraud_rows": sampled.negatives,
            "sampled_fraud_percent": round(100.0 * sampled.positives / total, 2) if total else 0.0,
            "source_columns": len(prepared.reduced.columns),
            "post_cyclic_columns": len(prepared.train.columns),
            "encoded_columns": 2 * len(CYCLES),
            "train_rows": prepared.counts["train"].rows,
            "test_rows": prepared.counts["test"].rows,
        },
    )


def split_distribution(prepared: Prepared, label: str = TARGET) -> DataFrame:
    return class_distribution({"train": prepared.train, "test": prepared.test}, label)
