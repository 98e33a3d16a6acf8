"""Fitted encodings and the transform steps that need a fitted value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.features import age_years, haversine_km
from ledgerlight.operators.impute import require_small
from ledgerlight.operators.profile import value_counts
from ledgerlight.operators.quantiles import exact_quantiles
from ledgerlight.schema import AGE, BIRTH_COLUMN, DISTANCE, ONE_HOT, REDUCED_AWAY, TIME_COLUMN

VOCABULARY_LIMIT = 10_000


def fit_vocabulary(df: DataFrame, columns: Sequence[str] = ONE_HOT, limit: int = VOCABULARY_LIMIT) -> dict[str, list[str]]:
    """Sorted distinct values per column. More than ``limit`` of them would make an unusable schema: error."""
    columns = list(columns)
    distinct = value_counts(df, columns).where(F.col("value").isNotNull()).select("column", "value")
    found = distinct.limit(len(columns) * (limit + 1)).collect()
    vocabulary = {name: sorted(row["value"] for row in found if row["column"] == name) for name in columns}
    for name, values in vocabulary.items():
        require_small(name, len(values), limit)
    return vocabulary


def vocabulary_columns(vocabulary: Mapping[str, Sequence[str]]) -> list[str]:
    return [f"{name}_{value}" for name, values in vocabulary.items() for value in values]


def with_age(df: DataFrame, seconds: str = TIME_COLUMN, born: str = BIRTH_COLUMN, median: float | None = None) -> DataFrame:
    """Customer age in whole years; unknown ages take the median of the known ones."""
    age = age_years(seconds, born)
    if median is None and not df.where(age.isNull()).limit(1).isEmpty():
        median = exact_quantiles(df, {"age": age}, [0.5])["age"][0]
    return df.withColumn(AGE, F.coalesce(age, F.lit(median).cast("double")).cast("bigint"))


def with_distance(df: DataFrame) -> DataFrame:
    return df.withColumn(DISTANCE, haversine_km("lat", "long", "merch_lat", "merch_long"))


def column_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """For each column: dropped, asked for but not found, or kept."""
    present = set(before.columns)
    rows = [(n, "dropped" if n in present else "not_found") for n in REDUCED_AWAY]
    rows += [(n, "kept") for n in after.columns]
    return before.sparkSession.createDataFrame(rows, "column string, status string")
