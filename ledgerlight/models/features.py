"""From a scaled table to numeric model input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.values import align, flag_column, flag_to_int, missing_as_word, number_strict
from ledgerlight.operators.lookups import frequency_encode, shares
from ledgerlight.operators.profile import value_counts
from ledgerlight.schema import FREQUENCY_ENCODED, TARGET
from ledgerlight.session import materialise


def fit_frequency_maps(train: DataFrame, columns: Sequence[str] = FREQUENCY_ENCODED) -> dict[str, DataFrame]:
    """One map per column, from one pass whose counts are written down: every later use reads only those."""
    counts = materialise(value_counts(train, {n: missing_as_word(n) for n in columns}))
    return {n: shares(counts.where(F.col("column") == n).select("value", "count")) for n in columns}


def prepare_features(
    df: DataFrame,
    maps: Mapping[str, DataFrame],
    key: str,
    label: str = TARGET,
    feature_columns: Sequence[str] | None = None,
    carry: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Key, label, carried columns, then one double per feature; and the feature names.

    Text columns are replaced by their share in the training rows, flags become 0 and 1, anything
    else must be numeric.
    """
    kept = [key, *[c for c in carry if c != key]]
    if label in df.columns:
        df = df.withColumn(label, flag_column(df, label))
        kept.append(label)
    encoded = frequency_encode(df, dict(maps))
    numeric = {}
    for name, kind in encoded.dtypes:
        if name in kept:
            continue
        if kind == "boolean":
            numeric[name] = flag_to_int(F.col(f"`{name}`")).cast("double")
        elif kind == "string":
            numeric[name] = number_strict(F.col(f"`{name}`"))
        else:
            numeric[name] = F.col(f"`{name}`").cast("double")
    names = list(feature_columns or numeric)
    ready = encoded.select(*kept, *[c.alias(n) for n, c in numeric.items()])
    return align(ready, names, keep=kept), names


def gamma_scale(df: DataFrame, columns: Sequence[str]) -> float:
    """1 / (number of features * population variance over all entries of the matrix)."""
    # deviations from each column's mean, put together: no large sums of squares to subtract
    parts = [f(F.col(f"`{n}`")).alias(f"{p}{i}") for i, n in enumerate(columns)
             for p, f in (("m", F.avg), ("v", F.var_pop))]
    row = df.agg(*parts).first()
    means = [row[f"m{i}"] for i in range(len(columns))]
    overall = sum(means) / len(means)
    variance = sum(row[f"v{i}"] + (m - overall) ** 2 for i, m in enumerate(means)) / len(means)
    return 1.0 / (len(columns) * variance) if variance else 1.0
