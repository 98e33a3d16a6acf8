"""Pearson correlations of many columns in one pass."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.profile import Measures, melt, numeric_columns
from ledgerlight.session import materialise


def with_target(
    df: DataFrame, label: str, columns: Sequence[str] | None = None, measures: Measures | None = None,
) -> DataFrame:
    """Correlation of each numeric column with the target, strongest first. ``measures`` saves the scan if known."""
    columns = [n for n in columns or numeric_columns(df) if n != label]
    if measures is not None:
        found = [(n, measures.correlations[n]) for n in columns]
        known = df.sparkSession.createDataFrame(found, "column string, correlation double")
    else:
        target = F.col(label).cast("double")
        wide = df.agg(*[F.corr(F.col(f"`{n}`").cast("double"), target).alias(f"{n}__correlation") for n in columns])
        known = melt(wide, columns, ["correlation"])
    return known.orderBy(F.desc(F.abs("correlation")), "column")


def matrix(df: DataFrame, columns: Sequence[str], means: Mapping[str, float | None] | None = None) -> DataFrame:
    """(a, b, correlation) for every ordered pair; each pair uses the rows where both are present. ``means`` saves a
    scan if they are known.

    Each task turns its rows into five small matrices of sums; only those are shuffled.
    Values are centred by the column means first, so large offsets cost no digits.
    """
    columns = list(columns)
    width = len(columns)
    numbers = df.select(*[F.col(f"`{n}`").cast("double").alias(n) for n in columns])
    if means is None:
        means = dict(zip(columns, numbers.agg(*[F.avg(f"`{n}`") for n in columns]).first()))
    centre = np.array([0.0 if means[n] is None else means[n] for n in columns])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, width, width))
        for batch in batches:
            x = batch.to_numpy(dtype=float, copy=True)
            seen = ~np.isnan(x)
            x = np.where(seen, x - centre, 0.0)
            here = seen.astype(float)
            total += np.stack([here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x])
        index = np.indices((width, width)).reshape(2, -1)
        named = dict(zip(("n", "sx", "sxx", "sxy"), total.reshape(4, -1)))
        yield pd.DataFrame({"i": index[0], "j": index[1], **named})

    parts = numbers.mapInPandas(sums, "i int, j int, n double, sx double, sxx double, sxy double")
    # width * width rows from here on, written down as they are read from both sides
    both = materialise(parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sxx", "sxy")]))
    mirrored = both.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("sx").alias("sy"), F.col("sxx").alias("syy"))
    paired = both.join(mirrored, ["i", "j"])
    covariance = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    spread_x = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    spread_y = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    # a column without spread has no correlation; rounding may leave a trace of one
    flat = (spread_x <= F.col("sxx") * 1e-12) | (spread_y <= F.col("syy") * 1e-12)
    r = F.when((F.col("n") > 0) & ~flat, covariance / F.sqrt(spread_x * spread_y))
    names = F.array(*map(F.lit, columns))
    return paired.select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), r.alias("correlation"))
