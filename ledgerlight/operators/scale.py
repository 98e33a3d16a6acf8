"""Scalers fitted on training rows and applied as plain expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.quantiles import exact_quantiles
from ledgerlight.schema import CYCLES, LOG_ROBUST, MINMAX_SCALED, STANDARDISED


@dataclass(frozen=True)
class Scaling:
    """(shift, scale) per column; columns of ``logged`` go through log1p first."""

    logged: tuple[str, ...]
    factors: dict[str, tuple[float, float]]

    def apply(self, df: DataFrame) -> DataFrame:
        scaled = {}
        for name, (shift, scale) in self.factors.items():
            source = F.col(name).cast("double")
            source = F.log1p(source) if name in self.logged else source
            scaled[name] = (source - F.lit(shift)) / F.lit(scale)
        return df.withColumns(scaled)


def _safe(shift, scale) -> tuple[float, float]:
    return float(shift or 0.0), float(scale) if scale else 1.0


def fit_log_robust(train: DataFrame, columns: Sequence[str] = LOG_ROBUST) -> Scaling:
    """log1p, then minus the median and over the interquartile range."""
    columns = list(columns)
    found = exact_quantiles(train, {n: F.log1p(F.col(n).cast("double")) for n in columns}, [0.25, 0.5, 0.75])
    factors = {n: _safe(q[1], None if q[0] is None else q[2] - q[0]) for n, q in found.items()}
    return Scaling(tuple(columns), factors)


def _fit_moments(train: DataFrame, standard: Sequence[str], minmax: Sequence[str]) -> Scaling:
    """Both kinds in one pass."""
    parts = [F.struct(F.avg(n).alias("shift"), F.stddev_pop(n).alias("scale")).alias(n) for n in standard]
    parts += [F.struct(F.min(n).alias("shift"), (F.max(n) - F.min(n)).alias("scale")).alias(n) for n in minmax]
    row = train.agg(*parts).first()
    return Scaling((), {n: _safe(row[n]["shift"], row[n]["scale"]) for n in (*standard, *minmax)})


def fit_standard(train: DataFrame, columns: Sequence[str] = STANDARDISED) -> Scaling:
    """Minus the mean and over the population deviation."""
    return _fit_moments(train, columns, ())


def fit_minmax(train: DataFrame, columns: Sequence[str] = MINMAX_SCALED) -> Scaling:
    """Training minimum to 0 and maximum to 1; a constant column becomes 0."""
    return _fit_moments(train, (), columns)


def fit_scaling(
    train: DataFrame,
    log_robust: Sequence[str] = LOG_ROBUST,
    standard: Sequence[str] = STANDARDISED,
    minmax: Sequence[str] = MINMAX_SCALED,
) -> Scaling:
    robust, others = fit_log_robust(train, log_robust), _fit_moments(train, standard, minmax)
    return Scaling(robust.logged, {**robust.factors, **others.factors})


def operation_report(spark) -> DataFrame:
    """Which operation each column goes through and what it is fitted on."""
    operations = [
        (CYCLES, "cyclic encoding", "sampled dataset"),
        (LOG_ROBUST, "log1p + RobustScaler", "train only"),
        (STANDARDISED, "StandardScaler", "train only"),
        (MINMAX_SCALED, "MinMaxScaler", "train only"),
    ]
    rows = [(column, name, scope) for columns, name, scope in operations for column in columns]
    return spark.createDataFrame(rows, "column string, operation string, fit_scope string")
