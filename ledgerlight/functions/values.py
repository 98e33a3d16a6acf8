"""Casts, text clean-up and simple predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.schema import MISSING, TRUE_WORDS


def number_or_null(column: Column | str) -> Column:
    """Text to double; text that is no number becomes null."""
    return _col(column).try_cast("double")


def number_strict(column: Column | str) -> Column:
    """Text to double; text that is no number fails the job, whatever the ANSI setting."""
    source = _col(column)
    parsed = source.try_cast("double")
    message = F.concat(F.lit("not a number: "), source.cast("string"))
    bad = source.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(message).cast("double")).otherwise(parsed)


def empty_to_null(column: Column | str) -> Column:
    return F.nullif(_col(column), F.lit(""))


def fill_constant(column: Column | str, value) -> Column:
    return F.coalesce(_col(column), F.lit(value))


def parse_flag(column: Column | str) -> Column:
    """true / 1 / yes in any case is true, everything else (null too) is false."""
    return F.coalesce(F.lower(_col(column).cast("string")).isin(*TRUE_WORDS), F.lit(False))


def flag_column(df: DataFrame, name: str) -> Column:
    """The column itself if it is boolean already, otherwise its parsed text."""
    if dict(df.dtypes)[name] == "boolean":
        return F.coalesce(F.col(name), F.lit(False))
    return parse_flag(name)


def flag_to_int(column: Column | str) -> Column:
    return _col(column).cast("int")


def missing_as_word(column: Column | str) -> Column:
    return F.coalesce(_col(column).cast("string"), F.lit(MISSING))


def cap(column: Column | str, upper: float | None) -> Column:
    """Values above the cap become the cap; nulls stay null."""
    source = _col(column)
    return source if upper is None else F.when(source > F.lit(upper), F.lit(upper)).otherwise(source)


def log1p(column: Column | str) -> Column:
    return F.log1p(_col(column))


def cast_columns(df: DataFrame, names: Sequence[str], kind: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast(kind) for n in names if n in df.columns})


def with_flag(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, flag_column(df, name)) if name in df.columns else df


def drop_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist; absent ones are no error."""
    return df.drop(*names)


def align(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the wanted columns in their order: absent ones are 0, others are dropped."""
    present = set(df.columns)
    chosen = [F.col(f"`{n}`") if n in present else F.lit(0.0).alias(n) for n in wanted]
    return df.select(*keep, *chosen)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
