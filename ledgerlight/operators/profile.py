"""Table and column profiles.

Anything counted per value first becomes (column, value, count) by one grouping with map-side
combining; distinct counts, modes and top lists are then cheap aggregates over that, and no
aggregation buffer ever grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.operators.quantiles import exact_quantiles
from ledgerlight.schema import KEY, TOP_VALUES
from ledgerlight.session import materialise

NUMERIC_KINDS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
DUPLICATE_HASHES = 2_000_000


def numeric_columns(df: DataFrame) -> list[str]:
    return [n for n, kind in df.dtypes if kind.split("(")[0] in NUMERIC_KINDS]


def text_columns(df: DataFrame) -> list[str]:
    return [n for n, kind in df.dtypes if kind == "string"]


def columns_with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    return [n for n in df.columns if n.startswith(prefixes)]


def column_list(df: DataFrame) -> DataFrame:
    rows = [(i, n) for i, n in enumerate(df.columns)]
    return df.sparkSession.createDataFrame(rows, "position int, column string")


def kind_counts(df: DataFrame) -> DataFrame:
    kinds = df.sparkSession.createDataFrame([(k,) for _, k in df.dtypes], "kind string")
    return kinds.groupBy("kind").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "kind")


@dataclass(frozen=True)
class Measures:
    """What one aggregate tells about a table: rows, gaps, moments and classes. As large as the list of columns."""

    rows: int
    missing: dict[str, int]
    numbers: dict[str, dict[str, float | None]]
    classes: dict[bool | None, int]
    correlations: dict[str, float | None]


def moments(name: str) -> dict[str, Column]:
    c = F.col(f"`{name}`").cast("double")
    return {"count": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c), "max": F.max(c)}


def measure(df: DataFrame, label: str | None = None) -> Measures:
    """Gaps of every column, moments of numbers, and with a label its classes and correlations, from one scan."""
    numbers = numeric_columns(df)
    parts = [F.count(F.lit(1))] + [F.count_if(F.col(f"`{n}`").isNull()) for n in df.columns]
    parts += [F.struct(*[e.alias(m) for m, e in moments(n).items()]) for n in numbers]
    correlated = [n for n in numbers if n != label] if label is not None else []
    if label is not None:
        flag = F.col(f"`{label}`")
        parts += [F.count_if(c) for c in (flag == F.lit(True), flag == F.lit(False), flag.isNull())]
        parts += [F.corr(F.col(f"`{n}`").cast("double"), flag.cast("double")) for n in correlated]
    found = iter(df.agg(*[c.alias(f"m{i}") for i, c in enumerate(parts)]).first())
    rows = next(found)
    missing = {n: next(found) for n in df.columns}
    described = {n: next(found).asDict() for n in numbers}
    classes = {v: n for v in (True, False, None) if label is not None and (n := next(found))}
    return Measures(rows, missing, described, classes, {n: next(found) for n in correlated})


def shape(df: DataFrame, measures: Measures | None = None) -> DataFrame:
    if measures is not None:
        return df.sparkSession.createDataFrame([(measures.rows, len(df.columns))], "rows long, columns long")
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))


def summary(df: DataFrame, label: str) -> DataFrame:
    """Rows, positives, negatives, positive share and number of columns."""
    flag = F.col(label)
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(flag).cast("bigint").alias("positives"),
        F.count_if(~flag).cast("bigint").alias("negatives"),
        F.avg(flag.cast("double")).alias("positive_rate"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
    )


def preview(df: DataFrame, key: str = KEY, rows: int = 10) -> DataFrame:
    """First rows in key order."""
    return df.orderBy(key).limit(rows)


def melt(wide: DataFrame, names: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row of ``name__measure`` columns to one row per name."""
    items = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"`{n}__{m}`").alias(m) for m in measures]) for n in names
    ]
    return wide.select(F.inline(F.array(*items)))


def missing_values(df: DataFrame, measures: Measures | None = None) -> DataFrame:
    """Null count and percent per column, most first. Here and below, ``measures`` saves the scan if they are known."""
    if measures is not None:
        rows = [(n, c, c * 100.0 / measures.rows if measures.rows else 0.0) for n, c in measures.missing.items()]
        known = df.sparkSession.createDataFrame(rows, "column string, missing_count long, missing_percent double")
        return known.orderBy(F.desc("missing_count"), "column")
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{n}`").isNull()).alias(f"{n}__missing_count") for n in df.columns]
    )
    items = [F.struct(F.lit(n).alias("column"), F.col(f"`{n}__missing_count`").alias("missing_count"), "_rows") for n in df.columns]
    percent = F.when(F.col("_rows") > 0, F.col("missing_count") * 100.0 / F.col("_rows").cast("double")).otherwise(0.0)
    long = counts.select(F.inline(F.array(*items)))
    return long.select("column", "missing_count", percent.cast("double").alias("missing_percent")).orderBy(
        F.desc("missing_count"), "column"
    )


def remaining_nulls(df: DataFrame) -> DataFrame:
    return missing_values(df).agg(F.sum("missing_count").alias("remaining_nulls"))


def duplicate_rows(df: DataFrame, hash_limit: int = DUPLICATE_HASHES) -> DataFrame:
    """Rows beyond the first of each identical group, nulls equal.

    Only the eight-byte row hash is shuffled for the whole table. Rows whose hash occurs once cannot
    have a copy; the others are compared in full. Should very many hashes repeat, all rows are.
    """
    columns = [F.col(f"`{n}`") for n in df.columns]
    hashed = df.select(*columns, F.xxhash64(*columns).alias("_hash"))
    repeated = materialise(hashed.groupBy("_hash").count().where("count > 1").select("_hash"))
    found = repeated.limit(hash_limit + 1).count()
    if not found:
        return df.sparkSession.createDataFrame([(0,)], "duplicate_row_count long")
    suspects = df
    if found <= hash_limit:
        suspects = hashed.join(F.broadcast(repeated), "_hash", "left_semi").drop("_hash")
    copies = suspects.groupBy(*columns).agg(F.count("*").alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_row_count"))


def value_counts(df: DataFrame, columns: Mapping[str, Column] | Sequence[str]) -> DataFrame:
    """(column, value, count) with null as a value of its own."""
    if not isinstance(columns, Mapping):
        columns = {n: F.col(f"`{n}`") for n in columns}
    texts = df.select(*[c.cast("string").alias(n) for n, c in columns.items()])
    long = texts.unpivot([], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(F.count("*").alias("count"))


def counted_values(df: DataFrame, columns: Sequence[str], counts: DataFrame | None) -> DataFrame:
    """The given counts cut down to the columns, or fresh ones."""
    return value_counts(df, columns) if counts is None else counts.where(F.col("column").isin(list(columns)))


def column_modes(df: DataFrame, columns: Mapping[str, Column] | Sequence[str]) -> dict[str, str]:
    """Most frequent non-null value per column; ties go to the smallest."""
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("count")).alias("order"), "value")).alias("best"))
    return {row["column"]: row["best"]["value"] for row in best.collect()}


def cardinality(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False, counts: DataFrame | None = None
) -> DataFrame:
    """Distinct non-null values per text column, most first. ``counts`` saves counting the values again."""
    columns = list(columns or text_columns(df))
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(f"`{n}`").alias(f"{n}__distinct_count") for n in columns])
        counted = melt(wide, columns, ["distinct_count"])
    else:
        counts = counted_values(df, columns, counts)
        counted = counts.groupBy("column").agg(F.count("value").alias("distinct_count"))
    return counted.orderBy(F.desc("distinct_count"), "column")


def top_values(
    df: DataFrame, columns: Sequence[str] | None = None, k: int = TOP_VALUES, counts: DataFrame | None = None
) -> DataFrame:
    """The k most frequent values per text column, null included; Spark limits groups before the shuffle."""
    counts = counted_values(df, list(columns or text_columns(df)), counts)
    order = Window.partitionBy("column").orderBy(F.desc("count"), F.col("value").asc_nulls_last())
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def target_distribution(df: DataFrame, label: str, measures: Measures | None = None) -> DataFrame:
    """Count and percent per class, null being a class."""
    if measures is not None:
        counts = df.sparkSession.createDataFrame(list(measures.classes.items()), f"`{label}` boolean, count long")
    else:
        counts = df.groupBy(label).agg(F.count("*").alias("count"))
    total = Window.partitionBy()  # over at most three rows
    return counts.withColumn("percent", F.col("count") * 100.0 / F.sum("count").over(total).cast("double"))


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, measures: Measures | None = None,
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per numeric column."""
    columns = list(columns or numeric_columns(df))
    measured = ("count", "mean", "std", "min", "max")
    if measures is None:
        wide = df.agg(*[F.struct(*[e.alias(m) for m, e in moments(n).items()]).alias(f"m{i}") for i, n in enumerate(columns)])
        known = dict(zip(columns, (r.asDict() for r in wide.first()))) if columns else {}
    else:
        known = measures.numbers
    # NaN counts as a value of a column, but has no place among its quartiles
    present = {n: known[n]["count"] for n in columns} if all(known[n]["mean"] == known[n]["mean"] for n in columns) else None
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], present=present)
    rows = [(n, *[known[n][m] for m in measured[:4]], *quartiles[n], known[n]["max"]) for n in columns]
    numbers = ", ".join(f"{m} double" for m in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return df.sparkSession.createDataFrame(rows, f"column string, count long, {numbers}")


def countable_columns(df: DataFrame) -> list[str]:
    return [n for n, kind in df.dtypes if kind in ("string", "boolean")]


def describe_text(df: DataFrame, columns: Sequence[str] | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Non-null count, distinct values, most frequent value and its count per text or flag column."""
    columns = list(columns or countable_columns(df))
    counts = counted_values(df, columns, counts).where(F.col("value").isNotNull())
    best = F.min(F.struct((-F.col("count")).alias("order"), "value"))
    return counts.groupBy("column").agg(
        F.sum("count").alias("count"),
        F.count("*").alias("unique"),
        best["value"].alias("top"),
        (-best["order"]).alias("freq"),
    )


def describe_all(df: DataFrame, numeric: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Numeric and text profiles in one table; what does not apply is null."""
    numeric = describe_numeric(df) if numeric is None else numeric
    return numeric.unionByName(describe_text(df, counts=counts), allowMissingColumns=True)


def stage_metrics(spark, values: Mapping[str, float | int]) -> DataFrame:
    """A small (metric, value) report."""
    return spark.createDataFrame([(n, float(v)) for n, v in values.items()], "metric string, value double")
