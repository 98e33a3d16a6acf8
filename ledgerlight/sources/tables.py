"""Typed readers, and writers that replace a table as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.functions.features import date_or_null
from ledgerlight.functions.values import number_or_null, parse_flag
from ledgerlight.operators import cut
from ledgerlight.operators.cut import ONE_TASK_ROWS
from ledgerlight.schema import KEY, RAW_SCHEMA
from ledgerlight.sources.commit import replace, settled


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
    rows: int | None = None,
    key: str = KEY,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Read Parquet, or CSV with a pinned schema (raw transactions by default). Missing paths are an error.

    ``columns`` prunes the scan; ``rows`` keeps the first rows in key order (ties: all columns decide). More than
    ``one_task_rows`` are cut off by counting.
    """
    settled(spark, path)
    if path.rstrip("/").lower().endswith((".csv", ".csv.gz", "_csv")):
        df = read_csv(spark, path, schema or RAW_SCHEMA)
    else:
        df = spark.read.parquet(path)
    if rows is not None:
        df = first_rows(df, key, rows, one_task_rows) if key in df.columns else df.limit(rows)
    return df.select(*columns) if columns else df


def first_rows(df: DataFrame, key: str, rows: int, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """The first rows in key order; of rows that share a key all other columns decide, but for maps."""
    order = [key, *[n for n, kind in df.dtypes if n != key and not kind.startswith("map")]]
    return cut.first_rows(df, order, rows, one_task_rows)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header whose column order need not match the schema; empty text is null.

    Everything is read as text and then typed: text that is no number or date becomes null, and flag words are
    parsed. Only the header line is read to find the order. Identifiers stay text, leading zeros included.
    """
    header = spark.read.option("header", True).csv(path).columns
    pinned = {f.name: f.dataType for f in schema.fields}
    texts = T.StructType([T.StructField(n, T.StringType()) for n in header])
    df = spark.read.schema(texts).options(header=True, nullValue="", mode="PERMISSIVE").csv(path)
    return df.select(*[typed(n, pinned.get(n, T.StringType())).alias(n) for n in header])


def typed(name: str, kind: T.DataType) -> Column:
    """A text column as the given type, null where the text has no such meaning."""
    source = F.col(f"`{name}`")
    if isinstance(kind, T.BooleanType):
        return F.when(source.isNotNull(), parse_flag(F.trim(source)))
    if isinstance(kind, T.DateType):
        return date_or_null(F.trim(source))
    if isinstance(kind, T.IntegralType):
        # whole numbers are often written with a decimal point; large ones must not pass through a double
        plain = F.trim(source)
        return F.coalesce(plain.try_cast(kind), number_or_null(plain).try_cast(kind))
    if isinstance(kind, T.StringType):
        return source
    return number_or_null(F.trim(source)).try_cast(kind)


def write_table(df: DataFrame, path: str) -> None:
    """Replace the table as a whole; a write that fails leaves the old one as it was."""
    csv = path.rstrip("/").lower().endswith(("_csv", ".csv"))

    def write(place: str) -> None:
        if csv:
            df.write.options(header=True, nullValue="").csv(place)
        else:
            df.write.parquet(place)

    replace(df.sparkSession, path, write)


def write_report(df: DataFrame, path: str) -> None:
    """Small tables (metrics, thresholds) as one CSV file, replaced as a whole; only finished rows go to one task."""
    replace(df.sparkSession, path, lambda place: df.repartition(1).write.option("header", True).csv(place))


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the way an untyped CSV holds it."""
    return df.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in df.columns])
