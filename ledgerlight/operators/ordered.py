"""Running totals in one global order, without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.session import materialise


RANGE_ROWS = 1_000_000
ONE_RANGE_ROWS = 200_000


def running_totals(
    df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column | str], rows: int | None = None,
    one_range_rows: int = ONE_RANGE_ROWS,
) -> DataFrame:
    """Add one inclusive running total per entry of ``sums``, in the given total order.

    ``rows`` is the number of rows or more, if known. Up to ``one_range_rows`` are sorted as they are; beyond that the
    number of ranges grows with the rows, at most about RANGE_ROWS in each.
    Rows are range-partitioned by the order and written down once with their range number, so the
    numbers cannot shift between the two reads. Ranges come from a sample of the full order key, so a
    score shared by many rows is split by the key behind it.
    """
    columns = {name: F.col(c) if isinstance(c, str) else c for name, c in sums.items()}
    rows = df.count() if rows is None else rows
    if rows <= one_range_rows:
        upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({n: F.coalesce(F.sum(c).over(upto), F.lit(0)) for n, c in columns.items()})
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE_ROWS))
    ranged = materialise(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))

    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_base_{n}") for n, c in columns.items()])
    # one row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "_range", *[F.coalesce(F.sum(f"_base_{n}").over(before), F.lit(0)).alias(f"_base_{n}") for n in columns]
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(bases), "_range")
        .withColumns({n: F.col(f"_base_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in columns.items()})
        .drop("_range", *[f"_base_{n}" for n in columns])
    )
