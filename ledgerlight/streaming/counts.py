"""Frequency maps of a table read a few files at a time.

The state holds one counter per value, spread over the state store; a restarted query goes on from
its checkpoint. A batch writes the new counts of the values it touches, and nothing else, as one delta. Counts only
grow, so the largest count of a value is its latest, whatever deltas it is found in. Every few batches the deltas
are merged into one table, which then takes their place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.functions.values import missing_as_word
from ledgerlight.operators.lookups import shares
from ledgerlight.operators.profile import value_counts
from ledgerlight.schema import FREQUENCY_ENCODED
from ledgerlight.sources.commit import Place, settled
from ledgerlight.sources.tables import write_table

MERGE_EVERY = 20
MERGED = "merged"
COUNTS = "column string, value string, count long"


def read_in_batches(spark: SparkSession, folder: str, schema: T.StructType, files: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream, ``files`` of them per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def count_values(
    stream: DataFrame, path: str, columns: Sequence[str] = FREQUENCY_ENCODED, checkpoint: str | None = None,
    merge_every: int = MERGE_EVERY,
) -> None:
    """Count every value of the columns over all files present; ``latest_counts`` reads the counts from ``path``.

    The checkpoint lies beside the counts unless named, so that a later call takes in only new files. A batch
    that is run again after a failure writes its delta anew, under the same name.
    """
    spark = stream.sparkSession
    words = {c: missing_as_word(c) for c in columns}
    checkpoint = checkpoint or f"{path.rstrip('/')}_checkpoint"

    def keep(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path.rstrip('/')}/delta={number}")
        if len(deltas(spark, path)) >= merge_every:
            merge(spark, path)

    query = (
        value_counts(stream, words).writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def deltas(spark: SparkSession, path: str) -> list[str]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/delta=*")
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place) or []
    return sorted(str(status.getPath().toString()) for status in found)


def merge(spark: SparkSession, path: str) -> None:
    """Put the deltas into the merged table, which is replaced as a whole; only then are they removed.

    If that breaks off, what is left says the same: a count that is found twice counts once.
    """
    taken = deltas(spark, path)
    write_table(latest_counts(spark, path), f"{path.rstrip('/')}/{MERGED}")
    for name in taken:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """(column, value, count) over everything counted so far."""
    merged = settled(spark, f"{path.rstrip('/')}/{MERGED}")
    parts = deltas(spark, path) + [merged] * Place(spark, merged).exists()
    if not parts:
        raise FileNotFoundError(f"no counts in {path}")
    counts = spark.read.schema(COUNTS).parquet(*parts)
    return counts.groupBy("column", "value").agg(F.max("count").alias("count"))


def frequency_maps(spark: SparkSession, path: str, columns: Sequence[str] = FREQUENCY_ENCODED) -> dict[str, DataFrame]:
    """Counts written by ``count_values`` as shares per value."""
    counts = latest_counts(spark, path)
    return {c: shares(counts.where(F.col("column") == c).select("value", "count")) for c in columns}
