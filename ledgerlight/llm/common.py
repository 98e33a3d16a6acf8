"""What the text operators share: column choice, batches bounded in bytes, hashing of ids."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_CHARS = 500_000


def once(key: tuple, build: Callable[[], object]) -> object:
    """The same object for every task of a worker process: functions travel by value, module state doesn't."""
    kept = sys.__dict__.setdefault("_ledgerlight_kept", {})
    if key not in kept:
        kept[key] = build()
    return kept[key]


def release() -> None:
    """Give freed memory back to the system, so that a worker between two tasks holds little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) alone, a null text as the empty one; whatever else the table holds is left behind."""
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )


def crc32_mod(key: str | Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo divisor; a null key counts as the empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit(""))), F.lit(divisor))


def map_texts(
    df: DataFrame, work: Callable[[list[str]], dict[str, pa.Array]], schema: str, keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Apply work to runs of whole texts of about CHUNK_CHARS characters; its columns join the kept ones."""
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in byte_runs(batch.column("text"), CHUNK_CHARS):
                part = batch.slice(start, end - start)
                made = work(part.column("text").to_pylist())
                columns = [part.column(n) for n in names] + list(made.values())
                yield pa.RecordBatch.from_arrays(columns, names=names + list(made))
        release()

    return df.select(*names, "text").mapInArrow(run, schema)


def byte_runs(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose texts hold about ``most`` bytes; a longer text makes a range of its own."""
    if not len(column):
        return
    sizes = np.array([0 if x is None else x for x in pa.compute.binary_length(column).to_pylist()], dtype=np.int64)
    total = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = total[start - 1] if start else 0
        end = max(int(np.searchsorted(total, before + most, side="right")), start + 1)
        yield start, end
        start = end
