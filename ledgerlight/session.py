"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the only session setting results depend on: date parts are read in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local, unconfigured session."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            configured = tempfile.mkdtemp(prefix="ledgerlight-")
            atexit.register(shutil.rmtree, configured, ignore_errors=True)
        context.setCheckpointDir(configured)
        current = context.getCheckpointDir()
    return configured or current


OWNERS: list[list[str]] = []
TABLE = "table:"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table inside the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if OWNERS:
        OWNERS[-1].append(path)
    return path


@contextmanager
def owned_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables written inside, once nothing computed from them is needed any more."""
    OWNERS.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        settings = spark.sparkContext._jsc.hadoopConfiguration()
        for name in OWNERS.pop():
            if name.startswith(TABLE):
                spark.sql(f"DROP TABLE IF EXISTS {name.removeprefix(TABLE)}")
                continue
            path = hadoop(name)
            path.getFileSystem(settings).delete(path, True)


def materialise(df: DataFrame, spread_by: str | None = None) -> DataFrame:
    """Write df to the shared folder once, so that later reads see the very same rows.

    A written table, not an RDD checkpoint: it is columnar, pruned when read back, and survives
    the loss of any executor. ``spread_by`` names a unique key to even out the files by, worth its one
    shuffle where the table will be read many times.
    """
    spark = df.sparkSession
    if spread_by is not None:
        df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), spread_by)
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by key, as many partitions as a shuffle has: what keyed_table writes as its buckets."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def keyed_table(df: DataFrame, key: str) -> DataFrame:
    """Write rows that ``dealt`` has put in place to the shared folder, in buckets by key, each sorted by it.

    Joins and groupings by that key then read each bucket in its own task, without shuffling this side again. Worth
    its one shuffle where a table meets others by key more than once. Buckets are numbered by the hash that has
    dealt the rows, so each task writes one file. The table is known to this session only, by a name of its own.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "keyed")
    name = f"ledgerlight_{uuid.uuid4().hex}"
    if OWNERS:
        OWNERS[-1].append(f"{TABLE}{name}")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)
