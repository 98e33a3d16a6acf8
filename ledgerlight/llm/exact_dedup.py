"""Exact duplicates by streams with keyed state: digest, smallest identifier and content locator.

The files of a table are read as a stream, some per batch: each row leaves its digest and its locator, the file and the
place there. A second stream keys these by digest. Its state lies on disk (RocksDB, backed up to the shared folder),
holds one entry per digest and never expires, so files that come later are compared with all before them, and a
stream that is started again goes on where it stopped. Rows whose digest has been met are fetched by their locators
and checked by their full bytes; texts that differ under one digest are told apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ledgerlight.session import materialise, scratch_path

#: The blanks, runs of which count as one space.
BLANKS = "\t\n\v\f\r"
BATCHES = 4
HOT_SHARE = 1000

KEEPER = "struct<unnamed: boolean, doc_id: bigint, file: string, place: bigint>"
ROWS = "doc_id long, digest string, text_sha256 string, file string, place long"
LOG = f"digest string, keeper {KEEPER}, size long"

STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # a batch uploads what it has changed, not all of the state again
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # otherwise every partition of the state reserves megabytes for files of a few hundred bytes
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a stream's start and run; the old ones come back."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def normal(text: Column) -> Column:
    """The text with each run of blanks made one space. Runs are rare, so they are looked for before they are replaced."""
    spaced = text
    for blank in BLANKS:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)


def whole(text: str) -> Column:
    return normal(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))


def locator() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")]


def marked(rows: DataFrame, key: str, text: str, digest_chars: int) -> DataFrame:
    """doc_id, digest and locator of every row that was read from files."""
    located = rows.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.sha2(whole(text), 256).alias("text_sha256"), *locator())
    return located.select("doc_id", F.substring("text_sha256", 1, digest_chars).alias("digest"), "text_sha256", "file", "place")


def keeper() -> Column:
    """What a state entry retains: the smallest identifier, null last, and the locator of its row."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "place"))


def fields(spark: SparkSession, path: str, key: str, text: str) -> str:
    """The two columns that are read, with the types they have in the files."""
    kinds = dict(spark.read.parquet(path).dtypes)
    return f"`{key}` {kinds[key]}, `{text}` {kinds[text]}"


def source(spark: SparkSession, path: str) -> str:
    """The path for a stream: one that is a file itself is named by a pattern, as streams take folders or patterns."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place)
    return f"{path[:-1]}[{path[-1]}]" if status.isFile() else path


def per_batch(spark: SparkSession, path: str, wanted: int | None) -> int:
    return wanted or max(1, -(-len(spark.read.parquet(path).inputFiles()) // BATCHES))


def finish(stream: DataStreamWriter) -> None:
    """Run a stream until it has taken in everything that is there."""
    running = stream.trigger(availableNow=True).start()
    try:
        running.awaitTermination()
    finally:
        running.stop()


def advance(
    spark: SparkSession, path: str, state: str, key: str = "doc_id", text: str = "text",
    files_per_batch: int | None = None, digest_chars: int = 64,
) -> tuple[DataFrame, DataFrame]:
    """Take in all files not seen before; returns all rows so far (see ROWS) and (digest, keeper, size) of every digest.

    ``state`` is a folder that all executors reach. It holds the checkpoints of both streams, with the keyed state, the
    rows, and a log of the entries each batch changed; a batch that is run again after a failure writes its part anew.
    """
    state = state.rstrip("/")
    rows, log = f"{state}/rows", f"{state}/log"
    spark.createDataFrame([], LOG).write.mode("ignore").parquet(f"{log}/batch=none")
    arriving = (
        spark.readStream.schema(fields(spark, path, key, text))
        .option("maxFilesPerTrigger", per_batch(spark, path, files_per_batch)).parquet(source(spark, path))
    )
    finish(
        marked(arriving, key, text, digest_chars).writeStream.format("parquet")
        .option("path", rows).option("checkpointLocation", f"{state}/rows_checkpoint")
    )
    seen = spark.read.schema(ROWS).parquet(rows)
    keyed = (
        spark.readStream.schema(ROWS).option("maxFilesPerTrigger", files_per_batch or max(1, -(-len(seen.inputFiles()) // BATCHES)))
        .parquet(rows)
    )
    entries = keyed.groupBy("digest").agg(keeper().alias("keeper"), F.count(F.lit(1)).alias("size"))

    def write(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{log}/batch={number}")

    with settings(spark, STORE):
        finish(
            entries.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", f"{state}/checkpoint")
        )
    # a keeper only ever gets smaller and a size larger, so the extremes are the last state
    last = spark.read.schema(LOG).parquet(log).groupBy("digest")
    return seen, last.agg(F.min("keeper").alias("keeper"), F.max("size").alias("size"))


def with_entries(rows: DataFrame, entries: DataFrame, total: int) -> DataFrame:
    """rows with the entry of their digest.

    Digests that hold more than one row in HOT_SHARE, which are fewer than HOT_SHARE, come by broadcast. Their
    rows then go to the other join under keys that match nothing and differ, so no task gets many of one digest.
    """
    hot = F.col("size") > total // HOT_SHARE
    common = entries.where(hot).select("digest", F.struct("keeper", "size").alias("common"))
    rare = entries.where(~hot).select(F.col("digest").alias("rare_digest"), F.struct("keeper", "size").alias("rare"))
    looked_up = rows.join(F.broadcast(common), "digest", "left")
    spread = F.concat(F.lit("#"), F.pmod(F.xxhash64("file", "place"), F.lit(100_000)).cast("string"))
    asked = F.when(F.col("common").isNull(), F.col("digest")).otherwise(spread)
    joined = looked_up.withColumn("asked", asked).join(rare, F.col("asked") == F.col("rare_digest"), "left")
    entry = F.coalesce("common", "rare")
    return joined.select(*rows.columns, entry["keeper"].alias("keeper"), entry["size"].alias("size"))


def deduplicate(
    spark: SparkSession, path: str, state: str | None = None, key: str = "doc_id", text: str = "text",
    files_per_batch: int | None = None, digest_chars: int = 64,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of the Parquet table at path.

    Texts are equal when they are after each run of blanks is made one space; null counts as empty. Of equal texts the row
    with the smallest doc_id stays; rows without a doc_id come last, and of rows with the same one the first by file and
    place in it stays. keep_id is null where no row of a group has a doc_id. An empty table gives no rows; other columns
    are not read. With ``state`` of an earlier call, only files that came since pass through the streams.
    ``digest_chars`` shortens the digest: results stay the same, as full bytes decide.
    """
    state = state or scratch_path(spark, "state")
    rows, entries = advance(spark, path, state, key, text, files_per_batch, digest_chars)
    entries = materialise(entries)
    total = entries.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    found = materialise(with_entries(rows, entries, total))

    texts = fetched(spark, path, key, text, found.where("size > 1").select("doc_id", "digest", "file", "place"))
    several = texts.groupBy("digest", "normal").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").agg(F.count(F.lit(1)).alias("texts"))
    collided = materialise(several.where("texts > 1").select("digest"))
    if not collided.isEmpty():
        # as good as never: digests that stand for several texts are grouped by the texts themselves
        apart = materialise(texts.join(collided, "digest"))
        by_text = apart.groupBy("digest", "normal").agg(keeper().alias("keeper"), F.count(F.lit(1)).alias("size"))
        own = apart.join(by_text, ["digest", "normal"]).withColumn("text_sha256", F.sha2("normal", 256))
        found = found.join(collided, "digest", "left_anti").unionByName(own.select(found.columns))
    kept = (F.col("file") == F.col("keeper.file")) & (F.col("place") == F.col("keeper.place"))
    return found.select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), F.col("size").alias("group_size"), kept.alias("kept"), "text_sha256",
    )


def fetched(spark: SparkSession, path: str, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """wanted with the normalised text its locators lead to. Locators are unique, so no task gets more than its share."""
    raw = spark.read.schema(fields(spark, path, key, text)).parquet(path)
    located = raw.select(F.col(f"`{text}`").cast("string").alias("raw"), *locator())
    return located.join(wanted, ["file", "place"]).withColumn("normal", whole("raw")).drop("raw")
