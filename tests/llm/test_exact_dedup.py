import hashlib
import re

from pyspark.sql import functions as F

from ledgerlight.llm import exact_dedup as ed

BLANKS = re.compile("[\x20\x09-\x0D]+")


def plain(rows):
    """doc_id, keep_id, size, digest of every (doc_id, text); which of equal rows stays is left open."""
    groups = {}
    for i, t in rows:
        groups.setdefault(BLANKS.sub(" ", t or ""), []).append(i)
    out = []
    for i, t in rows:
        normal = BLANKS.sub(" ", t or "")
        ids = [x for x in groups[normal] if x is not None]
        out.append((i, min(ids, default=None), len(groups[normal]), hashlib.sha256(normal.encode()).hexdigest()))
    return sorted(out, key=repr)


def agrees(found, rows):
    found = found.collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=repr) == plain(rows)
    kept = [r for r in found if r["kept"]]
    assert len({r["text_sha256"] for r in kept}) == len(kept) == len({r["text_sha256"] for r in found})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def written(docs, path, files=1):
    docs.repartition(files).write.parquet(str(path))
    return str(path)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_documents_by_brute_force(spark, folder, some_docs, tmp_path):
    copies = some_docs.withColumn("doc_id", F.col("doc_id") - 100_000).withColumn("text", F.regexp_replace("text", " ", " \t\n"))
    docs = some_docs.unionByName(copies)
    agrees(ed.deduplicate(spark, f"{folder}/documents.parquet"), pairs(some_docs))
    agrees(ed.deduplicate(spark, written(docs, tmp_path / "docs", 5), files_per_batch=1), pairs(docs))


def test_colliding_digests_are_told_apart_by_bytes(spark, some_docs, tmp_path):
    docs = some_docs.unionByName(some_docs.withColumn("doc_id", -F.col("doc_id")))
    path = written(docs, tmp_path / "docs", 3)
    for chars in (1, 2, 3):
        agrees(ed.deduplicate(spark, path, files_per_batch=2, digest_chars=chars), pairs(docs))


def test_later_files_meet_the_state_of_earlier_ones(spark, tmp_path):
    path, state = tmp_path / "docs", str(tmp_path / "state")
    first = [(10, "a  b"), (11, "c"), (12, "a b")]
    spark.createDataFrame(first, "doc_id long, text string").coalesce(1).write.parquet(str(path))
    agrees(ed.deduplicate(spark, str(path), state, digest_chars=8), first)
    # a smaller identifier arrives late and takes the place of the one kept so far
    later = [(3, "a\tb"), (13, "d"), (14, "c")]
    spark.createDataFrame(later, "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(path))
    agrees(ed.deduplicate(spark, str(path), state, digest_chars=8), first + later)
    agrees(ed.deduplicate(spark, str(path), state, digest_chars=8), first + later)
    log = spark.read.parquet(f"{state}/log").where("batch <> 'none'")
    # the second call's batch holds what it changed, not the first call's digests alone
    assert log.groupBy("batch").count().count() == 2 and log.where("batch = '1'").count() == 3
    # on disk, as RocksDB leaves it, not as deltas of a map in memory
    kept = {p.suffix for p in (tmp_path / "state" / "checkpoint" / "state").glob("**/*.*") if not p.name.startswith(".")}
    assert kept & {".changelog", ".zip"} and ".delta" not in kept


def test_a_failed_batch_is_taken_up_again(spark, tmp_path, monkeypatch):
    path, state = written(spark.range(60).select(F.col("id").alias("doc_id"), (F.col("id") % 7).cast("string").alias("text")), tmp_path / "d", 4), str(tmp_path / "s")
    from pyspark.sql.readwriter import DataFrameWriter

    real, calls = DataFrameWriter.parquet, []

    def failing(self, where, *args, **kw):
        if "/log/batch=1" in where and not calls:
            calls.append(where)
            raise RuntimeError("lost")
        return real(self, where, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    try:
        ed.deduplicate(spark, path, state, files_per_batch=1)
    except Exception as error:  # noqa: BLE001
        assert "lost" in str(error)
    assert calls
    rows = [(i, str(i % 7)) for i in range(60)]
    agrees(ed.deduplicate(spark, path, state, files_per_batch=1), rows)


def test_hot_group(spark, tmp_path):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same  text").otherwise(F.concat(F.lit("t "), F.col("id") % 9000)).alias("text"),
    )
    agrees(ed.deduplicate(spark, written(docs, tmp_path / "d", 4), files_per_batch=2), pairs(docs))


def test_odd_documents(spark, odd_docs, no_docs, tmp_path):
    more = odd_docs.withColumn("_metadata", F.lit("x")).withColumn("digest", F.lit("x")).withColumn("keeper", F.lit(1))
    found = ed.deduplicate(spark, written(more, tmp_path / "odd", 3), files_per_batch=1)
    agrees(found, pairs(odd_docs))
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().toString())
    assert ed.deduplicate(spark, written(no_docs, tmp_path / "none")).collect() == []
    assert "rocksdb" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass") or "").lower()
