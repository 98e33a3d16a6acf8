import os

import pytest
from pyspark.sql import functions as F

from ledgerlight import __main__ as cli
from ledgerlight.models import artifact as art
from ledgerlight.models.linear import LinearModel
from ledgerlight.operators.lookups import frequency_map
from ledgerlight.plans import detect
from ledgerlight.plans import prepare as prep
from ledgerlight.schema import RAW_SCHEMA
from ledgerlight.session import materialise, shared_folder
from ledgerlight.sources.tables import as_text, first_rows, read_csv, read_table, write_report, write_table
from ledgerlight.sources.txn import ID, transactions
from ledgerlight.streaming.counts import count_values, frequency_maps, read_in_batches


@pytest.fixture(scope="module")
def raw(spark, folder):
    return raw_table(spark, folder)


def raw_table(spark, folder):
    """The raw 23-column layout, filled from the transaction view."""
    t = transactions(spark, folder).withColumnRenamed(ID, "id")
    known = {"trans_num": F.concat(F.lit("t"), F.col("id").cast("string")), "zip": F.lpad("zip", 5, "0")}
    text = F.concat(F.lit("v"), (F.col("id") % 9).cast("string"))
    columns = []
    for f in RAW_SCHEMA.fields:
        source = known.get(f.name, F.col(f.name) if f.name in t.columns else text)
        columns.append(source.cast(f.dataType).alias(f.name))
    return materialise(t.select(*columns))


def test_column_counts_per_stage(raw):
    from ledgerlight.operators.impute import clean

    cleaned = clean(raw)
    assert len(cleaned.columns) == 23
    transformed = prep.transform(cleaned)
    vocabulary = 5 + 2
    assert len(transformed.columns) == 23 + 6 + 1 + 1 + vocabulary - 2
    reduced = prep.reduce_columns(transformed)
    assert len(reduced.columns) == len(transformed.columns) - 16
    assert prep.prepare(raw).sampled.count() == raw.count()
    done = prep.prepare(raw, sample_rows=400)
    # six sine and cosine columns for three; the key is carried along
    assert len(done.train.columns) == len(reduced.columns) + 3 + 1


def test_csv_keeps_identifiers_as_text(spark, raw, tmp_path):
    path = str(tmp_path / "raw_csv")
    shuffled = sorted(raw.columns)
    write_table(raw.select(*shuffled), path)
    back = read_csv(spark, path, RAW_SCHEMA)
    assert dict(back.dtypes)["zip"] == "string" and back.columns == shuffled
    assert any(r["zip"] and r["zip"].startswith("0") for r in back.select("zip").take(50))
    assert as_text(back.select(*raw.columns)).exceptAll(as_text(raw)).count() == 0
    assert read_table(spark, path, rows=7).count() == 7
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, str(tmp_path / "nothing"))


def test_csv_text_without_meaning_becomes_null(spark, tmp_path):
    path = str(tmp_path / "odd_csv")
    rows = [
        ("k1", "abc", "n/a", "yes", "1704067200.0", "01"), ("k2", "NA", "1980-02-30", "1", "x", "2"),
        ("k3", " 2.5 ", "1980-02-03", "no", "1704067200", ""), ("k4", "", "", "", "", "3"),
    ]
    names = "trans_num string, amt string, dob string, is_fraud string, unix_time string, zip string"
    write_table(spark.createDataFrame(rows, names), path)
    back = {r["trans_num"]: r for r in read_csv(spark, path, RAW_SCHEMA).collect()}
    assert [back[k]["amt"] for k in sorted(back)] == [None, None, 2.5, None]
    assert [str(back[k]["dob"]) for k in sorted(back)] == ["None", "None", "1980-02-03", "None"]
    assert [back[k]["is_fraud"] for k in sorted(back)] == [True, True, False, None]
    assert [back[k]["unix_time"] for k in sorted(back)] == [1704067200, None, 1704067200, None]
    assert [back[k]["zip"] for k in sorted(back)] == ["01", "2", None, "3"]


def test_first_rows_are_the_same_by_ranges(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    small, large = first_rows(events, "event_id", 100), first_rows(events, "event_id", 100, one_task_rows=10)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_reports_keep_the_scan_parallel(spark, raw, tmp_path):
    write_report(raw.where("amt > 0").select("trans_num", "amt"), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("part-*"))) == 1


def test_keys_are_neither_filled_nor_shared(raw):
    from ledgerlight.operators.impute import clean

    gap = raw.withColumn("trans_num", F.when(F.col("trans_num") != "t7", F.col("trans_num")))
    assert clean(gap).where("trans_num is null").count() == 1
    with pytest.raises(ValueError, match="no row key"):
        prep.prepare(gap)
    with pytest.raises(ValueError, match="no row key"):
        prep.prepare(raw.union(raw.limit(1)))


def test_flipped_source_labels_are_found(spark, raw):
    done = prep.prepare(raw)
    plain = art.bare(LinearModel(("amt",), (1.0,), 0.0))
    test = materialise(done.test)
    flipped = done.reduced.withColumn("is_fraud", F.when(F.col("trans_num") == test.first()["trans_num"], ~F.col("is_fraud")).otherwise(F.col("is_fraud")))
    missing = done.reduced.where(F.col("trans_num") != test.first()["trans_num"])
    for source in (flipped, missing, done.reduced.union(done.reduced)):
        with pytest.raises(ValueError, match="line up"):
            detect.evaluate(test, done.train, source, plain, rows=test.count() - 0)
    assert detect.evaluate(test, done.train, done.reduced, plain, rows=50).loss_capture.count() == 50


def test_overwrite_replaces(spark, raw, tmp_path):
    path = str(tmp_path / "t")
    write_table(raw, path)
    write_table(raw.limit(3), path)
    assert spark.read.parquet(path).count() == 3


def test_shared_folder_is_stable(spark):
    assert shared_folder(spark) == shared_folder(spark)


def test_counting_in_batches_equals_counting_at_once(spark, raw, tmp_path):
    files = str(tmp_path / "files")
    raw.select("job", "zip").repartition(3).write.parquet(files)
    stream = read_in_batches(spark, files, raw.select("job", "zip").schema)
    count_values(stream, str(tmp_path / "counts"))
    # a later call goes on from the checkpoint beside the counts: nothing is new
    count_values(read_in_batches(spark, files, raw.select("job", "zip").schema), str(tmp_path / "counts"))
    maps = frequency_maps(spark, str(tmp_path / "counts"))
    for column in ("job", "zip"):
        want = {r["value"]: r["frequency"] for r in frequency_map(raw, column).collect()}
        assert {r["value"]: r["frequency"] for r in maps[column].collect()} == want


def test_command_line_from_raw_to_reports(spark, tmp_path):
    folder = str(tmp_path / "work")
    # enough positives for a ranking to mean something
    write_table(raw_table(spark, "/root/testdata/sf0.01"), f"{folder}/raw")
    common = ["--folder", folder, "--sample-size", "6000", "--param-preset", "fast", "--models", "linear"]
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    cli.main(["all", *common])
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == before
    assert spark.read.parquet(f"{folder}/train").count() == 4800
    assert spark.read.parquet(f"{folder}/test").count() == 1200
    summary = spark.read.option("header", True).csv(f"{folder}/reports/evaluation/supervised_sgd_svm/summary")
    values = {r["metric"]: float(r["value"]) for r in summary.collect() if r["value"] is not None}
    assert values["tp"] + values["fn"] == 60 and values["roc_auc"] > 0.5
    missing = spark.read.option("header", True).csv(f"{folder}/reports/missing_values")
    assert missing.count() == 23
    cli.main(["train", *common, "--dry-run"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND|no model"):
        cli.main(["evaluate", "--folder", folder, "--models", "linear", "kernel"])
