import threading

import pytest
from pyspark.sql import functions as F

from ledgerlight.models import artifact as art
from ledgerlight.models.linear import LinearModel
from ledgerlight.sources import commit
from ledgerlight.sources.tables import read_table, write_report, write_table


def numbers(df):
    return sorted(int(r["n"]) for r in df.collect())


def failing(spark, bad=7):
    """Ten rows in five tasks, one of which fails after others have written."""
    rows = spark.range(10).repartition(5).select(F.col("id").alias("n"))
    return rows.select(F.when(F.col("n") == bad, F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("long").alias("n"))


def beside(tmp_path):
    return sorted(p.name for p in tmp_path.iterdir() if p.name.startswith("."))


@pytest.mark.parametrize("name", ["table", "table_csv"])
def test_a_failed_write_leaves_the_old_table(spark, tmp_path, name):
    path = str(tmp_path / name)
    with pytest.raises(Exception, match="lost"):
        write_table(failing(spark), path)
    assert not (tmp_path / name).exists() and not beside(tmp_path)
    write_table(spark.range(3).withColumnRenamed("id", "n"), path)
    with pytest.raises(Exception, match="lost"):
        write_table(failing(spark), path)
    assert numbers(read_table(spark, path)) == [0, 1, 2] and not beside(tmp_path)


def test_a_table_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.range(5).withColumnRenamed("id", "n"), path)
    for _ in range(3):
        write_table(read_table(spark, path).withColumn("n", F.col("n") * 2), path)
    assert numbers(read_table(spark, path)) == [0, 8, 16, 24, 32] and not beside(tmp_path)


def test_other_columns_and_formats_take_the_place_of_old_ones(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.range(5).withColumnRenamed("id", "old"), path)
    write_table(spark.range(2).select(F.col("id").alias("n"), F.lit("x").alias("t")), path)
    assert read_table(spark, path).columns == ["n", "t"] and numbers(read_table(spark, path)) == [0, 1]


def test_reports_and_models_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(spark.range(4).withColumnRenamed("id", "n"), path)
    with pytest.raises(Exception, match="lost"):
        write_report(failing(spark), path)
    assert numbers(spark.read.option("header", True).csv(path)) == [0, 1, 2, 3]

    model = str(tmp_path / "model")
    art.save(spark, art.Artifact(LinearModel(("a",), (1.0,), 2.0), threshold=0.5), model)
    with pytest.raises(Exception):
        art.save(spark, art.Artifact(LinearModel(("a",), (1.0,), 2.0), threshold="no number"), model)
    assert art.load(spark, model).threshold == 0.5
    art.save(spark, art.Artifact(LinearModel(("a",), (1.0,), 2.0), threshold=0.75), model)
    assert art.load(spark, model).threshold == 0.75 and not beside(tmp_path)


def crashed(spark, tmp_path, name, *states):
    """What a writer that stopped at a certain point leaves behind: folders of one number each."""
    for n, state in enumerate(states):
        where = tmp_path / (name if state == "" else f".{name}.{n}.{state}")
        spark.range(1).select(F.lit(n).cast("long").alias("n")).write.parquet(str(where))
    return str(tmp_path / name)


@pytest.mark.parametrize(
    "states, seen",
    [
        (("", commit.PART), 0),  # while writing
        (("", commit.READY), 0),  # complete, not yet in place
        ((commit.OLD, commit.READY), 1),  # the old one had stepped aside: the new one goes into place
        ((commit.OLD, commit.PART), 0),  # never to be: an incomplete one doesn't
        (("", commit.OLD), 0),  # all but tidied up
    ],
)
def test_a_write_that_broke_off_is_brought_to_its_end(spark, tmp_path, states, seen):
    path = crashed(spark, tmp_path, "table [1]", *states)
    assert commit.settled(spark, path) == path
    assert numbers(spark.read.parquet(path.replace("[", "\\[").replace("]", "\\]"))) == [seen]
    assert not any(n.endswith(commit.OLD) for n in beside(tmp_path))


def test_a_reader_may_finish_a_write(spark, tmp_path):
    path = crashed(spark, tmp_path, "table", commit.OLD, commit.READY)
    assert numbers(read_table(spark, path)) == [1]
    # the writer finds its version in place and is content
    commit.Place(spark, path).commit("1")
    assert numbers(read_table(spark, path)) == [1]


def test_writers_at_once_do_not_mix(spark, tmp_path):
    path, errors = str(tmp_path / "table"), []

    def write(k):
        try:
            write_table(spark.range(20).select((F.col("id") + 100 * k).alias("n")), path)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    writers = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    found = numbers(read_table(spark, path))
    assert not errors and len(found) == 20 and found[-1] - found[0] == 19 and not beside(tmp_path)
