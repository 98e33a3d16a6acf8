import duckdb
import numpy as np

import corpus_pipeline
from ledgerlight.llm import pii, simhash, toxicity
from ledgerlight.llm.queries import ORACLE, QUERIES


def test_each_stage_works_on_all_its_predecessor_kept(spark, folder, tmp_path, some_docs):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = some_docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if name == "toxicity":
            kept = {r["doc_id"] for r in toxicity.scores(docs, labels).where("predicted = 0").collect()}
            assert {r["doc_id"] for r in out.collect()} == kept
        elif name == "simhash":
            kept = {r["doc_id"] for r in simhash.near_duplicates(docs).where("doc_id = component_id").collect()}
            assert {r["doc_id"] for r in out.collect()} == kept
        elif name == "pii":
            found = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
            before = {r["doc_id"]: r["text"] for r in docs.collect()}
            for r in out.collect():
                assert (r["text"] != before[r["doc_id"]]) == (found[r["doc_id"]] != "")
            assert pii.find(out).where("base <> ''").count() == 0
        else:
            ids = {r["doc_id"] for r in docs.collect()}
            assert {r["doc_id"] for r in out.collect()} == ids
            sizes = out.groupBy("sequence_id").sum("length").toPandas()["sum(length)"].to_numpy()
            assert (sizes <= 4096).all() and ((sizes == 4096) | (np.bitwise_count(sizes) == 1)).all()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == some_docs.columns
        docs = out


def test_run_gives_what_the_stages_give(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.groupBy("doc_id").count().count() > 100


def test_queries_with_sql(spark, folder):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    for name, sql in ORACLE.items():
        mine = QUERIES[name](spark, folder)
        columns = mine.columns
        theirs = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(map(repr, map(tuple, mine.collect()))) == sorted(map(repr, theirs))


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
