"""A document pipeline of four text operators: toxic documents go, near-duplicates go, personal data is
masked, what is left is packed into sequences.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.llm import packing, pii, simhash, toxicity
from ledgerlight.llm.common import load
from ledgerlight.llm.queries import WORDS
from ledgerlight.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the toxicity operator predicts toxic go, with the labels it may learn from."""
    return toxicity.without_toxic(docs, load(spark, folder, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one of smallest doc_id."""
    return simhash.one_of_each(docs, words=3, distance=3)


def mask_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every span found is replaced by its kind; n_chars is counted anew."""
    return pii.without_personal_data(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents and their ids, with their places in sequences of 4096 tokens."""
    return packing.pack(docs, WORDS, window=4096, end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: Nearest-neighbour votes and packing plans have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a written table in the shared folder."""
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
