"""Byte-level byte-pair encoding and decoding in length-bucketed padded matrices (see merges)."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlight.llm.common import map_texts, texts
from ledgerlight.llm.vocabulary import byte_vocabulary, ids_of_texts


def encode_texts(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of every whole text as little-endian unsigned 32-bit integers.

    Each pre-token is merged by itself; a pre-token that is listed whole is its own id. Null and empty
    texts have no ids; a null key stays null; repeated rows each give a row; an empty table gives none;
    other columns are not read.
    """

    def work(batch: list[str]) -> dict[str, pa.Array]:
        ids = ids_of_texts(byte_vocabulary(ranks_path), batch)
        return {
            "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
            "ids": pa.array(ids, pa.binary()),
        }

    return map_texts(texts(docs, key, text), work, "doc_id long, n_tokens long, ids binary")


def decode_ids(coded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, decoded): the bytes that the ids stand for; null ids give null."""

    def run(batches):
        vocabulary = byte_vocabulary(ranks_path)
        for batch in batches:
            made = [None if x is None else vocabulary.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.binary())], names=["doc_id", "decoded"],
            )

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes every text, decodes its ids, keeps digests."""

    def work(batch: list[str]) -> dict[str, pa.Array]:
        vocabulary = byte_vocabulary(ranks_path)
        ids = ids_of_texts(vocabulary, batch)
        return {
            "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
            "decoded_sha256": pa.array([hashlib.sha256(vocabulary.decode(x)).hexdigest() for x in ids]),
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(texts(docs, key, text), work, schema)
