"""Token counts: vocabulary strings proved to encode alone as one token are counted, only the rest is merged."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlight.llm.common import map_texts, texts
from ledgerlight.llm.vocabulary import word_counts, word_vocabulary


def token_counts(
    docs: DataFrame, vocabulary_path: str, limit: int = 2048, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text, one row for each row of docs.

    Null and empty texts have 0 bytes and tokens; a null key stays null; repeated rows are each counted; an
    empty table gives an empty result; other columns, whatever their names, are not read. Texts of any
    length are counted whole: longer ones are cut where the splitting pattern cuts anyway.
    """

    def work(batch: list[str]) -> dict[str, pa.Array]:
        counts = word_counts(word_vocabulary(vocabulary_path), batch)
        return {
            "n_bytes": pa.array([len(t.encode()) for t in batch], pa.int64()),
            "n_tokens": pa.array(counts, pa.int64()),
            "over_limit": pa.array(counts > limit, pa.bool_()),
        }

    return map_texts(
        texts(docs, key, text), work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )
