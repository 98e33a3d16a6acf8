"""What both searches share: usable vectors, chunks of candidates against blocks of queries, the best of each query."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight.session import materialise

CHUNK_ROWS = 8192
BLOCK_ROWS = 1024


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): vectors of doubles that are not null or empty and hold no null, NaN or infinity; ids not null.

    Repeated rows, equal in id and vector, are one row.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = table.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(sound).distinct()


def best_of_all(
    vectors: DataFrame, is_query: Column, k: int,
    search: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
    score_type: str,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every query the k best of all other rows of the same dimension.

    ``search`` gets (ids, vectors) of one chunk of candidates and of one block of queries and returns (query ids, ids,
    scores), the k best of each query among them. Every chunk meets every block, each pair in a group of
    bounded size, however many rows share a vector.
    """
    rows = materialise(vectors)
    queries = rows.where(is_query)
    n_chunks = max(-(-rows.count() // CHUNK_ROWS), 1)
    n_blocks = max(-(-queries.count() // BLOCK_ROWS), 1)

    def deal(parts: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int")

    def all_of(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    dim = F.size("v").alias("dim")
    chunks = rows.select(dim, deal(n_chunks).alias("chunk"), all_of(n_blocks).alias("block"), "vec_id", "v")
    blocks = queries.select(dim, all_of(n_chunks).alias("chunk"), deal(n_blocks).alias("block"), "vec_id", "v")
    keys = ("dim", "chunk", "block")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        if left.num_rows and right.num_rows:
            found = search(*arrays(left), *arrays(right))
        return pa.table({
            "query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
            "score": pa.array(found[2].astype(np.int64 if score_type == "long" else float)),
        })

    partial = chunks.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(
        meet, f"query_id long, vec_id long, score {score_type}",
    )
    ranked = partial.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")),
    )
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and a matrix, in order of id."""
    ids = table.column("vec_id").to_numpy()
    flat = table.column("v").combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    matrix = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    return ids[order], matrix[order]


def collapse(ids: np.ndarray, matrix: np.ndarray, keep: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct vectors, and for each the smallest ``keep`` of its ids: more can never be among the best."""
    distinct, index = np.unique(matrix, axis=0, return_inverse=True)
    order = np.lexsort((ids, index.ravel()))
    starts = np.searchsorted(index.ravel()[order], np.arange(len(distinct) + 1))
    return distinct, [ids[order[a:min(b, a + keep)]] for a, b in zip(starts[:-1], starts[1:])]


class Best:
    """The k best (score, id) met so far for one query, equal scores in order of id."""

    def __init__(self, query_id: int, k: int, owners: list[np.ndarray]):
        self.query_id, self.k, self.owners = query_id, k, owners
        self.scores, self.ids, self.entries = np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)

    def take(self, entries: np.ndarray, scores: np.ndarray) -> None:
        if len(self.scores) >= self.k:
            open_ = scores >= self.least()
            entries, scores = entries[open_], scores[open_]
        if len(scores) > self.k:
            # entries below the k + 1 best of their own can't come in, even if one of these is the query itself
            own = scores >= np.partition(scores, len(scores) - self.k - 1)[len(scores) - self.k - 1]
            entries, scores = entries[own], scores[own]
        if not len(entries):
            return
        lists = [self.owners[e] for e in entries.tolist()]
        ids = np.concatenate(lists)
        sizes = [len(x) for x in lists]
        other = ids != self.query_id
        ids = np.concatenate((self.ids, ids[other]))
        each = np.concatenate((self.scores, np.repeat(scores, sizes)[other]))
        places = np.concatenate((self.entries, np.repeat(entries, sizes)[other]))
        order = np.lexsort((ids, -each))[: self.k]
        self.ids, self.scores, self.entries = ids[order], each[order], places[order]

    def settle(self, scores: np.ndarray) -> None:
        """Put exact scores of the held entries in place of those they were found by."""
        order = np.lexsort((self.ids, -scores))
        self.ids, self.scores, self.entries = self.ids[order], scores[order], self.entries[order]

    def least(self) -> float:
        """The score that an entry must reach; equal ones may still come in by their id."""
        return self.scores[-1] if len(self.scores) >= self.k else -np.inf
