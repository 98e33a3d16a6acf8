"""Approximate nearest neighbours by counting collisions in single projections.

A chunk's vectors are projected on PROJECTIONS random lines, each kept as a sorted array. A query opens a window around
its own projection in every array and counts how often each vector lies inside; the windows are widened step by step
(virtual rehashing: only what a step adds is counted). Vectors whose count passes the collision threshold are
verified by the exact measure. The threshold follows from the distance of the k-th best so far: a vector at that
distance falls into a window with a known probability, and the count it reaches in all but a few cases
(CONFIDENCE deviations below its mean) is what others must reach. So the share of neighbours missed is set by
the parameters and not by the data's size.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.vectors import Best, best_of_all, collapse, usable

PROJECTIONS = 32
CONFIDENCE = 1.5
FIRST_WINDOW = 0.9
WIDENING = 1.4
ENOUGH = 0.5
SEED = 7


class CollisionIndex:
    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        squares = (vectors * vectors).sum(axis=1)
        self.reach = math.sqrt(float(squares.max()))
        unit = vectors / self.reach
        extra = np.sqrt(np.maximum(1 - (unit * unit).sum(axis=1), 0))
        lines = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, PROJECTIONS))
        self.lines = lines[:-1]
        places = (unit @ lines[:-1] + extra[:, None] * lines[-1]).T
        self.order = np.argsort(places, axis=1, kind="stable").astype(np.int32)
        places = np.take_along_axis(places, self.order, axis=1)
        # one ascending array for all projections: each lies in a band of its own
        self.low = float(places.min()) - 1
        self.band = float(places.max()) - self.low + 1
        self.bands = np.arange(PROJECTIONS) * self.band
        self.flat = (np.clip(places, self.low, None) + self.bands[:, None]).ravel()
        self.rows = np.arange(PROJECTIONS) * len(vectors)

    def cut(self, at: np.ndarray) -> np.ndarray:
        inside = np.clip(at, self.low, self.low + self.band - 0.5)
        return np.searchsorted(self.flat, inside + self.bands) - self.rows

    def search(self, query: np.ndarray, best: Best) -> None:
        length = math.sqrt(float(query @ query))
        here = (query / length) @ self.lines
        n = len(self.vectors)
        counts, verified = np.zeros(n, np.int64), np.zeros(n, bool)
        start = stop = self.cut(here)
        window = FIRST_WINDOW
        while True:
            a, b = self.cut(here - window), self.cut(here + window)
            fresh = [
                self.order[i, x:y] for i in range(PROJECTIONS) for x, y in ((a[i], start[i]), (stop[i], b[i])) if x < y
            ]
            if fresh:
                counts += np.bincount(np.concatenate(fresh), minlength=n)
            start, stop = a, b
            covered = bool((a == 0).all() and (b == n).all())
            while True:
                chance, needed = self.threshold(best, length, window)
                passing = np.flatnonzero((counts >= needed) & ~verified)
                if not len(passing):
                    break
                if len(best.scores) < best.k and len(passing) > 4 * best.k:
                    # the most frequent first: they raise the threshold for the others
                    passing = passing[np.argpartition(-counts[passing], 4 * best.k)[: 4 * best.k]]
                many = 4 * len(passing) > n
                best.take(passing, (self.vectors @ query)[passing] if many else self.vectors[passing] @ query)
                verified[passing] = True
            if covered or (len(best.scores) >= best.k and chance >= ENOUGH) or verified.all():
                best.settle((self.vectors[best.entries] * query).sum(axis=1))
                return
            window *= WIDENING

    def threshold(self, best: Best, length: float, window: float) -> tuple[float, int]:
        """The probability of a collision at the k-th best distance, and the count to reach."""
        least = best.least()
        if least == -np.inf:
            return 0.0, max(PROJECTIONS // 2, 1) if window < 4 else 0
        away = math.sqrt(max(2 - 2 * least / (length * self.reach), 1e-12))
        chance = math.erf(window / (away * math.sqrt(2)))
        return chance, math.floor(PROJECTIONS * chance - CONFIDENCE * math.sqrt(PROJECTIONS * chance * (1 - chance)))


def nearest(
    table: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for the rows whose id is divisible by ``every``.

    Scores are exact, in doubles; ties go to the smaller id. Rows with a null id, and null, empty, zero or non-finite
    vectors take no part; a query meets vectors of its own dimension; rows of the query's own id are not its candidates;
    repeated rows are one; other columns are not read; an empty table gives no row.
    """
    rows = usable(table, key, vector).where(F.exists("v", lambda x: x != 0))

    def search(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray):
        distinct, owners = collapse(ids, matrix, k + 1)
        index = CollisionIndex(distinct)
        found = []
        for query_id, query in zip(query_ids.tolist(), queries):
            best = Best(query_id, k, owners)
            index.search(query, best)
            found.append(best)
        return (
            np.repeat(query_ids, [len(b.ids) for b in found]),
            np.concatenate([b.ids for b in found]), np.concatenate([b.scores for b in found]),
        )

    return best_of_all(rows, F.col("vec_id") % every == 0, k, search, "double")
