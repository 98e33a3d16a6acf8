"""Exact top-k by inner product: best-first search of M-trees.

One more coordinate, sqrt(M^2 - |x|^2), turns the largest inner product into the smallest Euclidean distance, so metric
trees apply. A chunk's tree has pages of routing entries, each with its pivot, covering radius and distance to the
parent pivot, and pages of vectors with their distances to the page's pivot. Pages are opened in order of their
lower bound; by the triangle inequality over the stored distances most entries are passed by uncomputed.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.vectors import Best, best_of_all, collapse, usable

PAGE = 512
FAN_OUT = 16
SLACK = 1e-9


@dataclass
class Page:
    """Entries of one node: vectors (a leaf) or pivots of child pages, with their distances to this page's pivot."""

    entries: np.ndarray
    block: np.ndarray
    to_pivot: np.ndarray
    radius: np.ndarray
    children: list["Page"] = field(default_factory=list)


class MetricTree:
    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        squares = (vectors * vectors).sum(axis=1)
        self.reach = float(squares.max())
        self.extra = np.sqrt(np.maximum(self.reach - squares, 0))
        everything = np.arange(len(vectors))
        self.root = self.page(everything, None)

    def distances(self, entries: np.ndarray, pivot: int) -> np.ndarray:
        gap = self.vectors[entries] - self.vectors[pivot]
        return np.sqrt((gap * gap).sum(axis=1) + (self.extra[entries] - self.extra[pivot]) ** 2)

    def page(self, entries: np.ndarray, pivot: int | None) -> Page:
        to_pivot = np.zeros(len(entries)) if pivot is None else self.distances(entries, pivot)
        if len(entries) <= PAGE:
            return Page(entries, self.vectors[entries], to_pivot, np.zeros(len(entries)))
        pivots = self.spread_pivots(entries)
        near = np.stack([self.distances(entries, p) for p in pivots])
        owner = near.argmin(axis=0)
        children, radius, kept = [], [], []
        for i, p in enumerate(pivots):
            mine = entries[owner == i]
            if len(mine):
                children.append(self.page(mine, p))
                radius.append(near[i, owner == i].max())
                kept.append(p)
        kept = np.array(kept)
        above = np.zeros(len(kept)) if pivot is None else self.distances(kept, pivot)
        return Page(kept, self.vectors[kept], above, np.array(radius), children)

    def spread_pivots(self, entries: np.ndarray) -> list[int]:
        """Farthest-first pivots; distinct vectors, so every pivot gets at least itself."""
        pivots = [int(entries[0])]
        nearest = self.distances(entries, pivots[0])
        while len(pivots) < FAN_OUT:
            far = int(nearest.argmax())
            pivots.append(int(entries[far]))
            nearest = np.minimum(nearest, self.distances(entries, pivots[-1]))
        return pivots

    def search(self, query: np.ndarray, best: Best) -> None:
        """Fill ``best`` with the largest inner products."""
        length = float(query @ query)
        base = length + self.reach
        slack = SLACK * (1 + np.sqrt(base))

        def limit() -> float:
            """The distance beyond which nothing can be among the best; ties are still inside."""
            least = best.least()
            return np.inf if least == -np.inf else np.sqrt(max(base - 2 * least, 0.0)) + slack

        waiting: list[tuple[float, int, Page, float | None]] = [(0.0, 0, self.root, None)]
        pushed = 0
        while waiting:
            bound, _, page, from_pivot = heapq.heappop(waiting)
            most = limit()
            if bound > most:
                return
            if from_pivot is None:
                chosen = np.arange(len(page.entries))
            else:
                chosen = np.flatnonzero(np.abs(from_pivot - page.to_pivot) - page.radius <= most)
            if not len(chosen):
                continue
            few = 2 * len(chosen) < len(page.entries)
            products = page.block[chosen] @ query if few else (page.block @ query)[chosen]
            if not page.children:
                best.take(page.entries[chosen], products)
                continue
            away = np.sqrt(np.maximum(base - 2 * products, 0))
            lower = np.maximum(away - page.radius[chosen] - slack, 0)
            for i, d, b in zip(chosen.tolist(), away.tolist(), lower.tolist()):
                if b <= most:
                    pushed += 1
                    heapq.heappush(waiting, (b, pushed, page.children[i], d))


def top_k(
    table: DataFrame, k: int = 5, every: int = 50, scale: int = 256, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): exact, for the rows whose id is divisible by ``every`` against all others.

    Components become floor(scale * x); scores are integer inner products, ties go to the smaller id. Rows with a null
    id, and null, empty or non-finite vectors take no part; a query meets vectors of its own dimension; rows of the
    query's own id are not its candidates; repeated rows are one; other columns are not read; an empty table gives
    no row. Products must stay below 2^53 in size, as they are summed in doubles.
    """
    rows = usable(table, key, vector)
    whole = F.transform("v", lambda x: F.floor(x * scale).cast("double"))
    vectors = rows.select("vec_id", whole.alias("v"))

    def search(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray):
        distinct, owners = collapse(ids, matrix, k + 1)
        tree = MetricTree(distinct)
        found = []
        for query_id, query in zip(query_ids.tolist(), queries):
            best = Best(query_id, k, owners)
            tree.search(query, best)
            found.append(best)
        return (
            np.repeat(query_ids, [len(b.ids) for b in found]),
            np.concatenate([b.ids for b in found]), np.concatenate([b.scores for b in found]),
        )

    return best_of_all(vectors, F.col("vec_id") % every == 0, k, search, "long")
