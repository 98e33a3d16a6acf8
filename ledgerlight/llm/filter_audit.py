"""How filters interact: for every order of the filters, what each step removes, from count-weighted decision diagrams.

Each text is marked with the set of filters it fails. Per part these sets are counted before any shuffle of rows, so a
part is a diagram of at most 2^5 weighted leaves, whatever its size. Levels of the diagram are filters; one walk
through all orders swaps neighbouring levels, and the path on which everything passes gives the steps of an order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filters, in the order of their bits.
FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
MARKS = "[#$%&*|]"
BLANKS = "[\\x20\\x09-\\x0D]+"

STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)
Weight = tuple[int, int, int]


def plus(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


@dataclass(slots=True)
class Node:
    """Rows that pass (low) and fail (high) the filter of the node's level; weight is that of all of them."""

    low: Node | None
    high: Node | None
    weight: Weight


class Diagram:
    """A weighted diagram over failure sets. Equal nodes of a level are one; a swap rewrites two levels in place."""

    def __init__(self, filters: int, weights: dict[int, Weight]):
        self.order = list(range(filters))
        self.tables: list[dict[object, Node]] = [{} for _ in range(filters + 1)]
        self.root = self.build(0, 0, weights)

    def build(self, level: int, mask: int, weights: dict[int, Weight]) -> Node:
        if level == len(self.order):
            weight = weights.get(mask, (0, 0, 0))
            return self.tables[level].setdefault(weight, Node(None, None, weight))
        low = self.build(level + 1, mask, weights)
        return self.node(level, low, self.build(level + 1, mask | 1 << level, weights))

    def node(self, level: int, low: Node, high: Node) -> Node:
        table, key = self.tables[level], (id(low), id(high))
        if key not in table:
            table[key] = Node(low, high, plus(low.weight, high.weight))
        return table[key]

    def swap(self, level: int) -> None:
        """Exchange a level with the one below. Nodes of the upper level stay what they count, so none above changes."""
        uppers = list(self.tables[level].values())
        self.tables[level], self.tables[level + 1] = {}, {}
        for upper in uppers:
            low, high = upper.low, upper.high
            upper.low = self.node(level + 1, low.low, high.low)
            upper.high = self.node(level + 1, low.high, high.high)
        for upper in uppers:
            self.tables[level][id(upper.low), id(upper.high)] = upper
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, Node, Node]]:
        """(filter, what it keeps, what it removes) along the path on which every filter passes."""
        at = self.root
        for name in self.order:
            yield name, at.low, at.high
            at = at.low


def neighbour_swaps(n: int) -> Iterator[int]:
    """Positions whose swaps with the next lead through all orders of n things, one after another."""
    if n < 2:
        return
    inner, down = list(neighbour_swaps(n - 1)), True
    for i in range(len(inner) + 1):
        # the last thing walks through the others from end to end, then the others take one step of theirs
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if i < len(inner):
            yield inner[i] + 1 if down else inner[i]
        down = not down


def walk(weights: dict[int, Weight], filters: str = FILTERS) -> list[tuple]:
    """The rows of one part, for all orders: order, step, kept, removed, redundant, unique fails, lost, shapley."""
    diagram = Diagram(len(filters), weights)
    failing = [sum(w[0] for mask, w in weights.items() if mask >> i & 1) for i in range(len(filters))]
    alone = [weights.get(1 << i, (0, 0, 0))[0] for i in range(len(filters))]
    removed_by, rows = [0] * len(filters), []

    def read() -> None:
        order = "".join(filters[i] for i in diagram.order)
        for step, (name, low, high) in enumerate(diagram.steps(), start=1):
            removed, good, toxic = high.weight
            removed_by[name] += removed
            rows.append((order, step, name, low.weight[0], removed, failing[name] - removed, alone[name], good, toxic))

    read()
    for level in neighbour_swaps(len(filters)):
        diagram.swap(level)
        read()
    return [(order, step, *rest, removed_by[name]) for order, step, name, *rest in rows]


def steps_of_part(counts: pd.DataFrame) -> pd.DataFrame:
    """All orders of one part, whose counted failure sets are the rows of counts."""
    weights = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in counts.itertuples()}
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    made = pd.DataFrame(walk(weights), columns=names)
    made.insert(0, "part", counts["part"].iloc[0])
    return made


def bit(number: int, fails: Column) -> Column:
    return F.when(fails, F.lit(1 << number)).otherwise(F.lit(0))


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, mask): the filters each whole text fails, as bits of FILTERS.

    Copies are found by the SHA-256 digest of the text: the least doc_id of a digest comes from a grouping with
    map-side combining, and only digests that occur twice or more are joined to the rows.
    """
    read = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    parted = read.withColumn("words", F.array_remove(F.split("text", BLANKS), ""))
    words, length = F.size("words"), F.length("text")
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    marked = parted.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
        (
            bit(0, words < LEAST_WORDS)
            + bit(1, F.size(F.array_distinct("words")) * 100 < words * LEAST_DISTINCT)
            + bit(2, capitals.cast("long") * 100 > length * MOST_CAPITALS)
            + bit(3, F.col("text").rlike(MARKS))
        ).alias("mask"),
    )
    least = marked.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    repeated = least.where(F.col("n") > 1).select("digest", "least")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return marked.join(repeated, "digest", "left").select("doc_id", "part", (F.col("mask") + bit(4, copy)).alias("mask"))


def audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """One row per part, order of the filters and step; see STEPS for the columns.

    Null and empty texts are empty: they fail the filter on words only (and are copies of each other). A null part is
    the empty one. A row without a key is never a copy, makes no other row a copy and has no labels; rows with the same
    key and text are no copies of each other. A key with several labels counts as good or toxic if any says so.
    An empty table has no parts and gives no rows. Other columns are not read.
    """
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long").alias("good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long").alias("toxic"),
    )
    told = known.where("doc_id is not null").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    rows = failures(docs, key, text, part).join(told, "doc_id", "left")
    counts = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )
    return counts.groupBy("part").applyInPandas(steps_of_part, STEPS)
