"""Exact-size, repeatable samples and splits.

Rows are put in a fixed random-looking order by md5 of seed and key. Taking the first n of that order
needs no sort and no window over the table: counts per hash prefix show where the n-th row lies, the
prefix is lengthened until few rows share it, and the cut itself is one (hash, key) pair. The sample
is then a plain filter, without any shuffle. Keys must be unique (see lookups.require_key): rows that
share one stand at the same place and are taken or left together.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.functions.values import flag_column
from ledgerlight.schema import SAMPLE_RATE, SCATTER_NEGATIVES, SEED, TEST_SHARE

PREFIX_STEP = 4
RANKED_ROWS = 100_000
DIGEST_LENGTH = 32


def hash_order(key: str, seed: int | str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def class_counts(df: DataFrame, label: str) -> dict[bool, int]:
    rows = df.groupBy(flag_column(df, label).alias("label")).count().collect()
    counts = {False: 0, True: 0}
    counts.update({row["label"]: row["count"] for row in rows})
    return counts


@dataclass(frozen=True)
class ClassCuts:
    """The first quota rows of each class: all, none, or those up to a (hash, key) pair."""

    label: str
    key: str
    seed: int | str
    cuts: Mapping[bool, tuple[str, object] | bool]

    def chosen(self, df: DataFrame) -> Column:
        """Only the branch of the row's own class is evaluated, so each row is hashed at most once."""
        flag, kind = flag_column(df, self.label), df.schema[self.key].dataType
        place = F.struct(hash_order(self.key, self.seed).alias("digest"), F.col(self.key).alias("key"))

        def within(cut: tuple[str, object] | bool) -> Column:
            if isinstance(cut, bool):
                return F.lit(cut)
            digest, key = cut
            return place <= F.struct(F.lit(digest).alias("digest"), F.lit(key).cast(kind).alias("key"))

        return F.when(flag, within(self.cuts.get(True, False))).otherwise(within(self.cuts.get(False, False)))

    def take(self, df: DataFrame) -> DataFrame:
        return df.where(self.chosen(df))

    def rest(self, df: DataFrame) -> DataFrame:
        return df.where(~self.chosen(df))


def first_by_class(
    df: DataFrame,
    label: str,
    key: str,
    quotas: Mapping[bool, int],
    counts: Mapping[bool, int],
    seed: int | str = SEED,
    ranked_rows: int = RANKED_ROWS,
) -> ClassCuts:
    """Find the cut of each class so that exactly its quota lies before it (all rows if it has fewer)."""
    return first_by_class_many(df, label, key, [quotas], counts, seed, ranked_rows)[0]


@dataclass(frozen=True)
class _Sought:
    """The quota-th row of a class among those whose hash begins with prefix, for the n-th set of quotas."""

    n: int
    label: bool
    prefix: str
    quota: int


def first_by_class_many(
    df: DataFrame,
    label: str,
    key: str,
    wanted: Sequence[Mapping[bool, int]],
    counts: Mapping[bool, int],
    seed: int | str = SEED,
    ranked_rows: int = RANKED_ROWS,
) -> list[ClassCuts]:
    """The cuts of several sets of quotas, all found in the same passes."""
    cuts: list[dict[bool, tuple[str, object] | bool]] = [{} for _ in wanted]
    left = []
    for n, quotas in enumerate(wanted):
        for value, quota in quotas.items():
            if quota >= counts.get(value, 0):
                cuts[n][value] = True
            elif quota <= 0:
                cuts[n][value] = False
            else:
                left.append(_Sought(n, value, "", quota))
    keyed = df.select(flag_column(df, label).alias("label"), hash_order(key, seed).alias("digest"), F.col(key).alias("key"))
    biggest, length = max((counts[s.label] for s in left), default=0), 0
    while biggest > ranked_rows and length < DIGEST_LENGTH:
        length += PREFIX_STEP
        left, biggest = _cut_prefix(keyed, left, length)
    for n, value, cut in _cut_rows(keyed, left, length):
        cuts[n][value] = cut
    return [ClassCuts(label, key, seed, own) for own in cuts]


def _under(left: Sequence[_Sought]) -> Column:
    parts = [
        (F.col("label") == F.lit(v)) & F.col("digest").startswith(p) for v, p in dict.fromkeys((s.label, s.prefix) for s in left)
    ]
    return reduce(or_, parts)


def _targets(keyed: DataFrame, left: Sequence[_Sought]) -> DataFrame:
    """One row per cut still sought."""
    rows = [(s.n, s.label, s.prefix, s.quota) for s in left]
    return F.broadcast(keyed.sparkSession.createDataFrame(rows, "n int, label boolean, parent string, quota long"))


def _cut_prefix(keyed: DataFrame, left: Sequence[_Sought], length: int) -> tuple[list[_Sought], int]:
    """Lengthen the prefixes; at most 16 ** PREFIX_STEP longer ones for each reach the window."""
    prefix = F.substring("digest", 1, length)
    counts = keyed.where(_under(left)).groupBy("label", prefix.alias("prefix")).agg(F.count("*").alias("rows"))
    parent = F.substring("prefix", 1, length - PREFIX_STEP)
    order = Window.partitionBy("label", "parent").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("parent", parent).withColumn("upto", F.sum("rows").over(order))
    hit = (F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("rows") < F.col("quota"))
    found = upto.join(_targets(keyed, left), ["label", "parent"]).where(hit).collect()
    narrowed = [_Sought(r["n"], r["label"], r["prefix"], r["quota"] - (r["upto"] - r["rows"])) for r in found]
    return narrowed, max(r["rows"] for r in found)


def _cut_rows(keyed: DataFrame, left: Sequence[_Sought], length: int) -> list[tuple[int, bool, tuple[str, object]]]:
    if not left:
        return []
    parent = F.substring("digest", 1, length) if length else F.lit("")
    order = Window.partitionBy("label", "parent").orderBy("digest", "key")
    ranked = keyed.where(_under(left)).withColumn("parent", parent).withColumn("rank", F.row_number().over(order))
    rows = ranked.join(_targets(keyed, left), ["label", "parent"]).where(F.col("rank") == F.col("quota")).collect()
    return [(r["n"], r["label"], (r["digest"], r["key"])) for r in rows]


def rate_quotas(size: int, rate: float) -> dict[bool, int]:
    positives = round(size * rate)
    return {True: positives, False: size - positives}


def sample_by_rate(
    df: DataFrame,
    label: str,
    key: str,
    size: int,
    rate: float = SAMPLE_RATE,
    seed: int | str = SEED,
    counts: Mapping[bool, int] | None = None,
) -> DataFrame:
    """Exactly ``size`` rows, ``rate`` of them positive; an error if a class has too few."""
    quotas = rate_quotas(size, rate)
    counts = counts or class_counts(df, label)
    short = {v: (q, counts[v]) for v, q in quotas.items() if counts[v] < q}
    if short:
        text = ", ".join(f"{label}={v}: needed {q}, available {n}" for v, (q, n) in short.items())
        raise ValueError(f"not enough rows for the sample ({text})")
    return first_by_class(df, label, key, quotas, counts, seed).take(df)


def share_quotas(counts: Mapping[bool, int], size: int) -> dict[bool, int]:
    """Split ``size`` over the classes by their shares; what is left goes to the largest remainders."""
    total = sum(counts.values())
    whole = {v: size * n // total for v, n in counts.items()}
    order = sorted(counts, key=lambda v: (-(size * counts[v] % total), v))
    for value in order[: size - sum(whole.values())]:
        whole[value] += 1
    return whole


def split(
    df: DataFrame,
    label: str,
    key: str,
    test_share: float = TEST_SHARE,
    seed: int | str = SEED,
    counts: Mapping[bool, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train and test, disjoint and complete, with the classes in the same shares."""
    counts = counts or class_counts(df, label)
    total = sum(counts.values())
    test_rows = math.ceil(total * test_share)
    cuts = first_by_class(df, label, key, share_quotas(counts, test_rows), counts, seed)
    return cuts.rest(df), cuts.take(df)


def subsample(df: DataFrame, label: str, key: str, size: int | None, seed: int | str = SEED) -> DataFrame:
    """``size`` rows with the classes in the same shares; everything if that is not fewer."""
    counts = class_counts(df, label)
    if size is None or size >= sum(counts.values()):
        return df
    return first_by_class(df, label, key, share_quotas(counts, size), counts, seed).take(df)


def undersample(df: DataFrame, label: str, key: str, ratio: int, seed: int | str = SEED) -> DataFrame:
    """All positives and at most ``ratio`` negatives for each of them."""
    counts = class_counts(df, label)
    quotas = {True: counts[True], False: ratio * counts[True]}
    return first_by_class(df, label, key, quotas, counts, seed).take(df)


def with_undersamples(
    df: DataFrame, label: str, key: str, ratios: Mapping[str, int], counts: Mapping[bool, int], seed: int | str = SEED,
) -> DataFrame:
    """The rows of the widest undersample, with a flag column per name that says which belong to its ratio's."""
    quotas = [{True: counts[True], False: ratio * counts[True]} for ratio in ratios.values()]
    cuts = dict(zip(ratios, first_by_class_many(df, label, key, quotas, counts, seed)))
    widest = max(ratios, key=lambda name: ratios[name])
    return cuts[widest].take(df).withColumns({name: cut.chosen(df) for name, cut in cuts.items()})


def scatter(
    df: DataFrame, label: str, key: str, negatives: int = SCATTER_NEGATIVES, seed: int | str = SEED,
    counts: Mapping[bool, int] | None = None,
) -> DataFrame:
    """All positives and at most ``negatives`` others."""
    counts = counts or class_counts(df, label)
    return first_by_class(df, label, key, {True: counts[True], False: negatives}, counts, seed).take(df)


def take_rows(df: DataFrame, key: str, size: int, seed: int | str = SEED) -> DataFrame:
    """Exactly ``size`` rows regardless of class (all of them if there are fewer)."""
    plain = df.withColumn("_all", F.lit(True))
    return first_by_class(plain, "_all", key, {True: size}, {True: df.count()}, seed).take(plain).drop("_all")


def fraction_then_trim(df: DataFrame, key: str, size: int, total: int, seed: int = SEED) -> DataFrame:
    """About size / total of the rows, trimmed to at most ``size``; everything if size is not fewer.

    The fraction is decided by each row's own hash, so a recomputed partition picks the same rows.
    """
    if size >= total:
        return df
    units = 1_000_000
    kept = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(units)) < math.ceil(units * size / total)
    return take_rows(df.where(kept), key, size, seed)


def shuffled(df: DataFrame, key: str, seed: int | str = SEED) -> DataFrame:
    """Random-looking but repeatable order; a distributed range sort."""
    return df.orderBy(hash_order(key, seed), key)


def union_parts(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
