"""Missing-value cleaning with values fitted once and reusable on later batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.functions.values import empty_to_null, number_or_null
from ledgerlight.operators.profile import column_modes
from ledgerlight.operators.quantiles import SKETCH_ACCURACY, exact_quantiles, number_or_missing
from ledgerlight.schema import MEDIAN_FILLED, MODE_FILLED, UNKNOWN, UNKNOWN_FILLED
from ledgerlight.session import materialise

BELOW = "<"


@dataclass(frozen=True)
class Imputation:
    medians: dict[str, float]
    words: dict[str, str]

    def apply(self, df: DataFrame) -> DataFrame:
        kinds = dict(df.dtypes)
        filled = {}
        for name, value in self.medians.items():
            if name in kinds:
                filled[name] = F.coalesce(number_or_missing(number_or_null(name)), F.lit(float(value)))
        for name, value in self.words.items():
            if name in kinds:
                source = empty_to_null(name) if kinds[name] == "string" else F.col(name)
                # a date has no spelling for "Unknown" and then stays null
                filled[name] = F.coalesce(source, F.lit(value).try_cast(kinds[name]))
        return df.withColumns(filled)


def _text(name: str) -> Column:
    """The column as text, an empty one being missing."""
    return empty_to_null(F.col(name).cast("string"))


def fit_imputation(
    df: DataFrame,
    numeric: Sequence[str] = MEDIAN_FILLED,
    text: Sequence[str] = MODE_FILLED,
    unknown: Sequence[str] = UNKNOWN_FILLED,
    present: Mapping[str, int] | None = None,
) -> Imputation:
    """Median per numeric column (0 if it has none), mode per text column (ties: smallest value)."""
    numeric = [n for n in numeric if n in df.columns]
    text = [n for n in text if n in df.columns]
    found = exact_quantiles(df, {n: number_or_null(n) for n in numeric}, [0.5], present=present)
    moded = [n for n in text if n not in unknown]
    modes = column_modes(df, {n: _text(n) for n in moded}) if moded else {}
    words = {n: UNKNOWN if n in unknown else modes.get(n) or UNKNOWN for n in text}
    return Imputation({n: v[0] if v[0] is not None else 0.0 for n, v in found.items()}, words)


@dataclass(frozen=True)
class Fitted:
    """Fill values, the distinct values of the columns to be one-hot encoded, and the columns that still may hold nulls."""

    imputation: Imputation
    vocabulary: dict[str, list[str]]
    open: frozenset[str]


def fit_table(
    df: DataFrame,
    numeric: Sequence[str] = MEDIAN_FILLED,
    text: Sequence[str] = MODE_FILLED,
    unknown: Sequence[str] = UNKNOWN_FILLED,
    one_hot: Sequence[str] = (),
    limit: int | None = None,
) -> Fitted:
    """All fill values of a table, and its vocabulary, from two scans.

    The first counts the gaps and brackets each median by a sketch. The second counts, in one grouping with map-side
    combining, the values of text columns with gaps, those of the one-hot columns, and of numbers with gaps those inside
    the bracket and how many lie below it; so medians are exact. Complete identifiers are never grouped by value.
    More than ``limit`` values in a one-hot column are an error.
    """
    numeric, text = ([n for n in names if n in df.columns] for names in (numeric, text))
    one_hot = [n for n in one_hot if n in text]
    numbers = {n: number_or_missing(number_or_null(n)) for n in numeric}
    texts = {n: _text(n) for n in text}
    rows, present, brackets = _first_scan(df, numbers, texts)
    gaps = [n for n, count in present.items() if count < rows]
    moded = [n for n in texts if n in gaps and n not in unknown]
    bracketed = {n: brackets[n] for n in numbers if n in gaps and present[n]}

    medians, modes, vocabulary = {}, {}, {n: [] for n in one_hot}
    listed = list(dict.fromkeys([*moded, *one_hot]))
    if listed or bracketed:
        cells = _second_scan(df, {n: texts[n] for n in listed}, numbers, bracketed)
        modes = _modes(cells, moded)
        vocabulary = _vocabulary(cells, one_hot, limit)
        medians = _medians(cells, {n: present[n] for n in bracketed})
        unsettled = {n: numbers[n] for n in bracketed if n not in medians}
        for n, found in exact_quantiles(df, unsettled, [0.5], present=present).items():
            medians[n] = found[0]
    words = {n: UNKNOWN if n in unknown else modes.get(n) or UNKNOWN for n in text}
    # what has no gaps still gets its type, and no value is ever filled in there
    imputation = Imputation({**dict.fromkeys(numeric, 0.0), **medians}, words)
    kinds = dict(df.dtypes)
    unfilled = {n for n in gaps if n in text and kinds[n] != "string" and words[n] == UNKNOWN}
    return Fitted(imputation, {n: v or [words[n]] for n, v in vocabulary.items()}, frozenset(unfilled))


def _first_scan(
    df: DataFrame, numbers: Mapping[str, Column], texts: Mapping[str, Column],
) -> tuple[int, dict[str, int], dict[str, list[float]]]:
    """Rows, values per column, and two values that the median of a number lies between."""
    sides = F.array(*[F.lit(0.5 + side * 2 / SKETCH_ACCURACY) for side in (-1, 1)])
    sketches = [F.percentile_approx(c, sides, SKETCH_ACCURACY) for c in numbers.values()]
    counts = [F.count(c) for c in [*numbers.values(), *texts.values()]]
    found = df.agg(F.count(F.lit(1)), *[c.alias(f"m{i}") for i, c in enumerate([*counts, *sketches])]).first()
    names = [*numbers, *texts]
    return found[0], dict(zip(names, found[1:])), dict(zip(numbers, found[1 + len(names):]))


def _second_scan(
    df: DataFrame, texts: Mapping[str, Column], numbers: Mapping[str, Column], brackets: Mapping[str, Sequence[float]],
) -> DataFrame:
    """Written (column, value, number, count): values of texts, numbers inside their brackets, and those below by BELOW."""
    def cell(name: str, value: Column, number: Column) -> Column:
        return F.struct(F.lit(name).alias("column"), value.cast("string").alias("value"), number.cast("double").alias("number"))

    nothing = F.lit(None)
    items = [cell(n, c, nothing) for n, c in texts.items()]
    for n, (low, high) in brackets.items():
        inside = numbers[n].between(F.lit(low), F.lit(high))
        items.append(cell(n, F.when(numbers[n] < F.lit(low), BELOW), F.when(inside, numbers[n])))
    long = df.select(F.inline(F.array(*items))).where(F.col("value").isNotNull() | F.col("number").isNotNull())
    return materialise(long.groupBy("column", "value", "number").agg(F.count(F.lit(1)).alias("count")))


def _modes(cells: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """The most frequent value of each column; of equally frequent ones the smallest."""
    best = F.min(F.struct((-F.col("count")).alias("order"), "value")).alias("best")
    rows = cells.where(F.col("column").isin(list(names))).groupBy("column").agg(best).collect() if names else []
    return {row["column"]: row["best"]["value"] for row in rows}


def _vocabulary(cells: DataFrame, names: Sequence[str], limit: int | None) -> dict[str, list[str]]:
    if not names:
        return {}
    listed = cells.where(F.col("column").isin(list(names))).select("column", "value")
    rows = (listed if limit is None else listed.limit(len(names) * (limit + 1))).collect()
    found = {n: sorted(row["value"] for row in rows if row["column"] == n) for n in names}
    for name, values in found.items():
        require_small(name, len(values), limit)
    return found


def require_small(name: str, values: int, limit: int | None) -> None:
    if limit is not None and values > limit:
        raise ValueError(f"{name} has more than {limit} values; one-hot columns need a small vocabulary")


def _medians(cells: DataFrame, present: Mapping[str, int]) -> dict[str, float]:
    """Exact medians of columns with so many values, where the bracket holds them."""
    if not present:
        return {}
    ours = cells.where(F.col("column").isin(list(present)))
    # few values lie inside a bracket; the one cell without a number counts what lies below, and comes first
    order = Window.partitionBy("column").orderBy(F.col("number").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = ours.withColumn("upto", F.sum("count").over(order)).where(F.col("number").isNotNull())
    spark = cells.sparkSession
    wanted = [(n, r) for n, count in present.items() for r in ((count - 1) // 2, count // 2)]
    places = F.broadcast(spark.createDataFrame(wanted, "column string, rank long"))
    hit = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("count"))
    rows = ranked.join(places, "column").where(hit).select("column", "rank", "number").collect()
    found = {(row["column"], row["rank"]): row["number"] for row in rows}
    medians = {}
    for n, count in present.items():
        low, high = found.get((n, (count - 1) // 2)), found.get((n, count // 2))
        if low is not None and high is not None:
            medians[n] = low if low == high else low + (high - low) * 0.5
    return medians


def clean(
    df: DataFrame,
    numeric: Sequence[str] = MEDIAN_FILLED,
    text: Sequence[str] = MODE_FILLED,
    unknown: Sequence[str] = UNKNOWN_FILLED,
) -> DataFrame:
    """Fill one table from itself. Medians and modes are worked out only for columns with gaps; two scans in all."""
    if not any(n in df.columns for n in (*numeric, *text)):
        return df
    return fit_table(df, numeric, text, unknown).imputation.apply(df)
