"""The tables behind the exploratory charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.functions.features import distance_bucket, one_hot_label
from ledgerlight.functions.values import cap
from ledgerlight.operators.lookups import complete_calendar
from ledgerlight.operators.quantiles import exact_quantiles, interval_index, number_or_missing
from ledgerlight.schema import CAP_QUANTILE, DISTANCE, HISTOGRAM_BINS, TARGET, WEEKDAY_LABELS
from ledgerlight.session import materialise


def rate_by(df: DataFrame, group: Column | str, name: str, label: str = TARGET) -> DataFrame:
    """Share of positives per group; rows without a group are left out."""
    source = F.col(group) if isinstance(group, str) else group
    grouped = df.select(source.alias(name), F.col(label).cast("double").alias("_hit")).groupBy(name)
    # the one group without a name goes after counting: a filter on the name would be pushed down to
    # the scan, where the whole expression behind it is worked out a second time
    named = grouped.agg(F.avg("_hit").alias("fraud_rate"), F.count(name).alias("_named"))
    return named.where("_named > 0").drop("_named")


def rate_by_distance(df: DataFrame, label: str = TARGET) -> DataFrame:
    return rate_by(df, distance_bucket(DISTANCE), "distance_bucket", label)


def rate_by_weekday(df: DataFrame, label: str = TARGET) -> DataFrame:
    rates = rate_by(df, "transaction_day_of_week", "transaction_day_of_week", label)
    return complete_calendar(rates, "transaction_day_of_week", "fraud_rate", WEEKDAY_LABELS)


def with_category(df: DataFrame, prefix: str = "category_") -> DataFrame:
    """Read the category back from its one-hot columns."""
    columns = [n for n in df.columns if n.startswith(prefix)]
    return df.withColumn(prefix.rstrip("_"), one_hot_label(columns, prefix))


def category_summary(df: DataFrame, category: str = "category", label: str = TARGET) -> DataFrame:
    """Transactions, positives and percent of positives per category, highest rate first."""
    flag = F.col(label).cast("int")
    grouped = df.where(F.col(category).isNotNull()).groupBy(category).agg(
        F.count(label).alias("transaction_count"),
        F.sum(flag).alias("fraud_count"),
        F.round(F.avg(flag) * 100, 4).alias("fraud_rate_percent"),
    )
    return grouped.orderBy(F.desc("fraud_rate_percent"), category)


def class_columns(value: Column, classes: Sequence[bool], label: str = TARGET) -> dict[str, Column]:
    """The value split into one column per class, so that one pass serves all classes."""
    return {str(c): F.when(F.col(label) == F.lit(c), value) for c in classes}


Found = dict[str, list[float | None]]


def amount_summary(df: DataFrame, amount: str = "amt", label: str = TARGET, found: Found | None = None) -> DataFrame:
    """Count, mean, median, upper quantiles and maximum of the amount per class.

    ``found`` holds the quantiles of each class if they are known already.
    """
    probabilities = {"median": 0.5, "q90": 0.9, "q95": 0.95, "q99": 0.99}
    if found is None:
        found = exact_quantiles(df, class_columns(F.col(amount), (False, True), label), list(probabilities.values()))
    quantile = {
        n: F.when(F.col(label), F.lit(found["True"][i]).cast("double")).otherwise(F.lit(found["False"][i]).cast("double"))
        for i, n in enumerate(probabilities)
    }
    grouped = df.groupBy(label).agg(F.count(amount).alias("count"), F.avg(amount).alias("mean"), F.max(amount).alias("max"))
    return grouped.select(
        F.initcap(F.col(label).cast("string")).alias(label),
        "count",
        F.round("mean", 2).alias("mean"),
        *[F.round(c, 2).alias(n) for n, c in quantile.items()],
        F.round("max", 2).alias("max"),
    )


def capped(df: DataFrame, column: str, probability: float = CAP_QUANTILE) -> DataFrame:
    """Cut the upper tail at an exact quantile."""
    upper = exact_quantiles(df, [column], [probability])[column][0]
    return df.withColumn(column, cap(column, upper))


def histogram_edges(low: float, high: float, bins: int) -> list[float]:
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def value_ranges(df: DataFrame, values: dict[str, Column]) -> dict[str, tuple[float | None, float | None]]:
    """Smallest and largest of several values in one pass."""
    numbers = {n: number_or_missing(c) for n, c in values.items()}
    row = df.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(n) for n, c in numbers.items()]).first()
    return {n: (row[n]["low"], row[n]["high"]) for n in values}


def histogram(
    df: DataFrame,
    value: Column | str,
    bins: int = HISTOGRAM_BINS,
    ends: tuple[float | None, float | None] | None = None,
) -> DataFrame:
    """Equal-width bins over the value range, the last one closed; empty bins are listed too."""
    source = F.col(value) if isinstance(value, str) else value
    numbers = df.select(number_or_missing(source).alias("value"))
    low, high = ends or value_ranges(numbers, {"value": F.col("value")})["value"]
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, low double, high double, count bigint")
    edges = histogram_edges(low, high, bins)
    counts = interval_index(numbers, "value", edges, "bin").groupBy("bin").agg(F.count("*").alias("count"))
    ranges = spark.createDataFrame(
        [(i, edges[i], edges[i + 1]) for i in range(bins)], "bin int, low double, high double"
    )
    # at most one row per bin on either side; missing values fall in no bin
    joined = ranges.join(F.broadcast(counts), "bin", "left")
    return joined.select("bin", "low", "high", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


@dataclass(frozen=True)
class Span:
    """How many values there are, the smallest and the largest."""

    count: int
    low: float | None
    high: float | None

    @property
    def ends(self) -> tuple[float | None, float | None]:
        return self.low, self.high

    def capped(self, most: float | None) -> tuple[float | None, float | None]:
        """The ends of the values once those above ``most`` are cut down to it."""
        return (self.low, self.high) if most is None or self.low is None else (min(self.low, most), min(self.high, most))


def spans(
    df: DataFrame, values: Mapping[str, Column], averaged: Sequence[str] = (),
) -> tuple[dict[str, Span], dict[str, float | None]]:
    """The spans of several values, and the means of some columns, from one aggregate."""
    numbers = {n: number_or_missing(c) for n, c in values.items()}
    parts = [F.struct(F.count(c).alias("count"), F.min(c).alias("low"), F.max(c).alias("high")) for c in numbers.values()]
    means = [F.avg(F.col(f"`{n}`").cast("double")) for n in averaged]
    row = list(df.agg(*[c.alias(f"m{i}") for i, c in enumerate([*parts, *means])]).first())
    return {n: Span(*found) for n, found in zip(numbers, row)}, dict(zip(averaged, row[len(parts):]))


@dataclass(frozen=True)
class Cells:
    """Counts of all cells of several charts: a written table of (chart, cell) with counts, hits and extremes."""

    table: DataFrame
    label: str
    edges: Mapping[str, Sequence[float]]
    kinds: Mapping[str, str]
    quartiles: Mapping[str, Found]

    def chart(self, name: str) -> DataFrame:
        return self.table.where(F.col("chart") == name)

    def class_counts(self) -> dict[bool, int]:
        rows = self.chart("class").select(F.col("cell").try_cast("boolean").alias("label"), "rows").collect()
        counts = {False: 0, True: 0}
        for row in rows:
            counts[bool(row["label"])] += row["rows"]
        return counts

    def target_distribution(self) -> DataFrame:
        counts = self.chart("class").select(F.col("cell").try_cast("boolean").alias(self.label), F.col("rows").alias("count"))
        total = Window.partitionBy()  # over at most three rows
        return counts.withColumn("percent", F.col("count") * 100.0 / F.sum("count").over(total).cast("double"))

    def histogram(self, name: str) -> DataFrame:
        edges = self.edges.get(name, [])
        ranges = self.table.sparkSession.createDataFrame(
            [(i, low, high) for i, (low, high) in enumerate(zip(edges, edges[1:]))], "bin int, low double, high double"
        )
        counts = self.chart(name).select(F.col("cell").cast("int").alias("bin"), F.col("rows").alias("count"))
        # at most one row per bin on either side
        joined = ranges.join(F.broadcast(counts), "bin", "left")
        return joined.select("bin", "low", "high", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))

    def rates(self, name: str) -> DataFrame:
        return self.chart(name).select(F.col("cell").cast(self.kinds[name]).alias(name), "fraud_rate")

    def category_summary(self, name: str) -> DataFrame:
        return self.chart(name).select(
            F.col("cell").alias(name), F.col("labelled").alias("transaction_count"), F.col("hits").cast("bigint").alias("fraud_count"),
            F.round(F.col("fraud_rate") * 100, 4).alias("fraud_rate_percent"),
        ).orderBy(F.desc("fraud_rate_percent"), name)

    def of_class(self, found: Found, place: int) -> Column:
        lit = {c: F.lit(q[place]).cast("double") for c, q in found.items()}
        return F.when(F.col(self.label), lit["True"]).otherwise(lit["False"])

    def boxplot(self, name: str) -> DataFrame:
        classes = self.chart(name).withColumn(self.label, F.col("cell").try_cast("boolean"))
        return classes.select(
            self.label, F.col("values").alias("count"), F.col("low").alias("whisker_low"), F.col("high").alias("whisker_high"),
            F.col("outside").alias("outliers"), *[self.of_class(self.quartiles[name], i).alias(q) for i, q in enumerate(("q25", "q50", "q75"))],
        )

    def amount_summary(self, name: str, found: Found) -> DataFrame:
        """``found`` holds the median and three upper quantiles of each class."""
        classes = self.chart(name).withColumn(self.label, F.col("cell").try_cast("boolean"))
        quantiles = [self.of_class(found, i).alias(n) for i, n in enumerate(("median", "q90", "q95", "q99"))]
        rounded = classes.select(self.label, F.col("values").alias("count"), "mean", *quantiles, F.col("high").alias("max"))
        return rounded.select(
            F.initcap(F.col(self.label).cast("string")).alias(self.label), "count",
            *[F.round(n, 2).alias(n) for n in ("mean", "median", "q90", "q95", "q99", "max")],
        )


def count_cells(
    df: DataFrame, label: str, charts: Mapping[str, tuple[Column, int, tuple[float | None, float | None]]],
    groups: Mapping[str, Column], boxes: Mapping[str, tuple[Column, Found]], measured: Mapping[str, Column],
) -> Cells:
    """Histograms (value, bins, ends), rates by group, box plots of values whose quartiles are known, and values
    measured by class, all from one scan: every row adds to one cell of each chart, with map-side combining.
    """
    flag = F.col(f"`{label}`")
    edges = {n: histogram_edges(*ends, bins) for n, (_, bins, ends) in charts.items() if ends[0] is not None}
    kinds = dict(df.select(*[c.alias(n) for n, c in groups.items()]).dtypes)
    flat = df.select(
        flag.alias("flag"),
        *[number_or_missing(charts[n][0]).alias(f"{n}_value") for n in edges],
        *[c.cast("string").alias(f"{n}_group") for n, c in groups.items()],
        *[number_or_missing(c).alias(f"{n}_box") for n, (c, _) in boxes.items()],
        *[number_or_missing(c).alias(f"{n}_measured") for n, c in measured.items()],
    )
    for name, own in edges.items():
        flat = interval_index(flat, f"{name}_value", own, f"{name}_bin")

    def cell(chart: str, key: Column, hit: Column | None = None, value: Column | None = None, inside: Column | None = None):
        return F.struct(
            F.lit(chart).alias("chart"), key.cast("string").alias("cell"),
            (F.lit(None) if hit is None else hit).cast("double").alias("hit"),
            (F.lit(None) if value is None else value).cast("double").alias("value"),
            (F.lit(None) if inside is None else inside).cast("boolean").alias("inside"),
        )

    items = [cell("class", F.coalesce(F.col("flag").cast("string"), F.lit("none")))]
    items += [cell(n, F.col(f"{n}_bin")) for n in edges]
    items += [cell(n, F.col(f"{n}_group"), hit=F.col("flag")) for n in groups]
    for name, (_, found) in boxes.items():
        low, high = (
            {c: F.lit(None if q[0] is None else end(*q)).cast("double") for c, q in found.items()}
            for end in (lambda a, _, c: a - 1.5 * (c - a), lambda a, _, c: c + 1.5 * (c - a))
        )
        value = F.col(f"{name}_box")
        within = value.between(*[F.when(F.col("flag"), end["True"]).otherwise(end["False"]) for end in (low, high)])
        items.append(cell(name, F.coalesce(F.col("flag").cast("string"), F.lit("none")), value=value, inside=within))
    everywhere = F.lit(True)
    items += [
        cell(n, F.coalesce(F.col("flag").cast("string"), F.lit("none")), value=F.col(f"{n}_measured"), inside=everywhere)
        for n in measured
    ]
    seen = F.when(F.col("inside"), F.col("value"))
    table = materialise(
        # a row has no cell in a chart whose value it lacks
        flat.select(F.inline(F.array(*items))).where(F.col("cell").isNotNull()).groupBy("chart", "cell").agg(
            F.count(F.lit(1)).alias("rows"), F.count("hit").alias("labelled"), F.sum("hit").alias("hits"),
            F.avg("hit").alias("fraud_rate"), F.count("value").alias("values"), F.avg("value").alias("mean"),
            F.min(seen).alias("low"), F.max(seen).alias("high"), F.count_if(~F.col("inside")).cast("bigint").alias("outside"),
        )
    )
    return Cells(table, label, edges, kinds, {n: found for n, (_, found) in boxes.items()})


def boxplot(df: DataFrame, value: Column | str, label: str = TARGET, found: Found | None = None) -> DataFrame:
    """Quartiles, whiskers (last points within 1.5 interquartile ranges) and outliers per class.

    ``found`` holds the quartiles of each class if they are known already.
    """
    source = F.col(value) if isinstance(value, str) else value
    numbers = df.select(F.col(label), number_or_missing(source).alias("value"))
    if found is None:
        found = exact_quantiles(numbers, class_columns(F.col("value"), (False, True), label), [0.25, 0.5, 0.75])

    def of_class(pick) -> Column:
        lit = {c: F.lit(None if q[0] is None else pick(*q)).cast("double") for c, q in found.items()}
        return F.when(F.col(label), lit["True"]).otherwise(lit["False"])

    low, high = of_class(lambda a, _, c: a - 1.5 * (c - a)), of_class(lambda a, _, c: c + 1.5 * (c - a))
    inside = F.col("value").between(low, high)
    grouped = numbers.groupBy(label).agg(
        F.count("value").alias("count"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).cast("bigint").alias("outliers"),
    )
    quartiles = {"q25": lambda a, b, c: a, "q50": lambda a, b, c: b, "q75": lambda a, b, c: c}
    return grouped.select("*", *[of_class(pick).alias(n) for n, pick in quartiles.items()])


def class_distribution(parts: dict[str, DataFrame], label: str = TARGET) -> DataFrame:
    """Count and percent per split and class."""
    counts = None
    for name, df in parts.items():
        part = df.groupBy(label).agg(F.count("*").alias("count")).withColumn("split", F.lit(name))
        counts = part if counts is None else counts.unionByName(part)
    total = F.sum("count").over(Window.partitionBy("split"))  # over the classes of one split
    percent = F.round(F.col("count") * 100.0 / total.cast("double"), 4)
    return counts.select("split", F.initcap(F.col(label).cast("string")).alias(label), "count", percent.alias("percent"))


def class_distribution_pivot(distribution: DataFrame, label: str = TARGET) -> DataFrame:
    pivoted = distribution.groupBy("split").pivot(label, ["False", "True"]).agg(F.first("percent"))
    return pivoted.select("split", F.col("False").alias("percent_false"), F.col("True").alias("percent_true"))


def log_amount(amount: str = "amt") -> Column:
    return F.log1p(F.col(amount))
