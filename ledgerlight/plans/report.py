"""Profiles and exploratory tables of a whole transaction table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.features import distance_bucket
from ledgerlight.functions.values import cap
from ledgerlight.operators import correlate, explore, profile, sampling
from ledgerlight.operators.lookups import complete_calendar
from ledgerlight.operators.quantiles import exact_quantiles
from ledgerlight.schema import (
    CAP_QUANTILE, CORRELATED, DISTANCE, DISTANCE_HISTOGRAM_BINS, HISTOGRAM_BINS, KEY, TARGET, WEEKDAY_LABELS,
)
from ledgerlight.session import materialise


def profile_tables(df: DataFrame, label: str = TARGET, key: str = KEY) -> dict[str, DataFrame]:
    """Everything known about the raw table, one DataFrame per report.

    One aggregate gives rows, gaps, moments, classes and correlations; quartiles, value counts, row hashes and the head
    take one scan each, quartiles of a large table some more. Values are counted once and the counts written down, as
    several reports read them.
    """
    # classes are counted along where the target is a flag, otherwise by a grouping of their own
    known = label if dict(df.dtypes).get(label) == "boolean" else None
    measures = profile.measure(df, known)
    counts = materialise(profile.value_counts(df, profile.countable_columns(df)))
    numeric = profile.describe_numeric(df, measures=measures)
    tables = {
        "general_information": profile.shape(df, measures),
        "columns": profile.column_list(df),
        "data_types": profile.kind_counts(df),
        "head": profile.preview(df, key, 5),
        "describe": profile.describe_all(df, numeric, counts),
        "missing_values": profile.missing_values(df, measures),
        "duplicate_rows": profile.duplicate_rows(df),
        "numeric_summary": numeric,
        "cardinality": profile.cardinality(df, counts=counts),
        "top_values": profile.top_values(df, counts=counts),
    }
    if label in df.columns:
        own = measures if known else None
        tables["target_distribution"] = profile.target_distribution(df, label, own)
        tables["target_correlation"] = correlate.with_target(df, label, measures=own)
    return tables


def correlated_columns(df: DataFrame) -> list[str]:
    named = [n for n in CORRELATED if n in df.columns]
    return named + profile.columns_with_prefix(df, "category_")


def explore_tables(df: DataFrame, label: str = TARGET, key: str = KEY) -> dict[str, DataFrame]:
    """The data of every exploratory chart, from a transformed table, which should be a written one.

    One aggregate finds ranges, means and how many values there are; one scan (more for a large table) the quantiles;
    one scan counts all cells of all histograms, rates, box plots and classes; one sums the correlations.
    """
    named = explore.with_category(df)
    amount, km = explore.log_amount(), F.col(DISTANCE)
    classes = (False, True)
    by_class = {"amt": F.col("amt"), "log": amount, "km": km}
    split = {
        f"{n}_{c}": part for n, value in by_class.items() for c, part in explore.class_columns(value, classes, label).items()
    }
    wanted = {"amt": F.col("amt"), "km": km, **split}
    correlated = correlated_columns(df)
    spans, means = explore.spans(df, {**wanted, "log": amount}, correlated)
    probabilities = [0.25, 0.5, 0.75, 0.9, 0.95, 0.99, CAP_QUANTILE]
    found = exact_quantiles(df, wanted, probabilities, present={n: spans[n].count for n in wanted})
    quartiles = {n: {str(c): found[f"{n}_{c}"][:3] for c in classes} for n in by_class}
    upper = {str(c): [found[f"amt_{c}"][i] for i in (1, 3, 4, 5)] for c in classes}
    most_amount, most_km = found["amt"][-1], found["km"][-1]
    charted = {
        "amount_histogram": (cap("amt", most_amount), HISTOGRAM_BINS, spans["amt"].capped(most_amount)),
        "log_amount_histogram": (amount, HISTOGRAM_BINS, spans["log"].ends),
        "distance_histogram": (cap(DISTANCE, most_km), HISTOGRAM_BINS, spans["km"].capped(most_km)),
        "distance_histogram_full": (km, DISTANCE_HISTOGRAM_BINS, spans["km"].ends),
    }
    cells = explore.count_cells(
        named, label, charted,
        {
            "category": F.col("category"), "transaction_hour": F.col("transaction_hour"),
            "transaction_day_of_week": F.col("transaction_day_of_week"), "is_night": F.col("is_night"),
            "distance_bucket": distance_bucket(DISTANCE),
        },
        {"log": (amount, quartiles["log"]), "km": (km, quartiles["km"])}, {"amt": F.col("amt")},
    )
    by_category = cells.category_summary("category")
    weekdays = cells.rates("transaction_day_of_week")
    return {
        "target_distribution": cells.target_distribution(),
        **{name: cells.histogram(name) for name in charted},
        "amount_boxplot": cells.boxplot("log"),
        "amount_summary": cells.amount_summary("amt", upper),
        "category_rates": by_category,
        "category_counts": by_category.orderBy(F.desc("transaction_count"), "category"),
        "distance_boxplot": cells.boxplot("km"),
        "distance_rates": cells.rates("distance_bucket"),
        "amount_and_distance": scatter_points(df, label, key, counts=cells.class_counts()),
        "hour_rates": cells.rates("transaction_hour"),
        "weekday_rates": complete_calendar(weekdays, "transaction_day_of_week", "fraud_rate", WEEKDAY_LABELS),
        "night_rates": cells.rates("is_night"),
        "correlation": correlate.matrix(df, correlated, means),
    }


def scatter_points(
    df: DataFrame, label: str = TARGET, key: str = KEY, negatives: int | None = None,
    counts: Mapping[bool, int] | None = None,
) -> DataFrame:
    limit = {} if negatives is None else {"negatives": negatives}
    chosen = sampling.scatter(df, label, key, **limit, counts=counts)
    return chosen.select(key, label, DISTANCE, F.log1p("amt").alias("log_amount"))
