"""Time, age, distance and encoding expressions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.schema import (
    CYCLES,
    DAYS_PER_YEAR,
    DISTANCE_EDGES_KM,
    DISTANCE_LABELS,
    EARTH_RADIUS_KM,
    NIGHT_HOURS,
    TIME_COLUMN,
    WEEKEND_DAYS,
)

SECONDS_PER_DAY = 86_400


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """Epoch seconds to timestamp; what is no number becomes null."""
    source = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.timestamp_seconds(source.try_cast("double"))


def date_or_null(text: Column | str) -> Column:
    source = F.col(text) if isinstance(text, str) else text
    return source.try_cast("date")


def with_time_features(df: DataFrame, seconds: str = TIME_COLUMN) -> DataFrame:
    """Hour, weekday (Monday = 0), day of month, month, and the weekend and night flags.

    A row without a time gets null parts and false flags.
    """
    moment = epoch_to_timestamp(seconds)
    hour, weekday = F.hour(moment), F.weekday(moment)
    return df.withColumns(
        {
            "transaction_hour": hour,
            "transaction_day_of_week": weekday,
            "transaction_day_of_month": F.dayofmonth(moment),
            "transaction_month": F.month(moment),
            "is_weekend": F.coalesce(weekday.isin(*WEEKEND_DAYS), F.lit(False)),
            "is_night": F.coalesce(hour.isin(*NIGHT_HOURS), F.lit(False)),
        }
    )


def age_years(seconds: Column | str, born: Column | str) -> Column:
    """Whole elapsed days over the mean year length, rounded half to even; null if either is null."""
    source = F.col(seconds) if isinstance(seconds, str) else seconds
    born_at = F.unix_date(date_or_null(born)) * F.lit(SECONDS_PER_DAY)
    days = F.floor((source.try_cast("double") - born_at) / F.lit(float(SECONDS_PER_DAY)))
    return F.bround(days / F.lit(DAYS_PER_YEAR), 0)


def haversine_km(lat_a: str, long_a: str, lat_b: str, long_b: str) -> Column:
    """Great-circle distance in km on a sphere."""
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    across = F.pow(F.sin((phi_b - phi_a) / 2), 2)
    along = F.pow(F.sin((F.radians(long_b) - F.radians(long_a)) / 2), 2)
    chord = across + F.cos(phi_a) * F.cos(phi_b) * along
    # least and greatest pass over nulls, so missing coordinates are looked at first;
    # each part is written once, as this expression may end up inlined
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), chord))
    known = reduce(and_, [F.col(c).isNotNull() for c in (lat_a, long_a, lat_b, long_b)])
    return F.when(known, F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(bounded)))


def distance_bucket(km: Column | str) -> Column:
    """Label of the right-closed distance range; null or negative distance has none."""
    source = F.col(km) if isinstance(km, str) else km
    label = F.when(source < 0, F.lit(None).cast("string"))
    for edge, name in zip(DISTANCE_EDGES_KM, DISTANCE_LABELS):
        label = label.when(source <= edge, name)
    return label.when(source > DISTANCE_EDGES_KM[-1], DISTANCE_LABELS[-1])


def distance_bucket_order(label: Column | str) -> Column:
    source = F.col(label) if isinstance(label, str) else label
    return F.array_position(F.array(*map(F.lit, DISTANCE_LABELS)), source).cast("int")


def with_cycles(df: DataFrame, periods: Mapping[str, int] = CYCLES) -> DataFrame:
    """Replace each periodic column by its sine and cosine."""
    parts = {}
    for name, period in periods.items():
        angle = F.col(name) * F.lit(2 * math.pi) / F.lit(float(period))
        parts[f"{name}_sin"] = F.sin(angle)
        parts[f"{name}_cos"] = F.cos(angle)
    return df.withColumns(parts).drop(*periods)


def one_hot(df: DataFrame, vocabulary: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by one boolean column per value; null sets none of them."""
    flags = {
        f"{name}_{value}": F.coalesce(F.col(name) == F.lit(value), F.lit(False))
        for name, values in vocabulary.items()
        for value in values
    }
    return df.withColumns(flags).drop(*vocabulary)


def one_hot_label(columns: Sequence[str], prefix: str) -> Column:
    """First set column's name without the prefix; a row with none set gets the first column's."""
    label = F.when(F.col(f"`{columns[0]}`"), columns[0].removeprefix(prefix))
    for name in columns[1:]:
        label = label.when(F.col(f"`{name}`"), name.removeprefix(prefix))
    return label.otherwise(columns[0].removeprefix(prefix))
