"""Equi-joins against lookup tables, safe against growth of the lookup and against hot keys."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.values import missing_as_word

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 0.01
SALTS = 64


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``lookup`` (one row per key) to ``facts``.

    A lookup whose counted rows and estimated bytes are small is broadcast. A larger one is joined by shuffle: keys that
    hold more than one row in a hundred (at most a hundred of them) are spread over several tasks,
    their lookup rows repeated once per salt; all other keys have one salt. The salt follows from the
    row itself, so a recomputed task sends each row the same way. Spark would still broadcast a lookup whose compressed
    columns are few bytes, or whose rows are not yet repeated, so the shuffle is asked for.
    """
    rows, size = lookup.limit(broadcast_rows + 1).agg(F.count("*"), F.sum(row_bytes(lookup))).first()
    if rows <= broadcast_rows and (size or 0) <= BROADCAST_BYTES:
        return facts.join(F.broadcast(lookup), key, how)

    hot = hot_keys(facts, key)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    zero = F.lit(0).cast("bigint")
    # rows without a key match nothing, wherever they go, but a left join keeps them all
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.lit(salts).cast("bigint"))
    salted_facts = facts.withColumn("_salt", F.when(F.col(key).isNull() | is_hot, spread).otherwise(zero))
    every = F.sequence(zero, F.lit(salts - 1).cast("bigint"))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(zero))))
    return salted_facts.hint("merge").join(salted_lookup.hint("merge"), [key, "_salt"], how).drop("_salt")


def row_bytes(df: DataFrame) -> Column:
    """What a row takes in memory, roughly: eight bytes a column, and the length of its texts and nested values."""
    long = [n for n, kind in df.dtypes if kind in ("string", "binary") or "<" in kind]
    texts = [F.coalesce(F.octet_length(F.col(f"`{n}`").cast("string")), F.lit(0)) for n in long]
    return reduce(add, texts, F.lit(16 + 8 * len(df.columns)).cast("bigint"))


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than the given share of the rows: never more than 1 / share of them."""
    counts = df.groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    return [r[0] for r in counts.where(F.col("count") > total * share).collect() if r[0] is not None]


def frequency_map(df: DataFrame, column: str) -> DataFrame:
    """Share of the rows per value, null counted under its own word: (value, frequency)."""
    return shares(value_counts_of(df, column))


def value_counts_of(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(missing_as_word(column).alias("value")).agg(F.count("*").alias("count"))


def merge_counts(*counts: DataFrame) -> DataFrame:
    """Add count maps of several batches; a value absent from one counts 0 there."""
    merged = counts[0]
    for other in counts[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy("value").agg(F.sum("count").alias("count"))


def shares(counts: DataFrame) -> DataFrame:
    """(value, count) to (value, frequency). The total is one number, put into the plan as a literal."""
    total = counts.agg(F.sum("count")).first()[0] or 0
    return counts.select("value", (F.col("count") / F.lit(float(total or 1))).alias("frequency"))


def frequency_encode(df: DataFrame, maps: dict[str, DataFrame], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Replace each column by its value's share in the map; unseen values get 0."""
    for column, mapped in maps.items():
        # hot values of the fact side are salted once the map is too large to broadcast
        keyed = df.withColumn("value", missing_as_word(column)).drop(column)
        joined = lookup_join(keyed, mapped, "value", "left", broadcast_rows)
        named = joined.withColumn(f"{column}_frequency", F.coalesce("frequency", F.lit(0.0)))
        df = named.drop("value", "frequency")
    return df


def require_key(df: DataFrame, key: str) -> None:
    """Raise unless every row has a key and no two rows share one."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    null, repeated = F.col(key).isNull(), F.col(key).isNotNull() & (F.col("n") > 1)
    row = counts.agg(F.sum(F.when(null, F.col("n"))).alias("null"), F.count_if(repeated).alias("repeated")).first()
    if row["null"] or row["repeated"]:
        raise ValueError(f"{key} is no row key: {row['null'] or 0} rows without one, {row['repeated']} repeated keys")


def alignment(left: DataFrame, right: DataFrame, key: str, label: str) -> DataFrame:
    """Rows on either side, rows without a partner, repeated keys, and keys whose labels differ, as one row."""
    def side(df: DataFrame, name: str) -> DataFrame:
        value = F.col(label)
        return df.groupBy(key).agg(
            F.count("*").alias(f"_{name}"), F.count_if(value).alias(f"_{name}_true"), F.count_if(~value).alias(f"_{name}_false"),
        )

    both = side(left, "l").join(side(right, "r"), key, "full_outer")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    paired = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    alike = (F.col("_l_true") == F.col("_r_true")) & (F.col("_l_false") == F.col("_r_false"))
    return both.agg(
        total("_l").alias("left_rows"),
        total("_r").alias("right_rows"),
        total(F.when(F.col("_r").isNull(), F.col("_l"))).alias("left_only"),
        total(F.when(F.col("_l").isNull(), F.col("_r"))).alias("right_only"),
        F.count_if((F.col("_l") > 1) | (F.col("_r") > 1)).cast("bigint").alias("repeated_keys"),
        F.count_if(paired & ~alike).cast("bigint").alias("label_mismatches"),
    )


def require_alignment(left: DataFrame, right: DataFrame, key: str, label: str) -> None:
    row = alignment(left, right, key, label).first()
    faults = ("left_only", "right_only", "repeated_keys", "label_mismatches")
    if row["left_rows"] != row["right_rows"] or any(row[n] for n in faults):
        raise ValueError(f"tables do not line up: {row.asDict()}")


def attach_amount(scored: DataFrame, source: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Bring the unscaled amount to each scored row by key. Both sides grow, so this is a shuffle join."""
    return scored.join(source.select(key, F.col(amount).alias(name)), key)


def complete_calendar(rates: DataFrame, day: str, rate: str, labels: tuple[str, ...]) -> DataFrame:
    """All seven weekdays in order, 0 where a day does not occur."""
    spark = rates.sparkSession
    days = spark.createDataFrame(list(enumerate(labels)), f"{day} int, weekday string")
    # rates holds at most one row per weekday
    joined = days.join(F.broadcast(rates.select(F.col(day).cast("int"), rate)), day, "left")
    return joined.select(day, "weekday", F.coalesce(rate, F.lit(0.0)).alias(rate))
