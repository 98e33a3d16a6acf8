"""The first rows of an order, found by counting: no sort, no shuffle and no written copy of the table.

The row at which the order is cut is narrowed down column by column. A pass counts the rows of each piece of the
column's range, piece by piece in order, so one of them is known to hold the cut; the next pass looks inside it. Numbers,
dates and times are cut into ranges of equal width, floating-point numbers at sketched quantiles, texts by the
characters that follow the common beginning. Once few rows are left, they alone are sorted. What is before
the cut is a filter with literals.
"""

from __future__ import annotations

import math
import os.path
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.operators.ordered import running_totals
from ledgerlight.operators.quantiles import interval_index

ONE_TASK_ROWS = 100_000
PIECES = 1024
SKETCHED = 200
LOOK_AHEAD = 64
SKETCH_ACCURACY = 10_000


@dataclass
class _Search:
    """Rows that are surely taken, and those among which the cut lies, ``left`` of whose ``size`` are wanted."""

    before: list[Column]
    among: Column
    left: int
    size: int

    def enter(self, smaller: Column | None, here: Column, skipped: int, size: int) -> None:
        """Go into one piece: rows of smaller ones are taken."""
        if smaller is not None:
            self.before.append(self.among & smaller)
        self.among, self.left, self.size = self.among & here, self.left - skipped, size


@dataclass(frozen=True)
class _Ends:
    """The smallest and the largest value; of texts only so many characters as ``shown`` says."""

    low: object
    high: object
    shown: int | None = None

    def single(self) -> bool:
        return self.low == self.high and (self.shown is None or len(self.low) < self.shown)


@dataclass(frozen=True)
class _Piece:
    """A run of a column's values: its rows, and what makes the conditions that a row lies in it, or in an earlier one
    (None if there is none). Only the piece that is chosen needs them.
    """

    rows: int
    conditions: Callable[[], tuple[Column, Column | None]]
    ends: _Ends | None = None


def first_rows(df: DataFrame, order: Sequence[str], rows: int, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """The first ``rows`` rows by the given columns, ascending, nulls first; of rows equal in all of them any are taken.

    Up to ``one_task_rows`` are sorted as they are, which brings that many to one task. Beyond that the number of
    passes grows with the logarithm of the table. Only a column of nested type, reached because very many rows
    agree in all columns before, is ranked by a sort, and only for those rows.
    """
    keys = [F.col(f"`{n}`") for n in order]
    if rows <= one_task_rows:
        return df.orderBy(*keys).limit(rows)
    total = df.count()
    if rows >= total:
        return df
    search = _Search([], F.lit(True), rows, total)
    pinned = True
    for name in order:
        if search.size <= one_task_rows or not pinned:
            break
        pinned = _narrow(df, name, search, one_task_rows)
    residue = df.where(search.among)
    if search.size <= one_task_rows:
        rest = residue.orderBy(*keys).limit(search.left)
    elif not pinned:
        ranked = running_totals(residue, keys, {"_place": F.lit(1)}, search.size)
        rest = ranked.where(F.col("_place") <= search.left).drop("_place")
    elif len(order) == len(df.columns):
        # all of them are the same row
        rest = residue.limit(1).crossJoin(df.sparkSession.range(search.left).select()).select(*df.columns)
    else:
        rest = residue.limit(search.left)
    if not search.before:
        return rest
    return df.where(reduce(or_, search.before)).unionByName(rest)


def _narrow(df: DataFrame, name: str, search: _Search, enough: int) -> bool:
    """Narrow the search by one column, until few rows are left or one value is; False if the column has no way."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    shown, odd = None, F.lit(False)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        value, look, shown = column if isinstance(kind, T.StringType) else F.hex(column), _text_pieces, LOOK_AHEAD
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value, look, odd = column.cast("double"), _sketched_pieces, F.isnan(column)
    else:
        value, look = _whole_number(column, kind), _even_pieces
    if value is None:
        return False
    # nulls come first, what is no number comes last; each are all alike
    missing, plain = value.isNull(), value.isNotNull() & ~odd
    own = F.when(plain, value if shown is None else F.substring(value, 1, shown))
    counted = df.where(search.among).agg(*[F.count_if(c) for c in (missing, plain, odd)], F.min(own), F.max(own)).first()
    pieces = [
        _Piece(counted[0], lambda: (missing, None)),
        _Piece(counted[1], lambda: (plain, missing), _Ends(counted[3], counted[4], shown)),
        _Piece(counted[2], lambda: (odd, ~odd)),
    ]
    chosen = _choose(pieces, search)
    while chosen.ends is not None and search.size > enough and not chosen.ends.single():
        chosen = _choose(look(df.where(search.among), value, chosen.ends), search)
    return True


def _choose(pieces: Sequence[_Piece], search: _Search) -> _Piece:
    skipped = 0
    for piece in pieces:
        if skipped < search.left <= skipped + piece.rows:
            here, smaller = piece.conditions()
            search.enter(smaller, here, skipped, piece.rows)
            return piece
        skipped += piece.rows
    raise RuntimeError("rows changed between two passes over the table")


def _whole_number(column: Column, kind: T.DataType) -> Column | None:
    """The value as a long in the same order, if its type has such a form."""
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return column.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), column)
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (column * F.lit(10 ** kind.scale).cast("decimal(19,0)")).cast("long")
    return None


def _counted(inside: DataFrame, piece: Column, value: Column) -> list:
    """(piece, rows, smallest, largest) for each piece that has rows."""
    grouped = inside.groupBy(piece.alias("piece"))
    return grouped.agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high")).collect()


def _even_pieces(inside: DataFrame, value: Column, ends: _Ends) -> list[_Piece]:
    """Ranges of equal width, a power of two, so that a shift numbers them; it rounds down for negative numbers too."""
    bits = max((int(ends.high) - int(ends.low)).bit_length() - PIECES.bit_length() + 1, 0)
    piece = F.shiftright(value, bits)
    return _by_ends(_counted(inside, piece, value), value)


def _sketched_pieces(inside: DataFrame, value: Column, ends: _Ends) -> list[_Piece]:
    """Ranges between sketched quantiles, which follow the values however unevenly they lie."""
    steps = F.array(*[F.lit(i / SKETCHED) for i in range(SKETCHED + 1)])
    proposed = inside.agg(F.percentile_approx(value, steps, SKETCH_ACCURACY)).first()[0]
    # each proposed value is a piece of its own, so one that fills much of the column is found at once
    edges = sorted({-math.inf, math.inf} | {c for p in proposed for c in (p, math.nextafter(p, math.inf))})
    numbered = interval_index(inside.withColumn("_value", value), "_value", edges, "_piece")
    return _by_ends(_counted(numbered, F.col("_piece"), F.col("_value")), value)


def _by_ends(counted: list, value: Column) -> list[_Piece]:
    ordered = sorted(counted, key=lambda r: r["low"])

    def within(low: object, high: object) -> Callable[[], tuple[Column, Column]]:
        return lambda: (value.between(F.lit(low), F.lit(high)), value < F.lit(low))

    return [_Piece(r["rows"], within(r["low"], r["high"]), _Ends(r["low"], r["high"])) for r in ordered]


def _text_pieces(inside: DataFrame, value: Column, ends: _Ends) -> list[_Piece]:
    """Texts by their common beginning and the character after it."""
    length = len(os.path.commonprefix([ends.low, ends.high])) + 1
    begin, shown = F.substring(value, 1, length), length + LOOK_AHEAD
    counted = _counted(inside, begin, F.substring(value, 1, shown))

    def beginning(text: str) -> Callable[[], tuple[Column, Column]]:
        return lambda: (begin == F.lit(text), begin < F.lit(text))

    ordered = sorted(counted, key=lambda r: r["piece"].encode())
    return [_Piece(r["rows"], beginning(r["piece"]), _Ends(r["low"], r["high"], shown)) for r in ordered]
