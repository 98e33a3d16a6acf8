"""Counts that a write brings along, so that no scan is needed for them afterwards."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlight.functions.values import flag_column

Out = TypeVar("Out")


@dataclass(frozen=True)
class ClassCounts:
    rows: int
    positives: int
    negatives: int

    def by_class(self) -> dict[bool, int]:
        return {True: self.positives, False: self.negatives}


def counted(df: DataFrame, write: Callable[[DataFrame], Out], label: str | None = None) -> tuple[Out, ClassCounts]:
    """What ``write`` makes of df, and the rows of each class it has written.

    The counts are taken by the tasks that write, the last of the job: a task that is run again counts once.
    """
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if label is not None:
        flag = flag_column(df, label)
        measures += [F.count_if(flag).alias("positives"), F.count_if(~flag).alias("negatives")]
    out = write(df.observe(seen, *measures))
    found = seen.get
    return out, ClassCounts(*(int(found.get(n) or 0) for n in ("rows", "positives", "negatives")))
