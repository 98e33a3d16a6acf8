"""All registered queries."""

from __future__ import annotations

from ledgerlight.queries import columns, evaluation, models, profiling, sampling  # noqa: F401
from ledgerlight.queries.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
