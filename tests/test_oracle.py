"""Registered queries against their SQL twins, on the smallest tables.

Fits need more rows than that: test_models.py covers them, and tools/check.py runs everything.
"""

import pytest

import __spark_entry__ as entry
from check import compare, database
from ledgerlight.queries import models


@pytest.fixture(scope="module")
def con(folder):
    return database(folder)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["distance_bucket", "fraud_rate"] and result.count() > 1


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def checked():
    fits = {f.__name__ for f in vars(models).values() if getattr(f, "__module__", "") == models.__name__}
    fits |= {"fit_final", "tuning_report"}
    return [n for n in entry.oracle_sql() if n not in fits]


@pytest.mark.parametrize("name", checked())
def test_query(spark, con, folder, name):
    good, text = compare(spark, con, name, folder)
    assert good, text
