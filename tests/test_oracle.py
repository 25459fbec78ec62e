"""Every registered query against its SQL oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""
from __future__ import annotations

import importlib.util
import os

import pytest

from conftest import SF_SMALL

_spec = importlib.util.spec_from_file_location(
    "check_oracle", os.path.join(os.path.dirname(__file__), "..", "scripts", "check_oracle.py")
)
check_oracle = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check_oracle)

import __spark_entry__ as entry  # noqa: E402
from tillroll.plans import catalog  # noqa: E402

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return check_oracle.duck_connect(SF_SMALL)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert check_oracle.compare(df, duck, SQL[name]) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "CountryRank" in df.columns
