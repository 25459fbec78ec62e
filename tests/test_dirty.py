"""The dirty view holds every defect it is for, so that the rules of money
rounding, exact prices, descriptions and nulls decide its results."""
from __future__ import annotations

import pytest

from conftest import SF_SMALL
from tillroll.plans import oracle
from tillroll.sources.testtables import dirty_lines
from test_oracle import check_oracle


@pytest.fixture(scope="module")
def duck():
    return check_oracle.duck_connect(SF_SMALL)


def test_view_equals_its_sql(spark, duck):
    assert check_oracle.compare(dirty_lines(spark, SF_SMALL), duck, oracle.with_ctes(oracle.CTE_DIRTY, "SELECT * FROM raw")) == []


@pytest.mark.parametrize("condition", [
    "Invoice IS NULL", "StockCode IS NULL", "StockCode = 'adjust'", "StockCode = '47'", "InvoiceDate IS NULL",
    "Quantity IS NULL", "Quantity = 0", "Price < 0", "Price = 0.001", "Price <> round(Price, 2)",
    "trim(Description) = '' AND Description <> ''", "contains(Description, '\"')", "Description IS NULL",
])
def test_every_defect_occurs(duck, condition):
    sql = oracle.with_ctes(oracle.CTE_DIRTY, f"SELECT count(*) FROM raw WHERE {condition}")
    assert duck.execute(sql).fetchone()[0] > 0


@pytest.mark.parametrize(("rule", "broken"), [
    ("CAST(round(GrossSales, 2) AS DECIMAL(18,2))", "CAST(trunc(GrossSales * 100) / 100 AS DECIMAL(18,2))"),
    ("min(nullif(Description, ''))", "min(Description)"),
    ("AS DECIMAL(14,4)) AS Price,\n           \"Customer", "AS DECIMAL(14,2)) AS Price,\n           \"Customer"),
])
def test_a_broken_rule_changes_the_product_mart(duck, rule, broken):
    sql = oracle.over_dirty_lines(oracle.with_ctes(oracle.CTE_PRODUCT, "SELECT * FROM product ORDER BY ALL"))
    assert rule in sql
    assert duck.execute(sql).fetchall() != duck.execute(sql.replace(rule, broken)).fetchall()
