"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from shelfcount_checks import catalog
from shelfcount_checks.compare import connect, difference

from .conftest import SMALL

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    assert name in ORACLES
    assert difference(df, duck, ORACLES[name]) is None


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"stcode", "cntdate", "skutype", "acc", "vnet_to_sale", "running"} <= set(df.columns)


# What each ordered query is ordered by: column and whether it descends.
ORDERED = {
    "ranked_output": [("overall", True), ("sku", False)],
    "sku_ranking": [("overall", True), ("sku", False)],
    "report_order": [("dept", False), ("sku", False), ("sdept", False)],
    "variance_listing": [("dept", False), ("sku", False), ("location", False)],
    "location_history": [("seq", True)],
    "preview": [("cntdate", True), ("plan_id", True)],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, name):
    rows = [r.asDict() for r in QUERIES[name](spark, SMALL).collect()]
    want = rows
    for column, down in reversed(ORDERED[name]):
        want = sorted(want, key=lambda r: r[column], reverse=down)
    assert rows and rows == want
