"""Every registered query against its SQL, and the driver contract.

``ORACLE_SF_DIR`` chooses the tables (default: the smallest).
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from lakeloom.checks import REGISTRY
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_its_sql(spark, db, name):
    assert compare(spark, db, REGISTRY[name], FOLDER) is None


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(REGISTRY) - set(contract.oracle_sql()) == {"outcome_model"}


@pytest.mark.parametrize(("name", "order"), [
    ("monthly_revenue", "year, month, rating"),
    ("monthly_revenue_by_category", "year, month, category"),
    ("product_sales", "total_revenue desc, product"),
    ("category_sales", "total_revenue desc, category"),
    ("common_value_by_group", "group_start"),
])
def test_sorted_results_are_in_order(spark, db, name, order):
    check = REGISTRY[name]
    df = check.run(spark, FOLDER)
    want = db.sql(f"select * from ({check.sql}) order by {order}")
    at = [want.columns.index(c) for c in df.columns]
    keys = [c.split()[0] for c in order.split(", ")]
    got = [tuple(r[k] for k in keys) for r in df.collect()]
    rows = [tuple(r[i] for i in at) for r in want.fetchall()]
    assert got == [tuple(r[df.columns.index(k)] for k in keys) for r in rows]
