"""Registered queries against their SQL, over the test tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__
from catalog.compare import database, difference
from catalog.oracles import all_oracles
from catalog.queries import all_queries
from clicklens.operators.skew import LARGE_GROUP_CONF

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, con, name):
    assert difference(name, spark, con, SF_DIR) is None


@pytest.mark.parametrize(
    "name",
    [
        "span_join",
        "span_join_overlapping",
        "trace_visits_day_ties",
        "mark_exits",
        "product_table",
        "factor_breadth",
        "dashboard_long",
        "browser_metrics",
        "explore_all",
    ],
)
def test_query_when_most_browsers_are_hot(spark, con, name):
    spark.conf.set(LARGE_GROUP_CONF, "10")
    try:
        assert difference(name, spark, con, SF_DIR) is None
    finally:
        spark.conf.unset(LARGE_GROUP_CONF)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 3
