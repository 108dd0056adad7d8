from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clicklens.operators import dwell, sessions
from tests.brute import random_log, trace

SCHEMA = "v1 bigint, browser string, ts bigint, first_page int"


@pytest.mark.parametrize("ticks", [5, 400])
def test_trace_visits_follows_the_rules(spark, groups, ticks):
    log = random_log(ticks, 300, ticks)
    got = sessions.trace_visits(spark.createDataFrame(log, SCHEMA)).collect()
    traced = {r.v1: (r.first_page, r.session, r.exit_page, r.time) for r in got}
    assert len(got) == len(log)
    assert traced == trace(log)


def test_single_operators_agree_with_the_fused_one(spark, groups):
    log = spark.createDataFrame(random_log(1, 250, 60), SCHEMA)
    fused = sessions.trace_visits(log)
    assigned = spark.createDataFrame(
        sessions.assign_sessions(log).collect(),
        "v1 bigint, browser string, ts bigint, first_page int, session int",
    )
    exits = {r.v1: r.exit_page for r in sessions.mark_exits(assigned).collect()}
    times = {r.v1: r.time for r in dwell.dwell_time(assigned).collect()}
    for row in fused.collect():
        assert exits[row.v1] == row.exit_page
        assert times[row.v1] == row.time


def test_page_position_orders_ties_by_id_and_missing_times_last(spark, groups):
    rows = [(5, "b", 1, 20), (4, "b", 1, 20), (3, "b", 1, None), (2, "b", 1, 10), (9, None, 1, 5)]
    rows += [(100 + i, "b", 1, 30) for i in range(6)]
    df = spark.createDataFrame(rows, "v1 bigint, browser string, session int, ts bigint")
    got = {r.v1: r.row_number for r in dwell.page_position(df).collect()}
    expected = {2: 1, 4: 2, 5: 3, 3: 10, 9: 1} | {100 + i: 4 + i for i in range(6)}
    assert got == expected


def test_number_entries_in_both_orders(spark, groups):
    rows = [
        (1, "b", 30, 1, False),
        (2, "b", 10, 1, True),
        (3, "b", 20, 1, False),
        (4, "b", 20, None, False),
        (7, "b", 20, 1, False),
        (8, "c", None, 1, False),
    ]
    df = spark.createDataFrame(rows, SCHEMA + ", is_shifted boolean")
    by_time = {r.v1: r.session for r in sessions.number_entries(df).collect()}
    assert by_time == {2: 1, 3: 2, 7: 3, 1: 4, 8: 1}
    by_input = {r.v1: r.session for r in sessions.number_entries(df, "input").collect()}
    assert by_input == {1: 1, 3: 2, 7: 3, 2: 4, 8: 1}


def test_order_of_entries_must_be_known(spark):
    df = spark.createDataFrame([(1, "b", 1, 1)], SCHEMA)
    with pytest.raises(ValueError):
        sessions.number_entries(df, "random")


@pytest.mark.parametrize("order", ["time", "input"])
def test_range_join_equals_comparing_every_pair(spark, groups, order):
    """In input order spans overlap, so a page may be in several sessions."""
    log = [r for r in random_log(8, 260, 90) if r[3] is None or r[2] is not None]
    df = spark.createDataFrame(
        [(*r, r[0] % 7 == 0) for r in log], SCHEMA + ", is_shifted boolean"
    )
    numbered = sessions.number_entries(df, order)
    spans = sessions.session_spans(numbered).unionByName(
        sessions.last_entries(numbered), allowMissingColumns=True
    )
    span_rows = spans.collect()
    got = sessions.assign_by_span(df.select("v1", "browser", "ts"), spans).collect()
    expected = sorted(
        (v1, s.session)
        for v1, browser, ts, _ in log
        for s in span_rows
        if browser is not None and browser == s.browser and ts is not None
        and s.ts <= ts and (s.end_ts is None or ts < s.end_ts)
    )
    assert sorted((r.v1, r.session) for r in got) == expected


def test_a_page_before_the_only_entry_is_in_its_session(spark, groups):
    rows = [(1, "b", 10, None), (2, "b", 20, 1), (3, "b", 30, None)]
    got = sessions.assign_sessions(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.v1: r.session for r in got} == {1: 1, 2: 1, 3: 1}


def test_a_page_before_the_first_of_two_entries_is_carried_over(spark, groups):
    rows = [(1, "b", 10, None), (2, "b", 20, 1), (3, "b", 30, 1)]
    assigned = sessions.assign_sessions(spark.createDataFrame(rows, SCHEMA))
    assert {r.v1: r.session for r in assigned.collect()} == {1: 0, 2: 1, 3: 2}
    assert [r.v1 for r in sessions.carry_over_pages(assigned).collect()] == [1]


def test_properties_of_the_enhanced_log(spark, groups):
    log = random_log(4, 300, 200)
    traced = sessions.trace_visits(spark.createDataFrame(log, SCHEMA))
    rows = traced.collect()
    entries = defaultdict(int)
    last_pages = defaultdict(int)
    for v1, browser, ts, first in log:
        entries[browser] += first or 0
    for r in rows:
        assert 0 <= r.session <= max(entries[r.browser], 0)
        if r.browser is not None and r.ts is not None and r.time is None:
            last_pages[r.browser, r.session] += 1
    # one page per session has no time, even when several leave at once
    assert set(last_pages.values()) == {1}


def test_impute_mean_keeps_the_mean(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 20.0), (4, None)], "v1 int, time double")
    got = {r.v1: r.time for r in dwell.impute_mean(df).collect()}
    assert got == {1: 10.0, 2: 15.0, 3: 20.0, 4: 15.0}


def test_impute_mean_of_nothing_stays_missing(spark):
    df = spark.createDataFrame([(1, None)], "v1 int, time double")
    assert dwell.impute_mean(df).first().time is None


def test_tracing_takes_one_shuffle_and_one_sort(spark):
    df = spark.range(1000).select(
        F.col("id").alias("v1"),
        (F.col("id") % 7).cast("string").alias("browser"),
        F.col("id").alias("ts"),
        F.when(F.col("id") % 50 == 0, 1).alias("first_page"),
    )
    plan = sessions.trace_visits(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
