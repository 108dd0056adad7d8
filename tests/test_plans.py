"""Plans and jobs: what is shuffled, and when work is done."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from clicklens.operators import dwell, explore, factors, kpi, sessions, skew
from clicklens.plans.enhance import enhance_repaired
from clicklens.sources import tables

LOG = (
    "v1 bigint, browser string, ts bigint, day date, hour int, entry_type string, page string,"
    " page_url string, previous_page string, virtual_site string, region string,"
    " platform string, application_type string, session int, time double, first_page int"
)


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    rows = [
        (i, None if i % 17 == 0 else f"b{i % 7 if i % 3 else 0}", i * 10 % 991, None, i % 24, "e", f"p{i % 9}",
         f"/u{i % 11}", None if i % 13 == 0 else "p", f"s{i % 5}" if i % 6 else None, f"r{i % 4}", "pl", "web",
         i % 3, float(i), None)
        for i in range(300)
    ]
    path = str(tmp_path_factory.mktemp("log") / "log")
    spark.createDataFrame(rows, LOG).write.parquet(path)
    return spark.read.schema(LOG).parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"\bExchange ", executed(df)))


def test_explore_multiplies_no_row_before_it_is_dealt(spark, log):
    hot = skew.HotKeys("browser", None)
    tree = executed(explore.browser_metrics(log, hot=hot))
    assert "Expand" not in tree
    # the branch of ordinary browsers, from its scan up to the result
    branch = tree[: tree.index("Scan parquet")].splitlines()
    dealt = [i for i, line in enumerate(branch) if "Exchange" in line]
    assert len(dealt) == 1 and "hashpartitioning(browser#" in branch[dealt[0]]
    assert all(i < dealt[0] for i, line in enumerate(branch) if "Generate" in line)


def test_explore_gives_a_task_so_many_rows_and_no_more(spark, log, tmp_path, monkeypatch):
    monkeypatch.setattr(explore, "TASK_ROWS", 100, raising=False)
    rows = log.filter("browser is not null and v1 < 200").drop("browser")
    many = rows.crossJoin(spark.range(12)).selectExpr(
        "*", "if(v1 % 9 = 0, null, if(v1 % 4 = 0, 'hot', 'b' || (v1 * 7 + id) % 400)) browser"
    )
    many.write.parquet(str(tmp_path / "many"))
    many = spark.read.schema(many.schema).parquet(str(tmp_path / "many"))
    plain = explore.browser_metrics(many, hot=skew.HotKeys("browser", None)).collect()
    for limit in ("2000000", "100"):
        spark.conf.set(skew.LARGE_GROUP_CONF, limit)
        try:
            hot = skew.hot_keys(many)
        finally:
            spark.conf.unset(skew.LARGE_GROUP_CONF)
        assert (hot.table is None) == (limit == "2000000")
        metrics = explore.browser_metrics(many, hot=hot)
        assert sorted(map(repr, metrics.collect())) == sorted(map(repr, plain))
        known = metrics.filter("browser like 'b%'")
        task = known.withColumn("task", F.spark_partition_id()).groupBy("task")
        held = task.agg(F.countDistinct("browser").alias("browsers")).collect()
        of_browser = {r.browser: r["count"] for r in many.groupBy("browser").count().collect()}
        ordinary = sum(n for b, n in of_browser.items() if b and b != "hot")
        assert len(held) >= ordinary // 100
        # 400 browsers of some four rows
        assert max(r.browsers for r in held) <= 60


@pytest.mark.parametrize("staged", [False, True])
def test_rows_are_counted_with_the_hot_keys(spark, log, tmp_path, monkeypatch, staged):
    if staged:
        monkeypatch.setattr(tables, "stage_folder", lambda _: f"file://{tmp_path}")
        monkeypatch.setattr(skew, "stage_folder", lambda _: f"file://{tmp_path}")
    counts = {r.browser: r["count"] for r in log.groupBy("browser").count().collect()}
    found = skew.hot_keys(log)
    assert (found.table, found.rows, found.apart) == (None, 300, counts[None])
    spark.conf.set(skew.LARGE_GROUP_CONF, "40")
    try:
        found = skew.hot_keys(log)
    finally:
        spark.conf.unset(skew.LARGE_GROUP_CONF)
    assert (found.rows, found.apart) == (300, counts[None] + counts["b0"])
    for empty in (log.filter("v1 < 0"), spark.createDataFrame([], LOG), log.limit(0)):
        found = skew.hot_keys(empty)
        assert (found.table, found.nulls, found.rows, found.apart) == (None, False, 0, 0)
        assert explore.browser_metrics(empty, hot=found).collect() == []


def test_merge_join_of_spans_shuffles_once(spark, log, tmp_path):
    hot = skew.HotKeys("browser", None)
    pages = log.drop("session", "time", "first_page")
    numbered = sessions.number_entries(sessions.mark_entries(pages), hot=hot)
    sessions.session_spans(numbered).write.parquet(str(tmp_path / "spans"))
    spans = spark.read.parquet(str(tmp_path / "spans"))
    joined = sessions.assign_by_span(pages, spans, overlapping=False, hot=hot)
    assert exchanges(joined) == 1 and "Join" not in executed(joined)
    blocks = sessions.assign_by_span(pages, spans, hot=hot)
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, blocks.collect()))


def test_merge_join_refuses_spans_that_overlap(spark, log):
    spans = spark.createDataFrame(
        [("b0", 1, 0, 500), ("b0", 2, 400, None)], "browser string, session int, ts bigint, end_ts bigint"
    )
    pages = log.drop("session")
    with pytest.raises(Exception, match="spans overlap"):
        sessions.assign_by_span(pages, spans, overlapping=False).collect()
    assert sessions.assign_by_span(pages, spans).count() > 0


def jobs_while(spark, build) -> int:
    context = spark.sparkContext
    name = f"build-{id(build)}"
    context.setJobGroup(name, name)
    try:
        build()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(name))


def test_operators_that_are_given_hot_keys_run_no_job(spark, log):
    spark.conf.set(skew.LARGE_GROUP_CONF, "40")
    try:
        found = skew.hot_keys(log)
    finally:
        spark.conf.unset(skew.LARGE_GROUP_CONF)
    assert {r.browser for r in found.table.collect()} == {"b0"}
    pages = log.drop("session", "time", "first_page")
    marked = sessions.mark_entries(pages)
    spans = pages.selectExpr("browser", "ts", "v1 AS session", "ts + 9 AS end_ts")
    for hot in (found, skew.HotKeys("browser", None)):
        builds = [
            lambda: sessions.trace_visits(marked, hot),
            lambda: sessions.number_entries(marked, hot=hot),
            lambda: sessions.mark_exits(log, hot),
            lambda: sessions.assign_by_span(pages, spans, hot=hot),
            lambda: dwell.page_position(log, hot),
            lambda: dwell.dwell_time(log.drop("time"), hot),
            lambda: kpi.product_breadth(log, hot),
            lambda: kpi.product_table(log, hot),
            lambda: factors.factor_breadth(log, hot=hot),
            lambda: factors.factor_total_breadth(log, hot=hot),
            lambda: factors.factor_table(log, hot=hot),
            lambda: explore.explore_table(log, hot=hot),
        ]
        assert [jobs_while(spark, build) for build in builds] == [0] * len(builds)
    assert jobs_while(spark, lambda: skew.hot_keys(log)) > 0


def test_the_mean_is_taken_while_rows_are_staged(spark, log, tmp_path, monkeypatch):
    hot = skew.HotKeys("browser", None)
    clicks = log.drop("session", "time", "first_page")
    unstaged = enhance_repaired(clicks, hot)
    monkeypatch.setattr(tables, "stage_folder", lambda _: f"file://{tmp_path}")
    staged = enhance_repaired(clicks, hot)
    assert exchanges(staged) == 0 and "Subquery" not in executed(staged)
    assert sorted(map(repr, staged.collect())) == sorted(map(repr, unstaged.collect()))


def test_sketches_of_days_add_up(spark, log):
    by_hour = kpi.reach_sketches(log, ["hour", "virtual_site"])
    got = {r.virtual_site: r.reach_estimate for r in kpi.merge_reach(by_hour, ["virtual_site"]).collect()}
    assert got == {r.virtual_site: r.browser_count for r in kpi.product_reach(log).collect()}
    many = spark.range(300_000).selectExpr("id % 100000 AS browser", "id % 3 AS day", "'s' AS virtual_site")
    estimate = kpi.merge_reach(kpi.reach_sketches(many)).first().reach_estimate
    assert abs(estimate - 100_000) <= 100_000 * kpi.reach_error()
