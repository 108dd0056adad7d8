"""One query per operator, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures
from clicklens import functions
from clicklens.operators import (
    dwell,
    explore,
    factors,
    kpi,
    repair,
    schedule,
    sessions,
    skew,
)
from clicklens.plans import charts
from clicklens.plans import schedule as schedule_plan
from clicklens.plans.enhance import enhance_clicks, enhance_repaired
from clicklens.schema import FACTORS
from clicklens.sources import clicks, tables

Query = Callable[[SparkSession, str], DataFrame]

HOUR_MS = 3_600_000
DAY_MS = 86_400_000

_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def marked(spark: SparkSession, sf_dir: str, tick_ms: int = 1) -> DataFrame:
    return sessions.mark_entries(fixtures.clicks(spark, sf_dir, tick_ms))


def hot(spark: SparkSession, sf_dir: str) -> skew.HotKeys:
    """The hot browsers, counted once for a query."""
    return skew.hot_keys(fixtures.clicks(spark, sf_dir))


def enhanced(
    spark: SparkSession, sf_dir: str, hot_browsers: skew.HotKeys | None = None
) -> DataFrame:
    return enhance_repaired(
        fixtures.clicks(spark, sf_dir), hot_browsers or hot(spark, sf_dir)
    )


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Sums of fractions depend on their order in the last bits: round them."""
    return df.withColumns({n: F.round(n, p) for n, p in places.items()})


def rounded_kpi(df: DataFrame, *names: str) -> DataFrame:
    """Times to whole milliseconds, ratios to six places."""
    use = F.col("kpi_filter") == "use"
    return df.withColumns(
        {n: F.when(use, F.round(n, 0)).otherwise(F.round(n, 6)) for n in names}
    )


# --- sources --------------------------------------------------------------


def _new_folder(spark: SparkSession) -> str:
    """A folder for a query that reads what it has written: in the shared one, or
    where tables go when the session, as in tests, has none."""
    folder = tables.stage_folder(spark) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder}/clicklens/{uuid.uuid4().hex}"


@query
def read_clicks(spark, sf_dir):
    path = _new_folder(spark)
    fixtures.write_lines(fixtures.click_lines(spark, sf_dir), path)
    return clicks.read_clicks(spark, path)


@query
def read_ragged_rows(spark, sf_dir):
    path = _new_folder(spark)
    fixtures.write_lines(fixtures.ragged_click_lines(spark, sf_dir), path)
    first = F.substring_index("line", ",", 1).cast("bigint")
    return clicks.read_ragged_rows(spark, path).select(first.alias("v1"))


@query
def repair_from_csv(spark, sf_dir):
    return repair.repair_clicks(clicks.parse_lines(fixtures.click_lines(spark, sf_dir)))


@query
def read_region_lookup(spark, sf_dir):
    path = _new_folder(spark)
    tables.write_extract(fixtures.region_hexes(spark, sf_dir), path, "csv")
    return clicks.read_region_lookup(spark, path)


@query
def read_enhanced(spark, sf_dir):
    path = _new_folder(spark)
    tables.write_enhanced(enhanced(spark, sf_dir), path)
    return rounded(tables.read_enhanced(spark, path), time=3)


# --- repair ---------------------------------------------------------------


@query
def expand_sci_text(spark, sf_dir):
    expanded = functions.expand_sci_text(F.col("ts_raw"))
    raw = fixtures.dirty_clicks(spark, sf_dir)
    return raw.select("v1", "ts_raw", expanded.alias("expanded"))


@query
def repair_timestamps(spark, sf_dir):
    raw = fixtures.dirty_clicks(spark, sf_dir)
    return repair.repair_timestamps(raw).select("v1", "ts_raw")


@query
def shifted_rows(spark, sf_dir):
    return repair.shifted_rows(fixtures.dirty_clicks(spark, sf_dir))


@query
def split_merged_url(spark, sf_dir):
    shifted = repair.shifted_rows(fixtures.dirty_clicks(spark, sf_dir))
    return repair.split_merged_url(shifted).select("v1", "page_url", "previous_page")


@query
def realign_shifted(spark, sf_dir):
    return repair.realign_shifted(
        repair.shifted_rows(fixtures.dirty_clicks(spark, sf_dir))
    )


@query
def repair_clicks(spark, sf_dir):
    return repair.repair_clicks(fixtures.dirty_clicks(spark, sf_dir))


@query
def repair_report(spark, sf_dir):
    return repair.repair_report(fixtures.dirty_clicks(spark, sf_dir))


# --- sessions -------------------------------------------------------------


@query
def mark_entries(spark, sf_dir):
    return marked(spark, sf_dir).select("v1", "browser", "ts", "first_page")


@query
def number_entries(spark, sf_dir):
    return sessions.number_entries(marked(spark, sf_dir)).select(
        "v1", "browser", "ts", "first_page", "session"
    )


@query
def number_entries_input_order(spark, sf_dir):
    clean = repair.repair_clicks(fixtures.dirty_clicks(spark, sf_dir))
    return sessions.number_entries(sessions.mark_entries(clean), "input").select(
        "v1", "browser", "ts", "first_page", "session"
    )


@query
def entries_per_browser(spark, sf_dir):
    return sessions.entries_per_browser(sessions.number_entries(marked(spark, sf_dir)))


@query
def session_spans(spark, sf_dir):
    return sessions.session_spans(sessions.number_entries(marked(spark, sf_dir)))


@query
def last_entries(spark, sf_dir):
    return sessions.last_entries(sessions.number_entries(marked(spark, sf_dir)))


def _span_join(spark: SparkSession, sf_dir: str, tick_ms: int) -> DataFrame:
    pages = marked(spark, sf_dir, tick_ms)
    hot_browsers = hot(spark, sf_dir)
    numbered = sessions.number_entries(pages, hot=hot_browsers)
    spans = sessions.session_spans(numbered).unionByName(
        sessions.last_entries(numbered), allowMissingColumns=True
    )
    seen = pages.select("v1", "browser", "ts")
    # entries numbered by time: their spans follow one another
    return sessions.assign_by_span(seen, spans, overlapping=False, hot=hot_browsers)


@query
def span_join(spark, sf_dir):
    return _span_join(spark, sf_dir, 1)


@query
def span_join_ties(spark, sf_dir):
    return _span_join(spark, sf_dir, DAY_MS)


@query
def span_join_overlapping(spark, sf_dir):
    """Spans by the order of the repaired log, which overlap."""
    clean = repair.repair_clicks(fixtures.dirty_clicks(spark, sf_dir))
    pages = sessions.mark_entries(clean)
    numbered = sessions.number_entries(pages, "input")
    spans = sessions.session_spans(numbered)
    return sessions.assign_by_span(pages.select("v1", "browser", "ts"), spans)


def _assigned(spark: SparkSession, sf_dir: str, tick_ms: int = 1) -> DataFrame:
    return sessions.assign_sessions(marked(spark, sf_dir, tick_ms), hot(spark, sf_dir))


@query
def carry_over_pages(spark, sf_dir):
    return sessions.carry_over_pages(_assigned(spark, sf_dir)).select(
        "v1", "browser", "ts", "first_page", "session"
    )


@query
def assign_sessions(spark, sf_dir):
    return _assigned(spark, sf_dir).select("v1", "browser", "ts", "first_page", "session")


@query
def mark_exits(spark, sf_dir):
    assigned = _assigned(spark, sf_dir)
    return sessions.mark_exits(assigned, hot(spark, sf_dir)).select(
        "v1", "browser", "session", "exit_page"
    )


# --- dwell time -----------------------------------------------------------


@query
def page_position(spark, sf_dir):
    assigned = _assigned(spark, sf_dir)
    return dwell.page_position(assigned, hot(spark, sf_dir)).select(
        "v1", "browser", "session", "row_number"
    )


@query
def dwell_time(spark, sf_dir):
    return dwell.dwell_time(_assigned(spark, sf_dir), hot(spark, sf_dir)).select(
        "v1", "browser", "session", "time"
    )


def _visits(spark: SparkSession, sf_dir: str, tick_ms: int) -> DataFrame:
    return sessions.trace_visits(marked(spark, sf_dir, tick_ms), hot(spark, sf_dir)).select(
        "v1", "browser", "ts", "first_page", "session", "exit_page", "time"
    )


@query
def trace_visits(spark, sf_dir):
    return _visits(spark, sf_dir, 1)


@query
def trace_visits_hour_ties(spark, sf_dir):
    return _visits(spark, sf_dir, HOUR_MS)


@query
def trace_visits_day_ties(spark, sf_dir):
    return _visits(spark, sf_dir, DAY_MS)


@query
def impute_mean(spark, sf_dir):
    timed = dwell.impute_mean(sessions.trace_visits(marked(spark, sf_dir)))
    return rounded(timed.select("v1", "time"), time=3)


@query
def enhanced_clicks(spark, sf_dir):
    return rounded(enhanced(spark, sf_dir), time=3)


@query
def enhanced_from_dirty_log(spark, sf_dir):
    return rounded(enhance_clicks(fixtures.dirty_clicks(spark, sf_dir)), time=3)


# --- KPIs and products ----------------------------------------------------


def _log_and_hot(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, skew.HotKeys]:
    hot_browsers = hot(spark, sf_dir)
    return enhanced(spark, sf_dir, hot_browsers), hot_browsers


@query
def kpi_reach(spark, sf_dir):
    return kpi.kpi_reach(enhanced(spark, sf_dir))


@query
def kpi_use(spark, sf_dir):
    return rounded(kpi.kpi_use(enhanced(spark, sf_dir)), use=0)


@query
def kpi_breadth(spark, sf_dir):
    return rounded(kpi.kpi_breadth(enhanced(spark, sf_dir)), breadth=6)


@query
def kpi_table(spark, sf_dir):
    return rounded_kpi(kpi.kpi_table(enhanced(spark, sf_dir)), "value")


@query
def kpi_reach_approx(spark, sf_dir):
    """Reach per product from sketches by day, beside the exact one: the estimate
    holds when it is within its error or, for the smallest groups, within one."""
    log = enhanced(spark, sf_dir)
    sketches = tables.stage(kpi.reach_sketches(log))
    estimated = kpi.merge_reach(sketches, ["virtual_site"]).withColumnRenamed(
        "virtual_site", "of_product"
    )
    exact = kpi.product_reach(log)
    off = F.abs(F.col("reach_estimate") - F.col("browser_count"))
    bound = F.greatest(F.lit(1.0), F.col("browser_count") * kpi.reach_error())
    same = F.col("virtual_site").eqNullSafe(F.col("of_product"))
    return exact.join(estimated, same).select(
        "virtual_site", "browser_count", (off <= bound).alias("estimate_holds")
    )


@query
def product_reach(spark, sf_dir):
    return kpi.product_reach(enhanced(spark, sf_dir))


@query
def product_use(spark, sf_dir):
    return rounded(kpi.product_use(enhanced(spark, sf_dir)), time=0)


@query
def browser_products(spark, sf_dir):
    return kpi.browser_products(enhanced(spark, sf_dir))


@query
def product_breadth(spark, sf_dir):
    return rounded(kpi.product_breadth(*_log_and_hot(spark, sf_dir)), breadth=6)


@query
def product_table(spark, sf_dir):
    return rounded_kpi(kpi.product_table(*_log_and_hot(spark, sf_dir)), "value")


# --- factor charts --------------------------------------------------------


@query
def factor_total_reach(spark, sf_dir):
    return factors.factor_total_reach(enhanced(spark, sf_dir))


@query
def factor_total_use(spark, sf_dir):
    return rounded(factors.factor_total_use(enhanced(spark, sf_dir)), time=0)


def _cells(spark: SparkSession, sf_dir: str, chart: str | None = None) -> DataFrame:
    """Cells of the factors of a chart, staged for the several uses of a chart."""
    chosen = [f for f in FACTORS if chart in (None, f.chart)]
    return tables.stage(factors.factor_cells(enhanced(spark, sf_dir), chosen), "factor")


@query
def factor_total_breadth(spark, sf_dir):
    return factors.factor_total_breadth(_cells(spark, sf_dir), hot=hot(spark, sf_dir))


@query
def factor_reach(spark, sf_dir):
    return factors.factor_reach(_cells(spark, sf_dir))


@query
def factor_use(spark, sf_dir):
    used = factors.factor_use(_cells(spark, sf_dir))
    return rounded(used, value=0, overall_value=0)


@query
def factor_breadth(spark, sf_dir):
    breadth = factors.factor_breadth(_cells(spark, sf_dir), hot=hot(spark, sf_dir))
    return rounded(breadth, value=6)


@query
def factor_breadth_exact(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    exact = factors.factor_breadth(cells, exact_ratio=True, hot=hot(spark, sf_dir))
    return rounded(exact, value=6, overall_value=6)


def _chart(spark: SparkSession, sf_dir: str, chart: str) -> DataFrame:
    chosen = [f for f in FACTORS if f.chart == chart]
    cells = _cells(spark, sf_dir, chart)
    rows = factors.factor_table(cells, chosen, hot=hot(spark, sf_dir))
    return rounded_kpi(rows, "value", "overall_value")


@query
def chart_how(spark, sf_dir):
    return _chart(spark, sf_dir, "how")


@query
def chart_who(spark, sf_dir):
    return _chart(spark, sf_dir, "who")


@query
def chart_when(spark, sf_dir):
    return _chart(spark, sf_dir, "when")


@query
def dashboard_long(spark, sf_dir):
    return rounded_kpi(
        charts.dashboard_long(enhanced(spark, sf_dir), hot=hot(spark, sf_dir)),
        "value",
        "overall_value",
    )


@query
def dashboard_with_hex(spark, sf_dir):
    hexes = fixtures.region_hexes(spark, sf_dir)
    log, hot_browsers = _log_and_hot(spark, sf_dir)
    dashboard = charts.dashboard_with_hex(log, hexes, hot_browsers)
    return rounded_kpi(dashboard, "value", "overall_value")


# --- explore --------------------------------------------------------------


@query
def browser_metrics(spark, sf_dir):
    log, hot_browsers = _log_and_hot(spark, sf_dir)
    return rounded(explore.browser_metrics(log, hot=hot_browsers), time=0)


@query
def factor_metrics(spark, sf_dir):
    log, hot_browsers = _log_and_hot(spark, sf_dir)
    return rounded(explore.factor_metrics(log, hot=hot_browsers), time=0)


@query
def explore_factor(spark, sf_dir):
    region = [f for f in FACTORS if f.label == "region"]
    log, hot_browsers = _log_and_hot(spark, sf_dir)
    return _explored(explore.explore_table(log, region, hot_browsers))


@query
def explore_all(spark, sf_dir):
    log, hot_browsers = _log_and_hot(spark, sf_dir)
    return _explored(explore.explore_table(log, hot=hot_browsers))


def _explored(df: DataFrame) -> DataFrame:
    return rounded(rounded_kpi(df, "kpi_value"), breadth_kpi=6, time=0)


# --- schedule -------------------------------------------------------------


@query
def schedule_job(spark, sf_dir):
    """The job from tables on disk, the facts ordered by day in each file."""
    names = {}
    for name, df in fixtures.schedule_tables(spark, sf_dir).items():
        path = _new_folder(spark)
        if name == "events":
            df = df.sortWithinPartitions("publication_date")
        df.write.parquet(path)
        names[name] = f"parquet.`{path}`"
    found = schedule_plan.read_schedule_tables(spark, names)
    return schedule_plan.schedule_of_days(found, SCHEDULE_DAYS)


SCHEDULE_DAYS = [date(1995, 8, day) for day in range(1, 15)]


def _days() -> Column:
    return F.col("publication_date").between("1995-01-01", "1996-12-31")


@query
def wrap_duration(spark, sf_dir):
    events = fixtures.schedule_tables(spark, sf_dir)["events"]
    start, end = F.col("publication_start_s"), F.col("publication_end_s")
    return events.select(
        "product_version_id", start, end, functions.wrap_duration(start, end).alias("duration")
    )


@query
def map_genre(spark, sf_dir):
    genres = fixtures.schedule_tables(spark, sf_dir)["genres"]
    return genres.withColumn("broad", functions.map_genre(F.col("genre")))


@query
def schedule_base(spark, sf_dir):
    return schedule.schedule_base(
        **fixtures.schedule_tables(spark, sf_dir), days=_days()
    )


@query
def schedule_dedup(spark, sf_dir):
    return schedule.schedule_dedup(
        **fixtures.schedule_tables(spark, sf_dir), days=_days()
    )


@query
def schedule_extract(spark, sf_dir):
    return schedule.schedule_extract(
        **fixtures.schedule_tables(spark, sf_dir), days=_days()
    )
