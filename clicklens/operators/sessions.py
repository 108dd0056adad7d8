"""Sessions, entries and exits of browsers.

A page view without a previous page is an *entry* and opens a session of its
browser. A session lasts until the next entry of the browser. Pages before the
first of several entries belong to session 0 (a visit that began the day
before); a browser with one entry has all its pages in session 1.

``trace_visits`` finds session, exit flag and dwell time together. For browsers
of ordinary size it needs one shuffle and one sort: all windows share the
partitioning by browser and the order by time. A large browser is first reduced
to its distinct moments, which are scanned digit by digit (``ordered_scan``)
and joined back, so that no task ever holds the browser.

Operators take the hot browsers of the log (``hot_keys``); without them they
count for themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.operators.skew import (
    HotKeys,
    hot_keys,
    ordered_scan,
    salted_join,
    split_hot,
    with_group_values,
    with_position,
)


def mark_entries(clicks: DataFrame) -> DataFrame:
    """Adds ``first_page``: 1 for an entry, else NULL."""
    return clicks.withColumn(
        "first_page", F.when(F.col("previous_page").isNull(), F.lit(1))
    )


def number_entries(
    marked: DataFrame, order: str = "time", hot: HotKeys | None = None
) -> DataFrame:
    """Entries only, numbered 1..n per browser in ``session``.

    ``order="time"`` goes by timestamp, ``order="input"`` by the row order of
    the repaired log: rows that were shifted come last.
    """
    if order not in ("time", "input"):
        raise ValueError(f"unknown order: {order}")
    by = F.col("ts") if order == "time" else F.col("is_shifted").cast("bigint")
    entries = marked.filter(F.col("first_page") == 1)
    hot = hot or hot_keys(entries)
    return with_position(entries, ["browser"], by, "v1", "session", hot)


def entries_per_browser(numbered: DataFrame) -> DataFrame:
    """Number of entries of each browser that has any."""
    return numbered.groupBy("browser").agg(F.max("session").alias("max_session"))


def session_spans(numbered: DataFrame) -> DataFrame:
    """From each entry to the next one of its browser: ``[ts, end_ts)``.

    (browser, session) is unique, so this join has no large groups.
    """
    following = numbered.select(
        "browser",
        (F.col("session") - 1).alias("session"),
        F.col("ts").alias("end_ts"),
    )
    return numbered.join(following, ["browser", "session"]).select(
        "v1", "browser", "ts", "end_ts", "first_page", "session"
    )


def last_entries(numbered: DataFrame) -> DataFrame:
    """The last entry of each browser with several entries."""
    following = numbered.select("browser", (F.col("session") - 1).alias("session"))
    return (
        numbered.filter(F.col("browser").isNotNull() & (F.col("session") > 1))
        .join(following, ["browser", "session"], "left_anti")
        .select("v1", "browser", "ts", "first_page", "session")
    )


# A span is cut into aligned blocks of 16**level milliseconds.
BLOCK_BITS = 4
BLOCK_LEVELS = 16
OPEN_END = 7 << (BLOCK_BITS * (BLOCK_LEVELS - 1))


def _blocks_of_span(level: int, start: Column, end: Column) -> Column:
    """Blocks of one level that lie in the span while their parent does not."""

    def whole_blocks(bits: int) -> tuple[Column, Column]:
        last_offset = F.lit((1 << bits) - 1)
        return F.shiftright(start + last_offset, bits), F.shiftright(end, bits)

    def run(low: Column, high: Column) -> Column:
        blocks = F.sequence(low, F.greatest(low, high - 1))
        return F.when(low < high, blocks).otherwise(F.array().cast("array<bigint>"))

    low, high = whole_blocks(BLOCK_BITS * level)
    if level == BLOCK_LEVELS - 1:
        return run(low, high)
    parent_low, parent_high = whole_blocks(BLOCK_BITS * (level + 1))
    left_end = F.shiftleft(parent_low, BLOCK_BITS)
    right_start = F.shiftleft(parent_high, BLOCK_BITS)
    return F.when(
        parent_low < parent_high,
        F.concat(run(low, left_end), run(right_start, high)),
    ).otherwise(run(low, high))


def assign_by_span(
    pages: DataFrame,
    spans: DataFrame,
    overlapping: bool = True,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Range join: every page with the sessions of its browser whose span
    ``[ts, end_ts)`` holds it. A NULL ``end_ts`` leaves the span open.

    Spans of one browser that do not overlap, as entries numbered by time give
    them, are merged with the pages: both are shuffled once and the span that
    opened last is carried along. Such a merge raises an error if two spans do
    overlap. Overlapping spans, and all spans of hot browsers, are matched by
    aligned blocks.
    """
    hot = hot or hot_keys(pages)
    if overlapping:
        return _assign_by_block(pages, spans, hot)
    small_pages, large_pages = split_hot(pages, hot)
    small_spans, large_spans = split_hot(spans, hot)
    merged = _assign_by_merge(small_pages, small_spans)
    if large_pages is None:
        return merged
    return merged.unionByName(_assign_by_block(large_pages, large_spans, hot))


def _assign_by_merge(pages: DataFrame, spans: DataFrame) -> DataFrame:
    """One union by browser; a span stands before the pages of its first moment."""
    opens = F.struct(F.col("session"), F.coalesce("end_ts", F.lit(OPEN_END)).alias("end"))
    openings = spans.filter(F.col("ts") < F.coalesce("end_ts", F.lit(OPEN_END))).select(
        F.col("browser").alias("of_browser"),
        F.col("ts").alias("at"),
        opens.alias("span"),
        F.lit(None).cast(pages.schema).alias("page"),
    )
    seen = pages.filter("browser IS NOT NULL AND ts IS NOT NULL").select(
        F.col("browser").alias("of_browser"),
        F.col("ts").alias("at"),
        F.lit(None).cast(openings.schema["span"].dataType).alias("span"),
        F.struct(*pages.columns).alias("page"),
    )
    in_order = Window.partitionBy("of_browser").orderBy("at", F.col("span").isNull())
    last = F.last("span", ignorenulls=True)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # no page follows at the moment of a span but behind it, so ROWS will do
    joined = openings.unionByName(seen).select(
        "*", last.over(before).alias("open"), F.col("span").isNull().alias("is_page")
    )
    clash = ~F.col("is_page") & (F.col("open.end") > F.col("at"))
    checked = F.when(clash, F.raise_error(F.lit("spans overlap")).cast("boolean")).otherwise(
        F.col("is_page") & (F.col("at") < F.col("open.end"))
    )
    return joined.filter(checked).select("page.*", "open.session")


def _assign_by_block(pages: DataFrame, spans: DataFrame, hot: HotKeys) -> DataFrame:
    """Block matches.

    A span is cut into at most 30 aligned blocks per level, and a page looks
    up the one block that holds it on each level that spans use. A match *is* a
    result row, so the work grows with pages, spans and results, not with their
    product.
    """
    start = F.col("ts")
    end = F.coalesce("end_ts", F.lit(OPEN_END))
    span_blocks = (
        spans.filter(start < end)
        .select(
            "browser",
            "session",
            F.posexplode(
                F.array(*[_blocks_of_span(i, start, end) for i in range(BLOCK_LEVELS)])
            ).alias("level", "blocks"),
        )
        .select("browser", "session", "level", F.explode("blocks").alias("block"))
    )
    used = span_blocks.agg(F.collect_set("level").alias("levels")).scalar()
    levels = F.array(
        *[
            F.struct(F.lit(i).alias("level"), F.shiftright("ts", BLOCK_BITS * i).alias("block"))
            for i in range(BLOCK_LEVELS)
        ]
    )
    page_blocks = (
        pages.withColumn("levels", used)
        .withColumn(
            "found", F.explode(F.filter(levels, lambda x: F.array_contains("levels", x["level"])))
        )
        .select(*pages.columns, "found.level", "found.block")
    )
    found = ["browser", "level", "block"]
    return salted_join(page_blocks, span_blocks, found, hot, row_key=["v1"]).select(
        *pages.columns, "session"
    )


def trace_visits(marked: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Adds ``session``, ``exit_page`` (1 or NULL) and ``time`` (milliseconds to
    the next page of the session, NULL on its last page)."""
    hot = hot or hot_keys(marked)
    small, large = split_hot(marked, hot)
    traced = _trace_small(small)
    return traced if large is None else traced.unionByName(_trace_large(large, hot))


def _traced(
    marked: DataFrame, session: Column, exit_page: Column, time: Column
) -> list[Column]:
    """Columns of a traced row; a page in no session is no entry either."""
    kept = [F.col(c) for c in marked.columns if c != "first_page"]
    return [
        *kept,
        F.when(session > 0, F.col("first_page")).alias("first_page"),
        session.cast("int").alias("session"),
        exit_page.cast("int").alias("exit_page"),
        time.cast("double").alias("time"),
    ]


def _trace_small(marked: DataFrame) -> DataFrame:
    # a row without a browser is a group of its own, so such rows spread
    visitor = ["browser", "alone"]
    by_row = Window.partitionBy(*visitor).orderBy("ts", "v1")
    by_ts = Window.partitionBy(*visitor).orderBy("ts")
    same_ts = Window.partitionBy(*visitor, "ts")
    whole = by_ts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # pages that share a timestamp share a session, hence RANGE
    so_far = by_ts.rangeBetween(Window.unboundedPreceding, Window.currentRow)

    timed_entry = F.when(F.col("ts").isNotNull(), F.col("first_page"))
    session = (
        F.when(F.col("browser").isNull(), 0)
        .when(F.col("entries") == 1, 1)
        .when(F.col("ts").isNull(), 0)
        .otherwise(F.coalesce("opened", F.lit(0)))
    )
    stays = F.col("next_session") == F.col("visit")
    is_exit = F.col("ts") == F.coalesce("later_ts", "ts")
    return (
        marked.withColumn("alone", F.when(F.col("browser").isNull(), F.col("v1")))
        # the finest order first: the windows below reuse its sort
        .withColumn("next_ts", F.lead("ts").over(by_row))
        .withColumns(
            {
                "entries": F.sum("first_page").over(whole),
                "opened": F.sum(timed_entry).over(so_far),
            }
        )
        .withColumn("visit", session)
        .withColumn("next_session", F.lead("visit").over(by_row))
        .withColumn("later_ts", F.max(F.when(stays, F.col("next_ts"))).over(same_ts))
        .select(
            *_traced(
                marked,
                F.col("visit"),
                F.when(F.col("browser").isNotNull() & is_exit, 1),
                F.when(stays, F.col("next_ts") - F.col("ts")),
            )
        )
    )


def _trace_large(marked: DataFrame, hot: HotKeys) -> DataFrame:
    # a row per hot browser
    totals = marked.groupBy("browser").agg(F.sum("first_page").alias("entries"))
    moments = (
        marked.filter(F.col("ts").isNotNull())
        .groupBy("browser", "ts")
        .agg(
            F.coalesce(F.sum("first_page"), F.lit(0)).alias("opens"),
            F.max("v1").alias("last_v1"),
        )
    )
    scanned = ordered_scan(moments, ["browser"], "ts", "opens").join(totals, "browser")
    one_visit = F.coalesce(F.col("entries") == 1, F.lit(False))
    stays = one_visit | (F.col("next_value") == 0)
    visits = scanned.select(
        "browser",
        "ts",
        "last_v1",
        F.when(one_visit, 1).otherwise(F.col("running")).alias("visit"),
        F.when(stays, F.col("next_key") - F.col("ts")).alias("gap"),
    )
    # a page without a timestamp has no moment
    joined = salted_join(
        marked.join(totals, "browser", "left"),
        visits,
        ["browser", "ts"],
        hot,
        "left",
        row_key=["v1"],
    )
    session = F.coalesce("visit", F.when(one_visit, 1).otherwise(0))
    has_moment = F.col("visit").isNotNull()
    return joined.select(
        *_traced(
            marked,
            session,
            F.when(has_moment & F.col("gap").isNull(), 1),
            F.when(F.col("v1") == F.col("last_v1"), F.col("gap")).when(has_moment, 0),
        )
    )


def assign_sessions(marked: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Adds ``session`` to every page."""
    return trace_visits(marked, hot).drop("exit_page", "time")


def carry_over_pages(assigned: DataFrame) -> DataFrame:
    """Pages in no session of the day: their visit began before it."""
    return assigned.filter(F.col("session") == 0)


def mark_exits(assigned: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Adds ``exit_page``: 1 for every page at the last moment of its session."""
    last = with_group_values(
        assigned,
        ["browser", "session"],
        {"last_ts": F.max("ts")},
        hot or hot_keys(assigned),
        row_key=["v1"],
    )
    return last.withColumn(
        "exit_page", F.when(F.col("ts") == F.col("last_ts"), F.lit(1))
    ).drop("last_ts")
