"""Repair of a raw page-view log.

Two kinds of damage are mended: timestamps exported as scientific text, and
rows whose columns a stray quote shifted to the left. Both are projections, so
the whole repair is one pass over the log without a join or a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.functions.text import (
    expand_sci_text,
    merged_page_url,
    merged_previous_page,
    sci_number,
    strip_marks,
)

# Fixed value: what the last column holds when a row is shifted.
SHIFT_MARK = "1"


def _is_shifted() -> Column:
    return F.col("application_type") == SHIFT_MARK


def _realigned() -> dict[str, Column]:
    """What each column of a shifted row should hold."""
    return {
        "page_url": merged_page_url(F.col("page_url")),
        "previous_page": merged_previous_page(F.col("page_url")),
        "virtual_site": strip_marks(F.col("previous_page")),
        "region": F.col("virtual_site"),
        "platform": F.col("region"),
        "application_type": F.col("platform"),
    }


def _repaired_ts() -> Column:
    return F.coalesce(expand_sci_text(F.col("ts_raw")), F.col("ts_raw"))


def repair_timestamps(raw: DataFrame) -> DataFrame:
    """``ts_raw`` with scientific text written out."""
    return raw.withColumn("ts_raw", _repaired_ts())


def shifted_rows(raw: DataFrame) -> DataFrame:
    """The rows whose columns are shifted."""
    return raw.filter(_is_shifted())


def split_merged_url(shifted: DataFrame) -> DataFrame:
    """URL and previous page of shifted rows, apart again."""
    mended = _realigned()
    return shifted.withColumns(
        {name: mended[name] for name in ("page_url", "previous_page")}
    )


def realign_shifted(shifted: DataFrame) -> DataFrame:
    """Shifted rows with every column back in its place."""
    return shifted.withColumns(_realigned())


def repair_clicks(raw: DataFrame) -> DataFrame:
    """The typed, repaired log plus ``is_shifted``.

    A row without an application type is neither good nor shifted and is left
    out; ``repair_report`` counts these rows.
    """
    mended = _realigned()
    names = ("page_url", "previous_page", "virtual_site", "region", "platform")

    def choose(name: str) -> Column:
        return F.when(_is_shifted(), mended[name]).otherwise(F.col(name)).alias(name)

    return raw.filter(F.col("application_type").isNotNull()).select(
        "v1",
        "browser",
        F.coalesce(sci_number(F.col("ts_raw")), F.col("ts_raw").try_cast("bigint")).alias(
            "ts"
        ),
        "day",
        F.col("hour").try_cast("int").alias("hour"),
        "entry_type",
        "page",
        *[choose(name) for name in names],
        choose("application_type"),
        _is_shifted().alias("is_shifted"),
    )


def repair_report(raw: DataFrame) -> DataFrame:
    """One row of counts: what the repair found in the log."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.instr("ts_raw", "e") > 0).alias("sci_timestamps"),
        F.count_if(_is_shifted()).alias("shifted_rows"),
        F.count_if(F.col("application_type").isNull()).alias("dropped_rows"),
    )
