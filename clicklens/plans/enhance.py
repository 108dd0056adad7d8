"""From a raw log to the enhanced one: repair, sessions, dwell time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicklens.operators.dwell import impute_mean
from clicklens.operators.repair import repair_clicks
from clicklens.operators.sessions import mark_entries, trace_visits
from clicklens.operators.skew import HotKeys
from clicklens.schema import ENHANCED_COLUMNS
from clicklens.sources.clicks import read_clicks
from clicklens.sources.tables import job, stage, write_enhanced


def enhance_repaired(clicks: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Sessions, exits and (imputed) dwell time for a clean log."""
    traced = trace_visits(mark_entries(clicks), hot)
    return impute_mean(traced).select(*ENHANCED_COLUMNS)


def enhance_clicks(raw: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The whole enhancement of a raw log."""
    return enhance_repaired(repair_clicks(raw), hot)


def run_enhance(
    spark: SparkSession,
    log_path: str,
    out_path: str,
    fmt: str = "csv",
    mode: str = "errorifexists",
) -> None:
    """Reads a raw log, enhances it and writes it by day.

    Text is parsed once and the log is cut into sessions once: both results are
    staged as parquet. Hot browsers are counted from the staged log, and the mean
    dwell time is observed while the sessions are written. What is staged is
    deleted at the end.
    """
    with job(spark):
        repaired = stage(repair_clicks(read_clicks(spark, log_path, fmt)))
        write_enhanced(enhance_repaired(repaired), out_path, mode)
