"""The schedule of some days, from the tables of a warehouse."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.operators.schedule import schedule_extract
from clicklens.sources.tables import write_extract

# What the job reads, and the columns that it needs.
TABLES = {
    "events": (
        "billed_title",
        "publication_date",
        "publication_start_s",
        "publication_end_s",
        "service_id",
        "product_version_id",
        "planned_event_indicator",
    ),
    "services": ("id", "name"),
    "versions": ("id", "media_asset_id"),
    "assets": ("id",),
    "genres": ("media_asset_id", "genre"),
}


def read_schedule_tables(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    """The five tables by their names in the catalog, or as ``format.`path```."""
    missing = set(TABLES) - set(names)
    if missing:
        raise ValueError(f"no name for {sorted(missing)}")
    return {table: spark.table(names[table]).select(*columns) for table, columns in TABLES.items()}


def schedule_of_days(tables: dict[str, DataFrame], days: Sequence[date]) -> DataFrame:
    """The sorted extract of some days. They are literals, so a table that is
    partitioned by day is read for these days only, and others skip by it."""
    if not days:
        raise ValueError("no days")
    return schedule_extract(**tables, days=F.col("publication_date").isin(list(days)))


def run_schedule(
    spark: SparkSession,
    names: dict[str, str],
    days: Sequence[date],
    out_path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
) -> None:
    """Reads the five tables and writes the extract of some days, in its order:
    the files hold one range of it after the other."""
    write_extract(schedule_of_days(read_schedule_tables(spark, names), days), out_path, fmt, mode)
