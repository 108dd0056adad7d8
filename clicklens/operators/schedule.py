"""Broadcast schedule: programmes of given days with duration and genres.

The facts of the days lead: they are cut to the days and made distinct, then meet
versions, assets and genres in turn, so that each dimension is joined to what the
days need of it and never to another whole dimension. Genres are cut to the
assets of the days, mapped and made distinct before they meet the facts, so that
the join multiplies a row by the number of broad genres at most. No window or
aggregate needs the rows of a key together here, so skewed joins are left to
adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.functions.clock import wrap_duration
from clicklens.functions.genre import map_genre

PROGRAMME = [
    "billed_title",
    "publication_date",
    "publication_start_time",
    "publication_end_time",
    "duration",
    "channel",
]


FACT = [
    "billed_title",
    "publication_date",
    "publication_start_s",
    "publication_end_s",
    "service_id",
    "product_version_id",
]


def _facts(events: DataFrame, days: Column) -> DataFrame:
    return events.filter(days & (F.col("planned_event_indicator") == 0)).select(*FACT)


def _with_assets(facts: DataFrame, versions: DataFrame, assets: DataFrame) -> DataFrame:
    """Facts with the asset of their version."""
    version = versions.select(F.col("id").alias("product_version_id"), "media_asset_id")
    asset = assets.select(F.col("id").alias("media_asset_id"))
    return facts.join(version, "product_version_id").join(asset, "media_asset_id")


def _star(facts: DataFrame, services: DataFrame, genres: DataFrame) -> DataFrame:
    """Facts that know their asset, with channel and genres."""
    channel = services.select(
        F.col("id").alias("service_id"), F.col("name").alias("channel")
    )
    start, end = F.col("publication_start_s"), F.col("publication_end_s")
    return (
        facts.join(channel, "service_id")
        .join(genres.select("media_asset_id", "genre"), "media_asset_id", "left")
        .select(
            "billed_title",
            "publication_date",
            start.alias("publication_start_time"),
            end.alias("publication_end_time"),
            wrap_duration(start, end).alias("duration"),
            "channel",
            "genre",
        )
    )


def schedule_base(
    events: DataFrame,
    services: DataFrame,
    versions: DataFrame,
    assets: DataFrame,
    genres: DataFrame,
    days: Column,
) -> DataFrame:
    """The star join: a row per programme and genre text of its asset."""
    return _star(_with_assets(_facts(events, days), versions, assets), services, genres)


def schedule_dedup(
    events: DataFrame,
    services: DataFrame,
    versions: DataFrame,
    assets: DataFrame,
    genres: DataFrame,
    days: Column,
) -> DataFrame:
    """Distinct programmes with each broad genre (NULL for none)."""
    facts = _with_assets(_facts(events, days).distinct(), versions, assets)
    broad = (
        genres.join(facts.select("media_asset_id").distinct(), "media_asset_id", "left_semi")
        .select("media_asset_id", map_genre(F.col("genre")).alias("genre"))
        .distinct()
    )
    return _star(facts, services, broad).distinct()


def schedule_extract(
    events: DataFrame,
    services: DataFrame,
    versions: DataFrame,
    assets: DataFrame,
    genres: DataFrame,
    days: Column,
) -> DataFrame:
    """A row per programme with its broad genres as text, by start time.

    The text has the genres in alphabetical order. Sorting goes on to the other
    columns so that programmes of one start time spread over the sorted parts.
    """
    rows = schedule_dedup(events, services, versions, assets, genres, days)
    names = F.expr("listagg(genre, ', ') WITHIN GROUP (ORDER BY genre)")
    return (
        rows.groupBy(*PROGRAMME)
        .agg(names.alias("genres"))
        .orderBy("publication_start_time", *PROGRAMME)
    )
