"""Numbering rows without gaps, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows that a bucket is meant to hold; one task sorts a few buckets.
BUCKET_ROWS = 100_000


def bucket_count(rows: int) -> int:
    """Buckets for a table of ``rows``: more as it grows, and never fewer than
    keep all tasks busy."""
    return max(1024, 2 * rows // BUCKET_ROWS)


def written_out(
    counted: DataFrame, copies: str, name: str, chunk: int = 4096
) -> DataFrame:
    """Each row as often as its column ``copies`` says, numbered 0, 1, 2, ... by
    ``name`` in place of it.

    Copies are written in chunks, which are dealt by a shuffle of their own: no
    task holds all copies of a row, however many there are.
    """
    kept = [c for c in counted.columns if c != copies]
    once = counted.filter(F.col(copies) == 1)
    more = (
        counted.filter(F.col(copies) > 1)
        .withColumn(
            "first_", F.explode(F.sequence(F.lit(0), F.expr(f"({copies} - 1) div {chunk}")))
        )
        .repartition(*kept, "first_")
    )
    first = F.col("first_") * chunk
    last = F.least(first + chunk, F.col(copies)) - 1
    return once.select(*kept, F.lit(0).cast("bigint").alias(name)).union(
        more.select(*kept, F.explode(F.sequence(first, last)).alias(name))
    )


def gapless(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str,
    buckets: int,
) -> DataFrame:
    """Numbers 0, 1, 2, ... in each group; ``group`` may be empty for all rows.

    ``df`` has no columns but ``group`` and ``order``, so that equal rows are
    counted before they are shuffled, and numbered as one. Each group is cut
    into buckets by a hash of ``order``. A bucket is numbered in one task; where
    it starts comes from the counts of the buckets before it, of which there are
    at most ``buckets`` a group.
    """
    counted = df.groupBy(*group, *order).agg(F.count(F.lit(1)).alias("copies_"))
    cut = counted.withColumn(
        "bucket_", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    )
    before = (
        Window.partitionBy(*group)
        .orderBy("bucket_")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        cut.groupBy(*group, "bucket_")
        .agg(F.sum("copies_").alias("rows_"))
        .withColumn("start_", F.coalesce(F.sum("rows_").over(before), F.lit(0)))
        .drop("rows_")
    )
    inside = (
        Window.partitionBy(*group, "bucket_")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = (
        cut.withColumn("row_", F.coalesce(F.sum("copies_").over(inside), F.lit(0)))
        .join(starts, [*group, "bucket_"])
        .select(*df.columns, "copies_", (F.col("start_") + F.col("row_")).alias("row_"))
    )
    return written_out(numbered, "copies_", "copy_").select(
        *df.columns, (F.col("row_") + F.col("copy_")).cast("bigint").alias(name)
    )
