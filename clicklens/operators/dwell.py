"""Time spent per page, and an estimate where it cannot be measured."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.operators.skew import (
    HotKeys,
    hot_keys,
    ordered_scan,
    salted_join,
    split_hot,
    with_position,
)
from clicklens.sources.tables import stage_observed


def page_position(assigned: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Adds ``row_number``: the place of a page in its session by time."""
    hot = hot or hot_keys(assigned)
    return with_position(
        assigned, ["browser", "session"], F.col("ts"), "v1", "row_number", hot
    )


def dwell_time(assigned: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Adds ``time``: milliseconds to the next page of the session.

    The last page of a session has NULL; of pages at one moment all but the
    last have 0.
    """
    visit = ["browser", "session"]
    hot = hot or hot_keys(assigned)
    small, large = split_hot(assigned, hot)

    alone = F.when(F.col("browser").isNull(), F.col("v1"))
    in_order = Window.partitionBy(*visit, "alone").orderBy("ts", "v1")
    timed_small = small.withColumn("alone", alone).withColumn(
        "time", (F.lead("ts").over(in_order) - F.col("ts")).cast("double")
    )

    columns = [*assigned.columns, "time"]
    if large is None:
        return timed_small.select(*columns)

    moments = (
        large.filter(F.col("ts").isNotNull())
        .groupBy(*visit, "ts")
        .agg(F.max("v1").alias("last_v1"))
    )
    gaps = ordered_scan(moments, visit, "ts", "last_v1").select(
        *visit, "ts", "last_v1", (F.col("next_key") - F.col("ts")).alias("gap")
    )
    timed_large = salted_join(
        large, gaps, [*visit, "ts"], hot, "left", row_key=["v1"]
    ).withColumn(
        "time",
        F.when(F.col("v1") == F.col("last_v1"), F.col("gap"))
        .when(F.col("last_v1").isNotNull(), 0)
        .cast("double"),
    )
    return timed_small.select(*columns).unionByName(timed_large.select(*columns))


def impute_mean(df: DataFrame, column: str = "time") -> DataFrame:
    """Missing values of a column filled with the mean of the others.

    With a shared folder the rows are staged, and the mean is observed while they
    are written: the input is computed once. Without one the mean is a scalar
    subquery, a second pass that moves a single number.
    """
    staged, seen = stage_observed(df, mean=F.avg(column))
    if staged is None:
        mean = df.agg(F.avg(column).alias("mean")).scalar()
        return df.withColumn(column, F.coalesce(F.col(column), mean))
    mean = F.lit(seen["mean"]).cast(df.schema[column].dataType)
    return staged.withColumn(column, F.coalesce(F.col(column), mean))
