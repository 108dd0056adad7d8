"""Metrics per factor value for a choose-your-axes scatter chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.operators.factors import FACTOR
from clicklens.operators.skew import HotKeys, hot_keys, split_hot
from clicklens.schema import EXPLORE_FACTORS, Factor

# Rows of the log that a task counts. It holds two dozen values for each of them,
# twice at that, before and after they are added up: 7 to 13 KB a row.
TASK_ROWS = 32_768

METRICS = ["product_count", "time", "browser_count", "page_count", "session_count"]
COUNTED = {
    "product_count": "virtual_site",
    "page_count": "page_url",
    "session_count": "session",
}


def _dealt(df: DataFrame, rows: int | None, *columns: str) -> DataFrame:
    """``df`` dealt over as many tasks as its ``rows`` need; adaptive execution,
    which counts the bytes that are read and not what becomes of them, would make
    it fewer. Where nobody counted the rows it is left to do so."""
    if rows is None:
        return df.repartition(*columns)
    return df.repartition(max(1, -(-rows // TASK_ROWS)), *columns)


def _visited(df: DataFrame, factors: Sequence[Factor]) -> DataFrame:
    """The log summed to one row per browser, product, page, session and values
    of all factors: what any of the metrics can tell apart."""
    kept = list(dict.fromkeys(["browser", *COUNTED.values(), *[f.column for f in factors]]))
    return df.groupBy(*kept).agg(F.sum("time").alias("time"))


def _per_browser(visited: DataFrame, factors: Sequence[Factor]) -> DataFrame:
    """Sums and distinct counts per browser and factor value.

    Rows are multiplied by ``inline``, which leaves them where they are dealt;
    what an unpivot or several distinct counts put out would be shuffled again.
    """
    values = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(f.label).alias("factor"),
                    F.col(f.column).cast("string").alias("factor_value"),
                )
                for f in factors
            ]
        )
    )
    def measure(name: str, item: Column, time: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric"), item.alias("item"), time.alias("item_time")
        )

    # the product is both a factor and a measure
    no_time = F.lit(None).cast(visited.schema["time"].dataType)
    measures = F.inline(
        F.array(
            *[measure(n, F.col(c).cast("string"), no_time) for n, c in COUNTED.items()],
            measure("time", F.lit(None).cast("string"), F.col("time")),
        )
    )
    kept = ["browser", *COUNTED.values(), "time"]
    return (
        visited.select(*kept, values)
        .select("browser", *FACTOR, measures)
        .groupBy("browser", *FACTOR, "metric", "item")
        .agg(F.sum("item_time").alias("item_time"))
        .groupBy("browser", *FACTOR)
        .agg(
            *[
                F.count(F.when(F.col("metric") == name, F.col("item"))).alias(name)
                for name in COUNTED
            ],
            F.sum("item_time").alias("time"),
        )
    )


def browser_metrics(
    df: DataFrame,
    factors: Sequence[Factor] = EXPLORE_FACTORS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Products, time, pages and sessions per browser and factor value.

    The log is dealt by browser once, with the columns in question only. All that
    follows, from the sums to the distinct counts, keeps a browser together, so
    rows are multiplied by the factors in the task that reads them and none of
    the copies is shuffled. Rows of hot browsers, and those without a browser,
    are summed and counted by their other columns too, which spreads them.
    A task takes about ``TASK_ROWS`` rows, however many there are.
    """
    hot = hot or hot_keys(df)
    kept = ["browser", *COUNTED.values(), "time", *[f.column for f in factors]]
    log = df.select(*dict.fromkeys(kept))
    small, large = split_hot(log, hot)
    without = log.filter(F.col("browser").isNull())
    large = without if large is None else large.unionByName(without)
    known = None if hot.rows is None else hot.rows - hot.apart
    dealt = _dealt(small.filter(F.col("browser").isNotNull()), known, "browser")
    visited = [_visited(part, factors) for part in (dealt, large)]
    if (hot.apart or 0) > TASK_ROWS:
        visited[1] = _dealt(visited[1], hot.apart, *visited[1].columns[:-1])
    counted = [_per_browser(part, factors) for part in visited]
    return (
        counted[0]
        .unionByName(counted[1])
        .withColumn("browser_count", F.col("browser").isNotNull().cast("bigint"))
        .select(*FACTOR, "browser", *METRICS)
    )


def factor_metrics(
    df: DataFrame,
    factors: Sequence[Factor] = EXPLORE_FACTORS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The browser metrics added up per factor value."""
    known = df.filter(F.col("browser").isNotNull())
    return (
        browser_metrics(known, factors, hot)
        .dropna(subset=["factor_value"])
        .groupBy(*FACTOR)
        .agg(*[F.sum(name).alias(name) for name in METRICS])
    )


def explore_table(
    df: DataFrame,
    factors: Sequence[Factor] = EXPLORE_FACTORS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """One row per KPI, factor and factor value, with all metrics beside it."""
    browsers = F.col("browser_count")
    metrics = factor_metrics(df, factors, hot).withColumns(
        {
            "reach": browsers.cast("double"),
            "use": F.col("time") / browsers,
            "breadth": F.col("product_count") / browsers,
        }
    )
    metrics = metrics.withColumn("breadth_kpi", F.col("breadth"))
    return metrics.unpivot(
        [*FACTOR, "breadth_kpi", *METRICS],
        ["reach", "use", "breadth"],
        "kpi_filter",
        "kpi_value",
    ).select(
        "kpi_filter",
        "kpi_value",
        F.col("factor").alias("chart"),
        F.col("factor_value").alias("breakdown"),
        "breadth_kpi",
        *METRICS,
    )
