"""Reach, use and breadth, overall and by product.

Reach counts browsers, use averages the time of a browser, breadth averages
the products of a browser. Every operator here takes the enhanced log, or
``product_cells`` made of it: sums of sums and distinct counts come out the
same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.operators.skew import HotKeys, hot_keys, with_group_values
from clicklens.schema import KPI_LABELS


def _overall(df: DataFrame) -> DataFrame:
    """All three KPIs in one row; rows without a browser count as one browser."""
    browsers = df.groupBy("browser").agg(
        F.sum("time").alias("time"),
        F.count_distinct("virtual_site").alias("products"),
    )
    return browsers.agg(
        F.count(F.lit(1)).alias("reach"),
        F.avg("time").alias("use"),
        F.avg("products").alias("breadth"),
    )


def kpi_reach(df: DataFrame) -> DataFrame:
    """Number of browsers."""
    return _overall(df).select("reach")


def kpi_use(df: DataFrame) -> DataFrame:
    """Average time per browser."""
    return _overall(df).select("use")


def kpi_breadth(df: DataFrame) -> DataFrame:
    """Average number of (named) products per browser."""
    return _overall(df).select("breadth")


def kpi_table(df: DataFrame) -> DataFrame:
    """One row per KPI with its label, from a single aggregation."""
    wide = _overall(df).select(*[F.col(k).cast("double") for k in KPI_LABELS])
    labels = F.create_map(*[F.lit(x) for pair in KPI_LABELS.items() for x in pair])
    return wide.unpivot([], list(KPI_LABELS), "kpi_filter", "value").select(
        F.lit("kpis").alias("chart"),
        F.lit("kpis").alias("subchart"),
        F.lit(None).cast("string").alias("hlt_filter"),
        "kpi_filter",
        labels[F.col("kpi_filter")].alias("chart_label"),
        F.lit(None).cast("string").alias("breakdown"),
        "value",
    )


def product_cells(df: DataFrame) -> DataFrame:
    """Time per (browser, product); each cell once."""
    return df.groupBy("browser", "virtual_site").agg(F.sum("time").alias("time"))


def browser_products(df: DataFrame) -> DataFrame:
    """Each browser with each of its products (NULL included) once."""
    return (
        df.select("browser", "virtual_site")
        .distinct()
        .withColumn("product_count", F.lit(1).cast("bigint"))
    )


def products_per_browser(df: DataFrame) -> DataFrame:
    """How many products each known browser has, NULL counted as a product."""
    return (
        browser_products(df.filter(F.col("browser").isNotNull()))
        .groupBy("browser")
        .agg(F.count(F.lit(1)).alias("product_count"))
    )


def reach_sketches(
    df: DataFrame, by: Sequence[str] = ("day", "virtual_site"), lg_k: int = 12
) -> DataFrame:
    """A HyperLogLog sketch of the browsers of each group, for sums of reach over
    days, products or factor values without another pass over the log.

    Sketches have ``2**lg_k`` registers at most, whatever the group's size, and
    ``merge_reach`` adds them up; the relative error of an estimate stays below
    ``reach_error(lg_k)`` for 99.7 of 100 groups.
    """
    return df.groupBy(*by).agg(
        F.hll_sketch_agg(F.col("browser"), F.lit(lg_k)).alias("browsers")
    )


def merge_reach(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Estimated reach of groups of sketches; of all of them without ``by``."""
    union = F.hll_union_agg("browsers")
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(union).alias("reach_estimate")
    )


def reach_error(lg_k: int = 12) -> float:
    """Three standard errors of an estimate, as a share of the reach."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def product_reach(df: DataFrame) -> DataFrame:
    """Browsers per product."""
    return (
        browser_products(df)
        .groupBy("virtual_site")
        .agg(F.count("browser").alias("browser_count"))
    )


def product_use(df: DataFrame) -> DataFrame:
    """Average time a browser of the product spends on it."""
    return product_cells(df).groupBy("virtual_site").agg(F.avg("time").alias("time"))


def product_breadth(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Average number of products, the product itself included, that the
    browsers of a product visit.

    Counting the products of a browser once replaces pairing them all.
    """
    pairs = browser_products(df.filter(F.col("browser").isNotNull()))
    counted = with_group_values(
        pairs.drop("product_count"),
        ["browser"],
        {"products": F.count(F.lit(1))},
        hot or hot_keys(df),
    )
    return counted.groupBy("virtual_site").agg(
        (F.sum("products") / F.count(F.lit(1))).alias("breadth")
    )


def product_table(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """All product KPIs in chart form, from one aggregate of product cells."""
    counted = with_group_values(
        product_cells(df),
        ["browser"],
        {"products": F.count(F.lit(1))},
        hot or hot_keys(df),
    )
    browsers = F.count("browser")
    wide = counted.groupBy("virtual_site").agg(
        browsers.cast("double").alias("reach"),
        F.avg("time").alias("use"),
        (F.sum("products") / F.nullif(browsers, F.lit(0))).alias("breadth"),
    )
    rows = wide.unpivot(["virtual_site"], list(KPI_LABELS), "kpi_filter", "value")
    # without a known browser a product has no breadth
    return rows.filter(F.col("value").isNotNull()).select(
        F.lit("product").alias("chart"),
        F.lit("product").alias("subchart"),
        F.lit(None).cast("string").alias("hlt_filter"),
        "kpi_filter",
        F.lit("product").alias("chart_label"),
        F.col("virtual_site").alias("breakdown"),
        "value",
    )
