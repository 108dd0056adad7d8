"""Reach, use and breadth by factor, and by product and factor.

All operators work on *cells*: the log unpivoted over the factors and summed to
one row per (browser, product, factor, factor value). The cells take one scan
and one combined shuffle for all factors together; what follows are small
aggregates of them. Operators accept the log, or cells made before of the
factors in question, so a caller with several charts can write the cells once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.operators.kpi import (
    product_cells,
    product_reach,
    products_per_browser,
)
from clicklens.operators.skew import (
    HotKeys,
    hot_keys,
    salted_join,
    with_group_values,
)
from clicklens.schema import FACTORS, HIGHLIGHTS, KPI_LABELS, Factor

FACTOR = ["factor", "factor_value"]


def by_factor(
    df: DataFrame, factors: Sequence[Factor], keep: Sequence[str]
) -> DataFrame:
    """One row per row and factor: ``keep``, ``factor``, ``factor_value``."""
    labels = [f.label for f in factors]
    values = [F.col(f.column).cast("string").alias(f.label) for f in factors]
    return df.select(*keep, *values).unpivot(list(keep), labels, *FACTOR)


def factor_cells(df: DataFrame, factors: Sequence[Factor] = FACTORS) -> DataFrame:
    """Time per (browser, product, factor, factor value); each cell once."""
    return (
        by_factor(df, factors, ["browser", "virtual_site", "time"])
        .groupBy("browser", "virtual_site", *FACTOR)
        .agg(F.sum("time").alias("time"))
    )


def _are_cells(df: DataFrame) -> bool:
    """Whether a frame is of cells; a log may have a column of one such name."""
    return set(FACTOR) <= set(df.columns)


def _cells(df: DataFrame, factors: Sequence[Factor]) -> DataFrame:
    if not _are_cells(df):
        return factor_cells(df, factors)
    return df.filter(F.col("factor").isin([f.label for f in factors]))


def _one_pass(df: DataFrame, factors: Sequence[Factor]) -> DataFrame:
    """The log, or the cells of one factor: they hold every row once."""
    if _are_cells(df):
        return df.filter(F.col("factor") == factors[0].label)
    return df


def factor_browsers(df: DataFrame, factors: Sequence[Factor] = FACTORS) -> DataFrame:
    """Time per (browser, factor, factor value)."""
    return _cells(df, factors).groupBy("browser", *FACTOR).agg(
        F.sum("time").alias("time")
    )


def factor_total_reach(
    df: DataFrame, factors: Sequence[Factor] = FACTORS
) -> DataFrame:
    """Browsers per factor value."""
    return (
        factor_browsers(df, factors)
        .groupBy(*FACTOR)
        .agg(F.count("browser").alias("browser_count"))
    )


def factor_total_use(df: DataFrame, factors: Sequence[Factor] = FACTORS) -> DataFrame:
    """Average time of a browser per factor value."""
    return (
        factor_browsers(df, factors).groupBy(*FACTOR).agg(F.avg("time").alias("time"))
    )


def factor_total_breadth(
    df: DataFrame, factors: Sequence[Factor] = FACTORS, hot: HotKeys | None = None
) -> DataFrame:
    """Products of the browsers of a factor value, summed, and these browsers.

    A browser brings all its products, not just those under the factor value.
    """
    browsers = factor_browsers(df, factors).filter(F.col("browser").isNotNull())
    return (
        salted_join(
            browsers.select("browser", *FACTOR),
            products_per_browser(_one_pass(df, factors)),
            ["browser"],
            hot or hot_keys(df),
        )
        .groupBy(*FACTOR)
        .agg(
            F.sum("product_count").alias("product_count"),
            F.count(F.lit(1)).alias("browsers"),
        )
    )


def factor_reach(df: DataFrame, factors: Sequence[Factor] = FACTORS) -> DataFrame:
    """Browsers per product and factor value, beside those of the product and
    those of the factor value."""
    reach = (
        _cells(df, factors)
        .dropna(subset=["virtual_site", "factor_value"])
        .groupBy("virtual_site", *FACTOR)
        .agg(F.count("browser").alias("value"))
    )
    of_product = product_reach(_one_pass(df, factors)).withColumnRenamed(
        "browser_count", "total_browsers"
    )
    of_factor = factor_total_reach(df, factors).withColumnRenamed(
        "browser_count", "overall_value"
    )
    return _chart_rows(
        reach.join(of_product, "virtual_site").join(of_factor, FACTOR), "reach"
    )


def factor_use(df: DataFrame, factors: Sequence[Factor] = FACTORS) -> DataFrame:
    """Average time of a browser per product and factor value."""
    use = (
        _cells(df, factors)
        .dropna(subset=["factor_value"])
        .groupBy("virtual_site", *FACTOR)
        .agg(F.avg("time").alias("value"))
    )
    of_factor = factor_total_use(df, factors).withColumnRenamed("time", "overall_value")
    return _chart_rows(use.join(of_factor, FACTOR), "use")


def factor_breadth(
    df: DataFrame,
    factors: Sequence[Factor] = FACTORS,
    exact_ratio: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Average number of products that the browsers of a product visit under the
    same factor value.

    The overall value is a whole number, as the charts have it; with
    ``exact_ratio`` it is not cut off.
    """
    hot = hot or hot_keys(df)
    cells = (
        _cells(df, factors)
        .dropna(subset=["browser", *FACTOR])
        .select("browser", "virtual_site", *FACTOR)
    )
    counted = with_group_values(
        cells, ["browser", *FACTOR], {"products": F.count(F.lit(1))}, hot
    )
    breadth = counted.groupBy("virtual_site", *FACTOR).agg(
        (F.sum("products") / F.count(F.lit(1))).alias("value")
    )
    ratio = F.col("product_count") / F.col("browsers")
    overall = factor_total_breadth(df, factors, hot).select(
        *FACTOR, (ratio if exact_ratio else F.floor(ratio)).alias("overall_value")
    )
    return _chart_rows(breadth.join(overall, FACTOR), "breadth")


def _chart_rows(df: DataFrame, kpi: str) -> DataFrame:
    total = F.col("total_browsers") if "total_browsers" in df.columns else F.lit(None)
    return df.select(
        F.lit(kpi).alias("kpi_filter"),
        F.col("factor").alias("chart_label"),
        F.col("virtual_site").alias("breakdown"),
        F.col("factor_value").alias("chart_breakdown"),
        F.col("value").cast("double").alias("value"),
        total.cast("bigint").alias("total_browsers"),
        F.col("overall_value").cast("double").alias("overall_value"),
    )


def factor_totals(
    df: DataFrame,
    factors: Sequence[Factor] = FACTORS,
    products: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """All three overall KPIs per factor value in one pass.

    ``products`` are product cells of the log, if there are any already.
    """
    if products is None:
        products = product_cells(_one_pass(df, factors))
    counted = salted_join(
        factor_browsers(df, factors),
        products_per_browser(products),
        ["browser"],
        hot or hot_keys(df),
        "left",
    )
    browsers = F.count("browser")
    return counted.groupBy(*FACTOR).agg(
        browsers.alias("total_reach"),
        F.avg("time").alias("total_use"),
        F.floor(F.sum("product_count") / F.nullif(browsers, F.lit(0))).alias(
            "total_breadth"
        ),
    )


def factor_table(
    df: DataFrame,
    factors: Sequence[Factor] = FACTORS,
    products: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """All KPIs of the factors in chart form.

    One aggregate of the cells gives the three KPIs of a product and factor
    value side by side; they are turned into rows at the end.
    """
    hot = hot or hot_keys(df)
    if products is None:
        products = product_cells(_one_pass(df, factors))
    counted = with_group_values(
        _cells(df, factors).dropna(subset=FACTOR),
        ["browser", *FACTOR],
        {"products": F.count(F.lit(1))},
        hot,
    )
    browsers = F.count("browser")
    wide = (
        counted.groupBy("virtual_site", *FACTOR)
        .agg(
            browsers.alias("reach"),
            F.avg("time").alias("use"),
            (F.sum("products") / F.nullif(browsers, F.lit(0))).alias("breadth"),
        )
        .join(
            product_reach(products).withColumnRenamed("browser_count", "browsers"),
            "virtual_site",
            "left",
        )
        .join(factor_totals(df, factors, products, hot), FACTOR)
    )
    # a missing product has no reach, and where no browser is known no breadth
    present = {
        "reach": F.col("virtual_site").isNotNull(),
        "use": F.lit(True),
        "breadth": F.col("breadth").isNotNull(),
    }
    no_total = F.lit(None).cast("bigint")
    totals = {"reach": F.col("browsers"), "use": no_total, "breadth": no_total}
    kpis = F.array(
        *[
            F.struct(
                F.lit(kpi).alias("kpi_filter"),
                F.col(kpi).cast("double").alias("value"),
                totals[kpi].alias("total_browsers"),
                F.col(f"total_{kpi}").cast("double").alias("overall_value"),
                present[kpi].alias("present"),
            )
            for kpi in KPI_LABELS
        ]
    )
    chart = F.lit(None).cast("string")
    for factor in factors:
        chart = F.when(F.col("factor") == factor.label, factor.chart).otherwise(chart)
    rows = wide.select("virtual_site", *FACTOR, chart.alias("chart"), F.inline(kpis))
    return rows.filter("present").select(
        "chart",
        F.col("factor").alias("subchart"),
        F.col("chart").alias("hlt_filter"),
        "kpi_filter",
        F.col("factor").alias("chart_label"),
        F.col("virtual_site").alias("breakdown"),
        F.col("factor_value").alias("chart_breakdown"),
        "value",
        "total_browsers",
        "overall_value",
    )


def highlight_rows(spark: SparkSession) -> DataFrame:
    """The three rows of the chart selector."""
    names = ("hlt_filter", "chart_label", "chart_breakdown")
    rows = [
        F.struct(*[F.lit(x).alias(n) for n, x in zip(names, row)])
        for row in HIGHLIGHTS
    ]
    return spark.range(1).select(F.inline(F.array(*rows))).select(
        F.lit("hlt").alias("chart"), F.lit("hlt").alias("subchart"), *names
    )


def with_region_hex(dashboard: DataFrame, hexes: DataFrame) -> DataFrame:
    """Every row with the map position of its factor value, if it has one.

    The lookup is joined without a hint: Spark broadcasts it when its size is
    known to be small and shuffles otherwise.
    """
    return dashboard.join(
        hexes, dashboard["chart_breakdown"] == hexes["Region"], "left"
    )
