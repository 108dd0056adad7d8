"""The dashboard and explore extracts of an enhanced log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.operators.explore import explore_table
from clicklens.operators.factors import (
    factor_cells,
    factor_table,
    highlight_rows,
    with_region_hex,
)
from clicklens.operators.kpi import kpi_table, product_cells, product_table
from clicklens.operators.skew import HotKeys, hot_keys
from clicklens.schema import DASHBOARD_COLUMNS, FACTORS, Factor
from clicklens.sources.clicks import read_region_lookup
from clicklens.sources.tables import job, read_enhanced, stage, write_extract


def dashboard_long(
    enhanced: DataFrame,
    factors: Sequence[Factor] = FACTORS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """All charts of the dashboard in one long table.

    Two staged tables serve every chart: the factor cells, for which the log is
    passed over once, and the product cells made from those of one factor. Hot
    browsers are counted once, from the cells of one factor, unless given.
    """
    cells = stage(factor_cells(enhanced, factors), sort_by="factor")
    products = stage(product_cells(cells.filter(F.col("factor") == factors[0].label)))
    hot = hot or hot_keys(products)
    charts = [
        kpi_table(products),
        product_table(products, hot),
        factor_table(cells, factors, products, hot),
        highlight_rows(enhanced.sparkSession),
    ]
    stacked = charts[0]
    for chart in charts[1:]:
        stacked = stacked.unionByName(chart, allowMissingColumns=True)
    return stacked.select(*DASHBOARD_COLUMNS)


def dashboard_with_hex(
    enhanced: DataFrame, hexes: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """The dashboard table with map positions."""
    return with_region_hex(dashboard_long(enhanced, hot=hot), hexes)


def run_charts(
    spark: SparkSession,
    enhanced_path: str,
    hexes_path: str,
    dashboard_path: str,
    explore_path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
) -> None:
    """Writes both extracts of an enhanced log."""
    enhanced = read_enhanced(spark, enhanced_path)
    hexes = read_region_lookup(spark, hexes_path)
    with job(spark):
        hot = hot_keys(enhanced)
        write_extract(dashboard_with_hex(enhanced, hexes, hot), dashboard_path, fmt, mode)
        write_extract(explore_table(enhanced, hot=hot), explore_path, fmt, mode)
