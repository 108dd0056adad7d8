"""Column names, types and fixed labels shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The raw log is read as text (ids aside): damaged rows hold values of a
# neighbouring column, and damaged timestamps are not numbers.
RAW_CLICKS = T.StructType(
    [T.StructField("v1", T.LongType())]
    + [
        T.StructField(name, T.StringType())
        for name in (
            "browser",
            "ts_raw",
            "day",
            "hour",
            "entry_type",
            "page",
            "page_url",
            "previous_page",
            "virtual_site",
            "region",
            "platform",
            "application_type",
        )
    ]
)

REGION_HEX = T.StructType(
    [
        T.StructField("Region", T.StringType()),
        T.StructField("lat_bin", T.DoubleType()),
        T.StructField("long_bin", T.DoubleType()),
    ]
)

ENHANCED_COLUMNS = [
    "v1",
    "browser",
    "ts",
    "first_page",
    "session",
    "exit_page",
    "day",
    "hour",
    "entry_type",
    "page",
    "page_url",
    "previous_page",
    "virtual_site",
    "region",
    "platform",
    "application_type",
    "time",
]

DASHBOARD_COLUMNS = [
    "chart",
    "subchart",
    "hlt_filter",
    "kpi_filter",
    "chart_label",
    "breakdown",
    "chart_breakdown",
    "value",
    "total_browsers",
    "overall_value",
]


@dataclass(frozen=True)
class Factor:
    """A column the charts break the KPIs down by, and the chart it is on."""

    label: str
    column: str
    chart: str | None = None


# Factor labels and the chart each factor belongs to.
FACTORS = (
    Factor("entry", "entry_type", "how"),
    Factor("hour", "hour", "when"),
    Factor("region", "region", "who"),
    Factor("platform", "platform", "how"),
    Factor("application", "application_type", "how"),
)
PRODUCT = Factor("product", "virtual_site")
EXPLORE_FACTORS = (*FACTORS[:2], PRODUCT, *FACTORS[2:])

# KPI labels.
KPI_LABELS = {
    "reach": "Reach: total unique browsers",
    "use": "Use: total time spent",
    "breadth": "Breadth: average amount of products visited",
}

# Rows of the chart selector (filter, label, sort letter).
HIGHLIGHTS = (("who", "Who", "A"), ("how", "How", "B"), ("when", "When", "C"))
