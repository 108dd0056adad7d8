from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clicklens.functions import expand_sci_text
from clicklens.operators import repair
from clicklens.schema import RAW_CLICKS


@pytest.mark.parametrize(
    ("text", "expanded"),
    [
        ("1,40465e+12", "1404650000000"),
        ("1,404e+12", "1404000000000"),
        ("14046500001234e+2", "14046500001234"),
        ("1E+12", None),
        ("1404650000000", None),
        ("1e+x", None),
        ("1e", None),
        ("1e+309", "1" + "0" * 309),
        ("1,4e+400", "14" + "0" * 399),
        ("1e+99999999999", None),
        (None, None),
    ],
)
def test_expand_sci_text(spark, text, expanded):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(expand_sci_text(F.col("t"))).first()[0] == expanded


def raw(spark, *rows):
    """Rows from (v1, ts, url, previous, site, region, platform, application)."""
    return spark.createDataFrame(
        [(r[0], "b", r[1], "2014-07-06", "9", "direct", "p", *r[2:]) for r in rows],
        RAW_CLICKS,
    )


def test_shifted_rows_are_realigned(spark):
    rows = repair.repair_clicks(
        raw(
            spark,
            (1, "1,404e+12", 'a"", prev. page', '"si\\te|', "kent", "web", "app", "1"),
            (2, "5", "a", '"site"', "kent", "web", "app", "1"),
            (3, "5", 'a""', None, "kent", "web", "app", "1"),
            (4, "5", 'a""b', "prev", "site", "kent", "web", "app"),
        )
    ).collect()
    got = {
        r.v1: (r.page_url, r.previous_page, r.virtual_site, r.region, r.platform,
               r.application_type, r.is_shifted)
        for r in rows
    }
    assert got == {
        1: ('a"', ",prev.page", "site", "kent", "web", "app", True),
        2: (None, None, "site", "kent", "web", "app", True),
        3: ('a"', "", None, "kent", "web", "app", True),
        4: ('a""b', "prev", "site", "kent", "web", "app", False),
    }
    assert {r.v1: r.ts for r in rows} == {1: 1_404_000_000_000, 2: 5, 3: 5, 4: 5}


def test_rows_without_application_are_dropped_and_counted(spark):
    log = raw(
        spark,
        (1, "1e+3", "u", "p", "s", "r", "x", None),
        (2, "7", "u", "p", "s", "r", "x", "1"),
        (3, "7", "u", "p", "s", "r", "x", "web"),
    )
    assert {r.v1 for r in repair.repair_clicks(log).collect()} == {2, 3}
    assert repair.repair_report(log).first() == (3, 1, 1, 1)


def test_unreadable_numbers_become_null(spark):
    row = repair.repair_clicks(raw(spark, (1, "n/a", "u", "p", "s", "r", "x", "web"))).first()
    assert row.ts is None and row.hour == 9


@pytest.mark.parametrize(
    ("text", "number"),
    [("9e+18", 9 * 10**18), ("9,3e+18", None), ("1e+999999999", None), ("0e+400", 0),
     ("1e+2147483647", None), ("12345e+2", 12345), ("1,4e+12", 1_400_000_000_000)],
)
def test_long_numbers_are_never_written_out(spark, text, number):
    row = repair.repair_clicks(raw(spark, (1, text, "u", "p", "s", "r", "x", "web"))).first()
    assert row.ts == number


def test_repair_is_a_single_pass(spark):
    log = raw(spark, (1, "1", "u", "p", "s", "r", "x", "web"))
    plan = repair.repair_clicks(log)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Union" not in plan
