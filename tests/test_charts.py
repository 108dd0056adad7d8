from __future__ import annotations

import random
from collections import defaultdict

import pytest

from clicklens.operators import explore, factors, kpi
from clicklens.schema import EXPLORE_FACTORS, FACTORS

SCHEMA = (
    "browser string, virtual_site string, entry_type string, hour int, region string, "
    "platform string, application_type string, page_url string, session int, time double"
)
REGION = [f for f in FACTORS if f.label == "region"]


def log(seed: int = 3, rows: int = 200) -> list[tuple]:
    rng = random.Random(seed)
    return [
        (
            rng.choice(["hot", "hot", "hot", "a", "b", None]),
            rng.choice(["news", "sport", "radio", "tv", None]),
            rng.choice(["direct", "search"]),
            rng.choice([7, 8, 9]),
            rng.choice(["kent", "devon", None]),
            rng.choice(["web", "mobile"]),
            rng.choice(["app", "responsive"]),
            rng.choice(["/1", "/2", "/3"]),
            rng.randrange(3),
            float(rng.randrange(100)),
        )
        for _ in range(rows)
    ]


@pytest.fixture
def clicks(spark):
    return spark.createDataFrame(log(), SCHEMA)


def mean(values):
    values = list(values)
    return sum(values) / len(values)


def test_kpis_treat_missing_browsers_as_one_browser(clicks):
    times, products = defaultdict(float), defaultdict(set)
    for row in log():
        times[row[0]] += row[9]
        products[row[0]] |= {row[1]} - {None}
    got = {r.kpi_filter: r.value for r in kpi.kpi_table(clicks).collect()}
    assert got == {
        "reach": 4.0,
        "use": pytest.approx(mean(times.values())),
        "breadth": pytest.approx(mean(len(p) for p in products.values())),
    }
    assert kpi.kpi_reach(clicks).first().reach == 4


def test_product_breadth_counts_all_products_of_its_browsers(clicks, groups):
    products = defaultdict(set)
    for row in log():
        if row[0] is not None:
            products[row[0]].add(row[1])
    sites = {site for s in products.values() for site in s}
    expected = {
        site: mean(len(s) for s in products.values() if site in s) for site in sites
    }
    got = {r.virtual_site: r.breadth for r in kpi.product_breadth(clicks).collect()}
    assert got == pytest.approx(expected)


def test_factor_breadth_and_its_whole_overall_value(clicks, groups):
    within, over_all, seen = defaultdict(set), defaultdict(set), defaultdict(set)
    for row in log():
        browser, site, region = row[0], row[1], row[4]
        if browser is None:
            continue
        over_all[browser].add(site)
        if region is not None:
            within[browser, region].add(site)
            seen[region].add(browser)
    got = {
        (r.breakdown, r.chart_breakdown): (r.value, r.overall_value)
        for r in factors.factor_breadth(clicks, REGION).collect()
    }
    keys = {(site, region) for (_, region), sites in within.items() for site in sites}
    assert set(got) == keys
    for site, region in keys:
        sizes = [len(s) for (_, r), s in within.items() if r == region and site in s]
        whole = sum(len(over_all[b]) for b in seen[region]) // len(seen[region])
        assert got[site, region] == (pytest.approx(mean(sizes)), whole)


def test_factor_reach_leaves_out_missing_products_and_values(clicks):
    rows = factors.factor_reach(clicks, REGION).collect()
    assert rows and all(r.breakdown and r.chart_breakdown for r in rows)
    for row in rows:
        browsers = {
            r[0] for r in log() if (r[1], r[4]) == (row.breakdown, row.chart_breakdown)
        } - {None}
        assert row.value == len(browsers)
        assert row.total_browsers == len({r[0] for r in log() if r[1] == row.breakdown} - {None})


def test_factor_use_keeps_missing_products(clicks):
    rows = factors.factor_use(clicks, REGION).collect()
    assert any(r.breakdown is None for r in rows)
    assert all(r.chart_breakdown is not None for r in rows)


def test_operators_give_the_same_on_cells(clicks):
    cells = factors.factor_cells(clicks)
    direct = factors.factor_table(clicks).collect()
    assert sorted(direct, key=repr) == sorted(factors.factor_table(cells).collect(), key=repr)


def test_the_factor_table_stacks_the_single_operators(clicks, groups):
    single = (
        factors.factor_reach(clicks)
        .unionByName(factors.factor_use(clicks))
        .unionByName(factors.factor_breadth(clicks))
    )
    table = factors.factor_table(clicks)
    assert sorted(table.select(*single.columns).collect(), key=repr) == sorted(
        single.collect(), key=repr
    )


def test_a_product_without_known_browsers_has_no_breadth(spark):
    clicks = spark.createDataFrame([(None, "tv", *log()[0][2:])], SCHEMA)
    got = {(r.kpi_filter, r.value) for r in kpi.product_table(clicks).collect()}
    assert got == {("reach", 0.0), ("use", log()[0][9])}
    rows = factors.factor_table(clicks, REGION).collect()
    assert {r.kpi_filter for r in rows} == ({"reach", "use"} if log()[0][4] else set())


def test_reach_of_products_is_at_least_the_overall_reach(clicks):
    total = sum(r.browser_count for r in kpi.product_reach(clicks).collect())
    assert total >= kpi.kpi_reach(clicks).first().reach - 1


def test_explore_adds_up_browser_metrics(clicks):
    sums = defaultdict(lambda: [0, 0.0, 0, 0, 0])
    for r in explore.browser_metrics(clicks).collect():
        if r.browser is not None and r.factor_value is not None:
            for i, name in enumerate(explore.METRICS):
                sums[r.factor, r.factor_value][i] += r[name]
    got = {
        (r.factor, r.factor_value): [r[name] for name in explore.METRICS]
        for r in explore.factor_metrics(clicks).collect()
    }
    assert got == dict(sums)


def test_explore_products_agree_with_the_product_chart(spark):
    rows = [r for r in log() if r[0] is not None and r[1] is not None]
    clicks = spark.createDataFrame(rows, SCHEMA)
    product = [f for f in EXPLORE_FACTORS if f.label == "product"]
    explored = {
        (r.kpi_filter, r.breakdown): r.kpi_value
        for r in explore.explore_table(clicks, product).collect()
        if r.kpi_filter != "breadth"
    }
    charted = {
        (r.kpi_filter, r.breakdown): r.value
        for r in kpi.product_table(clicks).collect()
        if r.kpi_filter != "breadth"
    }
    assert explored == pytest.approx(charted)
