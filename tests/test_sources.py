from __future__ import annotations

import pytest

from clicklens.plans.charts import run_charts
from clicklens.plans.enhance import run_enhance
from clicklens.schema import DASHBOARD_COLUMNS, ENHANCED_COLUMNS
from clicklens.sources import clicks, tables

HEADER = (
    "V1,Browsers,UTC.timestamp,Day,Hour,Entry.type,Page,Page.URL,Previous.page,"
    "Virtual.site,Region,Platform,Application.type"
)
LINES = [
    "1,b1,1404600000000,2014-07-06,1,direct,home,/a,NA,news,kent,web,responsive",
    '2,b1,1404600010000,2014-07-06,1,direct,home,/b,"",news,kent,web,responsive',
    "3,b1,1404600030000,2014-07-06,1,direct,home,/c,home,sport,kent,web,responsive",
    "4,b2,1404600000000,2014-07-06,2,search,home,/a,,news,,web,app",
    "5,b2,1404600005000,2014-07-06,2,search",
    "6,b3,1404600005000,2014-07-06,3,search,home,/a,home,news,none,web,app,surplus",
]


@pytest.fixture
def log_path(tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(path)


def test_reading_csv(spark, log_path):
    rows = {r.v1: r for r in clicks.read_clicks(spark, log_path).collect()}
    assert len(rows) == 6
    assert rows[1].previous_page is None  # NA
    assert rows[2].previous_page == ""  # quoted empty text
    assert rows[4].previous_page is None and rows[4].region is None  # blank
    assert rows[5].page is None and rows[5].application_type is None  # short row
    assert rows[6].application_type == "app"  # long row


def test_ragged_rows_are_reported(spark, log_path):
    ragged = clicks.read_ragged_rows(spark, log_path)
    assert sorted(r.line for r in ragged.collect()) == [LINES[4], LINES[5]]


def test_jobs_end_to_end(spark, tmp_path, log_path):
    enhanced_path, dashboard, explore = (
        str(tmp_path / name) for name in ("enhanced", "dashboard", "explore")
    )
    run_enhance(spark, log_path, enhanced_path)
    enhanced = tables.read_enhanced(spark, enhanced_path)
    assert enhanced.columns == ENHANCED_COLUMNS
    assert {r.day for r in enhanced.collect()} == {"2014-07-06"}
    rows = {r.v1: r for r in enhanced.collect()}
    # row 5 has no application type; 10 s and 20 s are measured, the rest imputed
    assert {v1: r.time for v1, r in rows.items()} == {
        1: 10_000.0, 2: 20_000.0, 3: 15_000.0, 4: 15_000.0, 6: 15_000.0
    }
    assert {v1: r.session for v1, r in rows.items()} == {1: 1, 2: 1, 3: 1, 4: 1, 6: 0}

    hexes = tmp_path / "hexes.csv"
    hexes.write_text("Region,lat_bin,long_bin\nkent,51.2,0.5\nnone,0,0\nweb,9,9\n")
    run_charts(spark, enhanced_path, str(hexes), dashboard, explore, fmt="csv")
    board = spark.read.option("header", True).csv(dashboard)
    assert board.columns == [*DASHBOARD_COLUMNS, "Region", "lat_bin", "long_bin"]
    placed = {r.chart_breakdown for r in board.collect() if r.Region is not None}
    assert placed == {"kent", "none", "web"}
    assert spark.read.option("header", True).csv(explore).count() > 0


def test_days_come_back_as_they_were(spark, tmp_path):
    days = ["06", "", None, "2014-07-06", "a/b=c"]
    row = dict.fromkeys(ENHANCED_COLUMNS)
    schema = ", ".join(f"{c} {'bigint' if c == 'v1' else 'string'}" for c in ENHANCED_COLUMNS)
    rows = [tuple((row | {"v1": i, "day": d}).values()) for i, d in enumerate(days)]
    path = str(tmp_path / "days")
    tables.write_enhanced(spark.createDataFrame(rows, schema), path)
    back = tables.read_enhanced(spark, path)
    assert {r.v1: r.day for r in back.collect()} == dict(enumerate(days))
    assert back.columns == ENHANCED_COLUMNS and dict(back.dtypes)["day"] == "string"


def parsed(spark, *ends):
    """The last columns of lines that end so."""
    start = "7,b,1,2014-07-06,1,direct,home,"
    lines = spark.createDataFrame([(start + end,) for end in ends], "line string")
    return [tuple(r)[7:] for r in clicks.parse_lines(lines).collect()]


def test_quotes_and_backslashes_in_lines(spark):
    assert parsed(
        spark,
        '"http://x/a"", prev. page",site_1|,wales,mobile,app,1',
        '"http://x/""q"" b",p,s,r,x,web',
        '"http://x/c\\",p,s,r,x,web',
        'a\\,"NA",NA,"","x,y",web',
        'u,"stray,s,r,x,web',
    ) == [
        ('http://x/a"", prev. page', "site_1|", "wales", "mobile", "app", "1"),
        ('http://x/""q"" b', "p", "s", "r", "x", "web"),
        ("http://x/c\\", "p", "s", "r", "x", "web"),
        ("a\\", "NA", None, "", "x,y", "web"),
        ("u", '"stray', "s", "r", "x", "web"),
    ]


def test_a_job_leaves_nothing_staged(spark, tmp_path, log_path, monkeypatch):
    folder = tmp_path / "shared"
    monkeypatch.setattr(tables, "stage_folder", lambda _: str(folder))
    run_enhance(spark, log_path, str(tmp_path / "out"))
    assert not list((folder / "clicklens").iterdir())


def test_without_a_shared_folder_nothing_is_staged(spark, monkeypatch):
    monkeypatch.setattr(tables, "stage_folder", lambda _: None)
    df = spark.range(3)
    assert tables.stage(df) is df


def test_stage_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, p string")
    staged = tables.stage(df)
    assert sorted(map(tuple, staged.collect()), key=repr) == [(1, "a"), (2, None)]
    assert staged.schema.simpleString() == df.schema.simpleString()


BROKEN = [
    "v1,browser,ts,day,hour,entry,page,url,previous,site,region,platform,app",
    '1,b1,1,d,1,e,"page with',
    'two, ""breaks""',
    'and a comma",/u,p,s,r,pl,web',
    '2,b1,2,d,1,e,page,/u,p,"stray|,r,pl,web',
    "3,b2,3,d,1,e,page,/u,p,s,r,pl,web",
    '4,b2,4,d,1,e,"opened',
    'here",/u,"and ',
    'again",s,r,pl,web',
    '5,b2,5,d,1,e,"cut short',
    '6,b2,6,d,1,e,"page, six",/u,p,s,r,pl,web',
    '7,b2,7,d,1,e,"never closed',
    "8,b2,8,d,1,e,page,/u,p,s,r,pl,web",
]
RECORDS = [
    "\n".join(BROKEN[1:4]),
    *BROKEN[4:6],
    "\n".join(BROKEN[6:9]),
    *BROKEN[9:],
]


@pytest.mark.parametrize("part_bytes", ["128m", "64b", "37b"])
def test_records_over_several_lines(spark, tmp_path, part_bytes):
    (tmp_path / "a.csv").write_text("\n".join(BROKEN) + "\n")
    (tmp_path / "b.csv").write_text(BROKEN[0] + "\n" + BROKEN[5] + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", part_bytes)
    try:
        got = [r.line for r in clicks.read_lines(spark, str(tmp_path)).collect()]
        page = {r.v1: r.page for r in clicks.read_clicks(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got) == sorted([*RECORDS, BROKEN[5]])
    assert page[1] == 'page with\ntwo, ""breaks""\nand a comma'
    assert page[6] == "page, six"
