from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clicklens.functions import map_genre, wrap_duration
from clicklens.operators.schedule import schedule_extract
from clicklens.plans import schedule as schedule_plan

DAY = dt.date(2014, 7, 6)


@pytest.mark.parametrize(
    ("genre", "broad"),
    [
        ("Current Affairs", "News"),
        ("Children's Drama", "Children's"),
        ("Drama", "Drama"),
        ("Light Entertainment", "Entertainment"),
        ("Schools", "Learning"),
        ("Religious", "Religion & Ethics"),
        ("Sit Com", "Comedy"),
        ("news", None),
        (None, None),
    ],
)
def test_the_first_matching_rule_wins(spark, genre, broad):
    df = spark.createDataFrame([(genre,)], "g string")
    assert df.select(map_genre(F.col("g"))).first()[0] == broad


def test_duration_wraps_at_midnight(spark):
    df = spark.createDataFrame([(82_800, 3_600), (3_600, 7_200), (5, 5)], "s int, e int")
    got = [r.d for r in df.select(wrap_duration(F.col("s"), F.col("e")).alias("d")).collect()]
    assert got == [7_200, 3_600, 0]


def test_genres_of_a_programme(spark, groups):
    events = [
        ("a", DAY, 100, 200, 1, 10, 0),
        ("a", DAY, 100, 200, 1, 10, 0),  # a copy
        ("b", DAY, 50, 40, 1, 11, 0),
        ("c", DAY, 300, 400, 1, 12, 0),
        ("planned", DAY, 300, 400, 1, 10, 1),
        ("other day", dt.date(2014, 7, 7), 300, 400, 1, 10, 0),
        ("no channel", DAY, 300, 400, 9, 10, 0),
    ] + [("repeat", DAY, 1_000 + i, 2_000, 2, 10, 0) for i in range(8)]
    tables = {
        "events": spark.createDataFrame(
            events,
            "billed_title string, publication_date date, publication_start_s int, "
            "publication_end_s int, service_id bigint, product_version_id bigint, "
            "planned_event_indicator int",
        ),
        "services": spark.createDataFrame([(1, "one"), (2, "two")], "id bigint, name string"),
        "versions": spark.createDataFrame(
            [(10, 1), (11, 2), (12, 3)], "id bigint, media_asset_id bigint"
        ),
        "assets": spark.createDataFrame([(1,), (2,), (3,)], "id bigint"),
        "genres": spark.createDataFrame(
            [(1, "Sport"), (1, "News"), (1, "Politics"), (2, "Weather")],
            "media_asset_id bigint, genre string",
        ),
    }
    rows = schedule_extract(**tables, days=F.col("publication_date") == F.lit(DAY)).collect()
    first = [(r.billed_title, r.duration, r.channel, r.genres) for r in rows[:3]]
    assert first == [
        ("b", 86_390, "one", None),
        ("a", 100, "one", "News, Sport"),
        ("c", 100, "one", None),
    ]
    assert len(rows) == 11
    starts = [r.publication_start_time for r in rows]
    assert starts == sorted(starts)
    assert {r.genres for r in rows[3:]} == {"News, Sport"}


def test_a_whole_day_is_not_nothing(spark):
    df = spark.createDataFrame([(0, 86_400), (3600, 86_400), (7, 7)], "s int, e int")
    got = [r.d for r in df.select(wrap_duration(F.col("s"), F.col("e")).alias("d")).collect()]
    assert got == [86_400, 82_800, 0]


def test_job_reads_its_days_and_writes_them_in_order(spark, tmp_path):
    days = [dt.date(2014, 7, d) for d in range(1, 9)]
    tables = {
        "events": [(f"t{i % 50}", days[i % 8], i * 7919 % 86_400, i * 6007 % 86_400, i % 4, i % 30, i % 2) for i in range(800)],
        "services": [(i, f"channel {i}") for i in range(4)],
        "versions": [(i, i % 20) for i in range(30)],
        "assets": [(i,) for i in range(18)],
        "genres": [(i % 18, ["Sport", "Drama", "Weather"][i % 3]) for i in range(40)],
    }
    schemas = {
        "events": "billed_title string, publication_date date, publication_start_s int, publication_end_s int,"
        " service_id bigint, product_version_id bigint, planned_event_indicator int",
        "services": "id bigint, name string",
        "versions": "id bigint, media_asset_id bigint",
        "assets": "id bigint",
        "genres": "media_asset_id bigint, genre string",
    }
    frames, names = {}, {}
    for name, rows in tables.items():
        frames[name] = spark.createDataFrame(rows, schemas[name])
        path = str(tmp_path / name)
        writer = frames[name].write
        (writer.partitionBy("publication_date") if name == "events" else writer).parquet(path)
        names[name] = f"parquet.`{path}`"
    wanted = days[2:4]
    found = schedule_plan.read_schedule_tables(spark, names)
    plan = schedule_plan.schedule_of_days(found, wanted)._jdf.queryExecution().toString()
    optimized = plan[plan.index("Optimized Logical Plan") : plan.index("Physical Plan")]
    assert "PartitionFilters: [publication_date" in plan.replace("isnotnull(publication_date), ", "")
    # facts lead: they meet versions first, assets next, genres last
    order = [optimized.index(column) for column in ("billed_title#", "media_asset_id#")]
    assert order == sorted(order)

    spark.conf.set("spark.sql.shuffle.partitions", "5")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        schedule_plan.run_schedule(spark, names, wanted, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-"))
    assert len(files) > 1
    rows = [tuple(r) for f in files for r in spark.read.parquet(str(f)).coalesce(1).collect()]
    starts = [row[2] for row in rows]
    assert starts == sorted(starts) and len(rows) > 50
    direct = schedule_extract(**frames, days=F.col("publication_date").isin(wanted))
    assert sorted(rows, key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_order_holds_over_partitions(spark):
    service = spark.createDataFrame([(1, "c")], "id bigint, name string")
    version = spark.createDataFrame([(1, 1)], "id bigint, media_asset_id bigint")
    asset = spark.createDataFrame([(1,)], "id bigint")
    genre = spark.createDataFrame([(1, "Sport")], "media_asset_id bigint, genre string")
    events = spark.range(20_000).selectExpr(
        "'t' || id % 700 AS billed_title", "date '2014-07-06' AS publication_date",
        "cast(id * 7919 % 86400 AS int) AS publication_start_s", "cast(id % 86400 AS int) AS publication_end_s",
        "1L AS service_id", "1L AS product_version_id", "0 AS planned_event_indicator",
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = schedule_extract(events, service, version, asset, genre, F.lit(True))
        assert rows.rdd.getNumPartitions() > 1
        got = [tuple(r) for r in rows.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == sorted(got, key=lambda r: (r[2], r[0], r[1], r[3], r[4], r[5])) and len(got) == 20_000
