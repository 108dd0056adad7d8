"""The test tables as page-view logs, region lookup and schedule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The columns in use; a given schema spares a look into the files.
SCHEMAS = {
    # read as instants, whatever the time zone of the session
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, "
    "props string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, "
    "l_linenumber int, l_quantity double, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def clean_clicks(spark: SparkSession, sf_dir: str, tick_ms: int = 1) -> DataFrame:
    """Events as a page-view log; ``tick_ms`` rounds timestamps down to ties."""
    events = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    k = F.get_json_object("props", "$.k").cast("int")
    site = F.concat(F.lit("site_"), (F.col("k") % 40).cast("string"))
    app = F.when(F.col("v1") % 3 == 0, "web").when(F.col("v1") % 3 == 1, "mobile app")
    page = F.concat(F.lit("page_"), F.col("k").cast("string"))
    joined = (
        events.join(customer, events["user_id"] == customer["c_custkey"])
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumns({"v1": F.col("event_id"), "k": k, "ms": F.unix_millis("ts")})
    )
    return joined.select(
        "v1",
        F.concat(F.lit("b"), F.col("user_id").cast("string")).alias("browser"),
        (F.col("ms") - F.col("ms") % tick_ms).alias("ts"),
        F.date_from_unix_date(F.floor(F.col("ms") / 86_400_000).cast("int")).alias("day"),
        F.floor(F.col("ms") % 86_400_000 / 3_600_000).cast("int").alias("hour"),
        F.col("event_type").alias("entry_type"),
        page.alias("page"),
        F.concat_ws("/", F.lit(""), site, F.col("k").cast("string"), "event_type").alias(
            "page_url"
        ),
        F.when(F.col("k") == 2, "")
        .when(F.col("k") > 2, F.concat(F.lit("page_"), (F.col("k") - 1).cast("string")))
        .alias("previous_page"),
        F.when(F.col("v1") % 101 != 0, site).alias("virtual_site"),
        F.when(F.col("v1") % 53 != 0, F.lower("n_name")).alias("region"),
        F.col("c_mktsegment").alias("platform"),
        app.otherwise("responsive").alias("application_type"),
    )


def clicks(spark: SparkSession, sf_dir: str, tick_ms: int = 1) -> DataFrame:
    """The log with some browsers and some timestamps (not of entries) missing."""
    no_ts = (F.col("v1") % 401 == 0) & F.col("previous_page").isNotNull()
    return clean_clicks(spark, sf_dir, tick_ms).withColumns(
        {
            "browser": F.when(F.col("v1") % 307 != 0, F.col("browser")),
            "ts": F.when(~no_ts, F.col("ts")),
        }
    )


def dirty_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as damaged text: scientific timestamps, shifted rows, no type."""
    clean = clean_clicks(spark, sf_dir)
    text = clean.select("v1", *[F.col(c).cast("string") for c in clean.columns[1:]])
    sci = F.concat(
        F.substring("ts", 1, 1), F.lit(","), F.substring("ts", 2, 6), F.lit("e+12")
    )
    shifted = F.col("v1") % 50 == 7
    merged = F.concat("page_url", F.lit('"",'), F.coalesce("previous_page", F.lit("")))
    product = F.concat(F.lit('"'), "virtual_site", F.lit("|"))

    def damaged(name: str, value: Column) -> Column:
        return F.when(shifted, value).otherwise(F.col(name)).alias(name)

    return text.select(
        "v1",
        "browser",
        F.when(F.col("v1") % 10 == 3, sci).otherwise(F.col("ts")).alias("ts_raw"),
        "day",
        "hour",
        "entry_type",
        "page",
        damaged("page_url", merged),
        damaged("previous_page", product),
        damaged("virtual_site", F.col("region")),
        damaged("region", F.col("platform")),
        damaged("platform", F.col("application_type")),
        F.when(shifted, "1")
        .when(F.col("v1") % 211 != 0, F.col("application_type"))
        .alias("application_type"),
    )


def region_hexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map position per nation but one, and one for a value of another chart."""
    nation = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    known = nation.filter(key != 24).select(
        F.lower("n_name").alias("Region"),
        (F.lit(50.0) + key * 0.25).alias("lat_bin"),
        (key * 0.5 - F.lit(6.0)).alias("long_bin"),
    )
    other = nation.filter(key == 0).select(
        F.lit("web").alias("Region"),
        F.lit(40.0).alias("lat_bin"),
        F.lit(1.0).alias("long_bin"),
    )
    return known.unionByName(other)


# Genre texts for parts: each broad genre, one text of two genres, one of none.
GENRES = (
    "Current Affairs",
    "Children's Drama",
    "Drama Serials",
    "Light Entertainment",
    "Features / Factual",
    "Schools Programmes",
    "Classical Music",
    "Religious Services",
    "Sport",
    "Sitcom",
    "Weather",
    "Prime Ministerial Broadcast",
)


def schedule_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Line items as broadcasts, suppliers as channels, parts as programmes."""
    line = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part")
    start = F.col("l_orderkey") * 977
    end = start + (F.col("l_quantity") * 120).cast("bigint")
    texts = F.array(*[F.lit(g) for g in GENRES])
    part_id = F.col("p_partkey")
    one = part.filter(part_id % 10 != 0).select(
        part_id.alias("media_asset_id"), texts[(part_id % 12).cast("int")].alias("genre")
    )
    more = part.filter(part_id % 4 == 0).select(
        part_id.alias("media_asset_id"), texts[(part_id % 7).cast("int")].alias("genre")
    )
    return {
        "events": line.select(
            F.concat(F.lit("title_"), (F.col("l_partkey") % 200).cast("string")).alias(
                "billed_title"
            ),
            F.to_date("l_shipdate").alias("publication_date"),
            (start % 86_400).cast("int").alias("publication_start_s"),
            (end % 86_400).cast("int").alias("publication_end_s"),
            F.col("l_suppkey").alias("service_id"),
            F.col("l_partkey").alias("product_version_id"),
            (F.col("l_linenumber") % 2).alias("planned_event_indicator"),
        ),
        "services": supplier.select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
        ),
        "versions": part.select(
            part_id.alias("id"), part_id.alias("media_asset_id")
        ),
        "assets": part.select(part_id.alias("id")),
        "genres": one.unionByName(more),
    }


def click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged log as CSV lines, ``v1`` besides.

    A field with a comma is quoted and keeps its doubled quotes, an empty text
    is a pair of quotes, NULL is ``NA`` or blank.
    """
    absent = F.when(F.col("v1") % 2 == 0, "NA").otherwise("")

    def field(name: str) -> Column:
        value = F.col(name).cast("string")
        quoted = F.concat(F.lit('"'), value, F.lit('"'))
        return (
            F.when(value.isNull(), absent)
            .when((value == "") | value.contains(","), quoted)
            .otherwise(value)
        )

    raw = dirty_clicks(spark, sf_dir)
    return raw.select("v1", F.concat_ws(",", *map(field, raw.columns)).alias("line"))


def ragged_click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``click_lines``, some with a surplus field and some cut short."""
    short = F.regexp_extract("line", "^(.*),[^,]*$", 1)
    line = (
        F.when(F.col("v1") % 97 == 0, F.concat("line", F.lit(",surplus")))
        .when(F.col("v1") % 101 == 1, short)
        .otherwise(F.col("line"))
    )
    return click_lines(spark, sf_dir).withColumn("line", line)


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines as CSV files with a header, written as they are."""
    options = {"header": True, "sep": "\u0001", "quote": "", "emptyValue": ""}
    lines.select("line").write.options(**options).csv(path)
