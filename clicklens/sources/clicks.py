"""Reading raw page-view logs and lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clicklens.schema import RAW_CLICKS, REGION_HEX

# A field and the comma that ends it: in quotes, where a doubled quote does not
# end it, or all up to a comma. A backslash is a character like any other.
FIELD = r'("[^"]*+(?:""[^"]*+)*+"|[^,]*),'


def split_fields(line: Column) -> Column:
    """The fields of a CSV line as they stand there, quotes included."""
    return F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(FIELD), F.lit(1))


def field_value(field: Column) -> Column:
    """A field without its outer quotes. Doubled quotes inside stay, since the
    repair looks for them. Blank and ``NA`` are NULL unless quoted."""
    quoted = field.startswith('"') & field.endswith('"') & (F.length(field) > 1)
    return F.when(quoted, F.substring(field, F.lit(2), F.length(field) - 2)).when(
        ~field.isin("", "NA"), field
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """The raw log from its CSV records (column ``line``), a row per record.

    Short rows are filled with NULL and surplus fields dropped.
    """
    split = lines.select(split_fields(F.col("line")).alias("fields"))
    return split.select(
        *[
            field_value(F.get("fields", F.lit(i)))
            .try_cast(field.dataType)
            .alias(field.name)
            for i, field in enumerate(RAW_CLICKS)
        ]
    )


# A record that goes on in the next line: whole fields, then a field that opens
# with a quote which nothing closes.
OPEN_RECORD = (
    r'(?s)\A(?:"[^"]*+(?:""[^"]*+)*+",|[^",][^,]*+,|,)*+"[^"]*+(?:""[^"]*+)*+\z'
)


# A line that goes on inside quotes and, if it closes them, ends the field there.
GOES_ON = r'(?s)\A[^"]*+(?:""[^"]*+)*+(?:"(?:,.*)?)?\z'


def read_physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their file, the part of it that a task reads
    (``block``) and their order in the part (``place``). Files are split as
    usual."""
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # grows along a part, whatever else the task reads
        F.monotonically_increasing_id().alias("place"),
    )


def join_records(physical: DataFrame, n_fields: int = len(RAW_CLICKS)) -> DataFrame:
    """Records of CSV files (``file, block, place, line``) from their lines.

    A line either starts a record or goes on with one whose quote is open, and
    what it leaves open depends on that: a step with two states. The steps of a
    part add up to one step of the part; the parts of a file then tell each other
    how they begin. Only files in which some line can leave a quote open are
    looked at so; the others have a record per line.

    Damaged fields hold stray quotes. So a line with all its fields leaves nothing
    open, and lines whose quote is not closed by a quote that ends a field, up to
    the end of the file, stay apart.
    """
    text = F.col("line")
    opens = text.rlike(OPEN_RECORD)
    short = F.when(opens, F.size(split_fields(text)) < n_fields)
    # the state behind a line, when it starts a record and when it goes on
    told = physical.withColumns(
        {"if_new": F.coalesce(short, F.lit(False)), "is_apart": ~text.rlike(GOES_ON)}
    ).withColumn(
        "if_open",
        F.when(F.col("is_apart"), F.col("if_new")).otherwise(
            F.concat(F.lit('"'), text).rlike(OPEN_RECORD)
        ),
    )
    broken = told.filter("if_new").select("file").distinct()
    whole = physical.join(broken, "file", "left_anti")

    part = Window.partitionBy("file", "block").orderBy("place")
    so_far = part.rowsBetween(Window.unboundedPreceding, -1)
    # a line that leaves the same state whatever was before it starts the count
    # anew; the lines since then swap the state or keep it
    fixed = F.col("if_new") == F.col("if_open")
    swaps = F.col("if_new") & ~F.col("if_open")
    step = F.struct(F.col("if_new").alias("state"), F.col("swapped").alias("at"))
    stepped = (
        told.join(broken, "file", "left_semi")
        .withColumn("swapped", F.sum(swaps.cast("int")).over(part))
        .withColumn("fixed", F.when(fixed, step))
        .withColumns(
            {
                "last_fixed": F.last("fixed", ignorenulls=True).over(so_far),
                "swaps_before": F.coalesce(F.lag("swapped").over(part), F.lit(0)),
            }
        )
    )

    def after(start: Column, fixed_at: Column, swapped: Column) -> Column:
        """The state behind lines, from the last fixed one or from the start."""
        state = F.coalesce(fixed_at["state"], start)
        odd = (swapped - F.coalesce(fixed_at["at"], F.lit(0))) % 2 == 1
        return state != odd

    parts = stepped.groupBy("file", "block").agg(
        F.max_by("fixed", F.when(F.col("fixed").isNotNull(), F.col("place"))).alias("fixed"),
        F.max("swapped").alias("swapped"),
    )
    # the parts of a file are as many as its size has splits
    in_file = Window.partitionBy("file").orderBy("block")
    since = in_file.rowsBetween(Window.unboundedPreceding, -1)
    fixed_part = F.when(
        F.col("fixed").isNotNull(),
        F.struct(
            after(F.lit(False), F.col("fixed"), F.col("swapped")).alias("state"),
            F.sum("loose").over(in_file).alias("at"),
        ),
    )
    begun = (
        parts.withColumn("loose", F.when(F.col("fixed").isNull(), F.col("swapped")).otherwise(0))
        .withColumns({"passed": F.sum("loose").over(since), "settled": fixed_part})
        .withColumn("settled", F.last("settled", ignorenulls=True).over(since))
        .select(
            "file",
            "block",
            after(F.lit(False), F.col("settled"), F.coalesce("passed", F.lit(0))).alias("begins"),
        )
    )
    states = stepped.join(begun, ["file", "block"]).select(
        "file",
        "block",
        "place",
        "line",
        "if_new",
        "if_open",
        (
            ~F.col("is_apart")
            & after(F.col("begins"), F.col("last_fixed"), F.col("swaps_before"))
        ).alias("goes_on"),
    )
    # where the record of each line starts, and whether it ever ends
    own = F.struct("block", "place")
    lines = Window.partitionBy("file", "block").orderBy("place")
    starts = states.withColumns(
        {
            "stays_open": F.when(F.col("goes_on"), F.col("if_open")).otherwise(F.col("if_new")),
            "start": F.last(F.when(~F.col("goes_on"), own), ignorenulls=True).over(lines),
        }
    )
    carried = (
        starts.groupBy("file", "block")
        .agg(F.max("start").alias("start"))
        .select(
            "file", "block", F.last("start", ignorenulls=True).over(since).alias("carried")
        )
    )
    owned = starts.join(carried, ["file", "block"]).withColumn(
        "start", F.coalesce("start", "carried")
    )
    single = owned.filter("NOT goes_on AND NOT stays_open")
    several = owned.filter("goes_on OR stays_open")
    last_line = F.max(F.struct("block", "place", "stays_open"))
    unclosed = several.groupBy("file", "start").agg(last_line["stays_open"].alias("unclosed"))
    several = several.join(unclosed, ["file", "start"])
    joined = (
        several.filter("NOT unclosed")
        .groupBy("file", "start")
        .agg(F.array_sort(F.collect_list(F.struct("block", "place", "line"))).alias("lines"))
        .select(
            "file",
            "start.block",
            "start.place",
            F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("line"),
        )
    )
    columns = ["file", "block", "place", "line"]
    return (
        whole.select(*columns)
        .unionByName(single.select(*columns))
        .unionByName(several.filter("unclosed").select(*columns))
        .unionByName(joined.select(*columns))
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files without their headers, in ``line``. A record may
    go over several lines."""
    physical = read_physical_lines(spark, path)
    header = (
        physical.filter("block = 0").groupBy("file").agg(F.min("place").alias("header"))
    )
    records = join_records(physical).join(header, "file")
    return records.filter("block > 0 OR place > header").filter("line <> ''").select("line")


def read_clicks(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The raw log from CSV with a header, or from another Spark format.

    CSV is parsed by ``parse_lines``; no schema is inferred, so the files are
    read once.
    """
    if fmt == "csv":
        return parse_lines(read_lines(spark, path))
    return spark.read.schema(RAW_CLICKS).format(fmt).load(path)


def ragged_lines(lines: DataFrame) -> DataFrame:
    """The lines that have too few or too many fields."""
    fields = split_fields(F.col("line"))
    return lines.filter(F.size(fields) != len(RAW_CLICKS))


def read_ragged_rows(spark: SparkSession, path: str) -> DataFrame:
    """The CSV rows that have too few or too many fields, as text in ``line``."""
    return ragged_lines(read_lines(spark, path))


def read_region_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Map positions of regions from CSV: ``Region, lat_bin, long_bin``."""
    return spark.read.schema(REGION_HEX).option("header", True).csv(path)
