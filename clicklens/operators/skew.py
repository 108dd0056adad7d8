"""Building blocks that stay exact and spread when one key holds a large
share of the rows.

A key value is *hot* when it has more rows than ``LARGE_GROUP_CONF``: more than
one task should hold. ``hot_keys`` counts the log once, and its result is handed
from operator to operator; all that an operator groups by the key and further
columns is smaller than the key's own group, so one count serves them all. As a
rule no key is hot, and plans are then the plain ones without a branch for hot
keys. An operator that is given the keys runs no job while its plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from clicklens.sources.tables import stage, stage_folder

LARGE_GROUP_CONF = "spark.clicklens.largeGroupRows"
LARGE_GROUP_ROWS = 2_000_000
# More hot keys than this are never held by the driver.
MAX_LOCAL_KEYS = 10_000

# An ordering key is read in three digits of this many bits, so that no task
# orders more than 2**21 values.
DIGIT_BITS = 21
UPPER_DIGITS = 2


@dataclass(frozen=True)
class HotKeys:
    """The hot values of a column, in a table with how many times the limit each
    of them holds (``parts``); None when there are none. ``nulls`` tells whether
    the rows without a value are more than the limit, too. ``rows`` is how many
    there are in all, ``apart`` those of hot values and without a value; None
    where nobody counted them."""

    column: str
    table: DataFrame | None
    nulls: bool = False
    rows: int | None = None
    apart: int | None = None


def hot_keys(df: DataFrame, column: str = "browser") -> HotKeys:
    """Counts the rows of each value of a column.

    The counts are combined before they are shuffled. A row over the limit makes
    a value hot whatever the size of the data, so the table grows with it; its
    joins carry no broadcast hint.
    """
    spark = df.sparkSession
    limit = int(spark.conf.get(LARGE_GROUP_CONF, str(LARGE_GROUP_ROWS)))
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))

    def over_limit(counts: DataFrame) -> DataFrame:
        parts = F.ceil(F.col("rows") / limit).alias("parts")
        return counts.filter(F.col("rows") > limit).select(column, parts)

    seen = Observation()
    apart = F.col(column).isNull() | (F.col("rows") > limit)
    observed = over_limit(
        counted.observe(
            seen,
            F.sum("rows").alias("rows"),
            F.sum(F.when(apart, F.col("rows"))).alias("apart"),
        )
    )
    staged = stage_folder(spark) is not None
    if staged:
        large = observed = stage(observed)
    # NULL comes first, if it is there
    found = observed.orderBy(F.col(column).asc_nulls_first()).limit(MAX_LOCAL_KEYS + 1).collect()
    totals = [seen.get.get(name) or 0 for name in ("rows", "apart")]
    nulls = bool(found) and found[0][0] is None
    if len(found) == nulls:
        return HotKeys(column, None, nulls, *totals)
    if not staged:
        # rows are observed once
        large = over_limit(counted)
        if len(found) <= MAX_LOCAL_KEYS:
            large = spark.createDataFrame(found, large.schema)
    return HotKeys(column, large.filter(F.col(column).isNotNull()), nulls, *totals)


def any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(key).isNull() for key in keys])


def split_hot(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary keys (NULL included) and those of hot ones."""
    if hot.table is None:
        return df, None
    keys = hot.table.select(hot.column)
    # a join on names moves them to the front
    rest, inside = (df.join(keys, hot.column, how) for how in ("left_anti", "left_semi"))
    return rest.select(*df.columns), inside.select(*df.columns)


def with_group_values(
    df: DataFrame,
    keys: Sequence[str],
    values: dict[str, Column],
    hot: HotKeys,
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with aggregates of each row's group; NULL for rows with a NULL key.

    The hot column is one of ``keys``. ``row_key`` names columns that tell rows
    apart (default: all of them).
    """
    keys = list(keys)
    small, large = split_hot(df, hot)
    # a row with a NULL key belongs to no group, so it is a window of its own
    alone = F.when(any_null(keys), F.xxhash64(*(row_key or df.columns)))
    group = Window.partitionBy(*keys, "alone")
    valued = small.withColumn("alone", alone).select(
        *df.columns,
        *[
            F.when(F.col("alone").isNull(), value.over(group)).alias(name)
            for name, value in values.items()
        ],
    )
    if large is None:
        return valued
    groups = (
        large.dropna(subset=keys)
        .groupBy(*keys)
        .agg(*[value.alias(name) for name, value in values.items()])
    )
    return valued.unionByName(salted_join(large, groups, keys, hot, "left", row_key))


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    hot: HotKeys,
    how: str = "inner",
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Inner or left equi-join that cuts the facts of a hot key into as many
    parts as it holds limits; each part meets a copy of its own of the lookup
    rows. The hot column is one of ``keys``. ``row_key`` names columns that tell
    rows apart (default: all of them).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    keys = list(keys)
    columns = [*facts.columns, *[c for c in lookup.columns if c not in keys]]
    if hot.table is None and how == "inner":
        return facts.join(lookup, keys).select(*columns)

    one = F.lit(1).cast("bigint")
    parted_facts, parted_lookup = (
        df.withColumn("parts", one)
        if hot.table is None
        else df.join(hot.table, hot.column, "left")
        for df in (facts, lookup)
    )
    content = F.xxhash64(*(row_key or facts.columns))
    salted_facts = parted_facts.select(
        *facts.columns,
        # NULL keys meet no lookup row: their own hash spreads them
        F.when(any_null(keys), content)
        .otherwise(F.pmod(content, F.coalesce("parts", one)))
        .alias("salt"),
    )
    copies = F.sequence(one - 1, F.coalesce("parts", one) - 1)
    salted_lookup = parted_lookup.select(
        *lookup.columns, F.explode(copies).alias("salt")
    )
    joined = salted_facts.join(salted_lookup, [*keys, "salt"], how)
    return joined.select(*columns)


def ordered_scan(
    df: DataFrame, group: Sequence[str], key: str, value: str
) -> DataFrame:
    """Running total and next row in the order of a BIGINT key, for groups of
    any size. ``key`` must be unique within its group and not NULL.

    Adds ``running`` (total of ``value`` up to and with this row), ``next_key``
    and ``next_value``. Rows whose keys differ in the last digit only are
    ordered in one task; the digits above are summed up and scanned likewise,
    and what they carry is joined back.
    """
    first = df.withColumns({"first_key": F.col(key), "first_value": F.col(value)})
    return _scan_digits(first, list(group), key, value, UPPER_DIGITS).drop(
        "first_key", "first_value"
    )


def _scan_digits(
    df: DataFrame, group: list[str], key: str, value: str, upper: int
) -> DataFrame:
    if upper == 0:
        return _scan_window(df, group, key, value)
    prefix = f"prefix_{upper}"
    cut = df.withColumn(prefix, F.shiftright(key, DIGIT_BITS))
    block = [*group, prefix]
    blocks = cut.groupBy(*block).agg(
        F.sum(value).alias("block_total"),
        F.min("first_key").alias("first_key"),
        F.min_by("first_value", key).alias("first_value"),
    )
    carried = _scan_digits(blocks, group, prefix, "block_total", upper - 1).select(
        *block,
        (F.col("running") - F.col("block_total")).alias("carried_total"),
        F.col("next_key").alias("carried_key"),
        F.col("next_value").alias("carried_value"),
    )
    return (
        _scan_window(cut.join(carried, block), block, key, value)
        .withColumns(
            {
                "running": F.col("carried_total") + F.col("running"),
                "next_key": F.coalesce("next_key", "carried_key"),
                "next_value": F.coalesce("next_value", "carried_value"),
            }
        )
        .drop(prefix, "carried_total", "carried_key", "carried_value")
    )


def _scan_window(df: DataFrame, group: list[str], key: str, value: str) -> DataFrame:
    ordered = Window.partitionBy(*group).orderBy(key)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns(
        {
            "running": F.sum(value).over(so_far),
            "next_key": F.lead("first_key").over(ordered),
            "next_value": F.lead("first_value").over(ordered),
        }
    )


def with_position(
    df: DataFrame,
    group: Sequence[str],
    order: Column,
    row_id: str,
    name: str,
    hot: HotKeys,
) -> DataFrame:
    """Position 1..n in each group by a BIGINT order (NULLs last), then row id.

    NULL is a group like any other here. Row ids must be unique.
    """
    filled, absent = {}, {}
    for i, key in enumerate(group):
        filled[f"key_{i}"] = F.coalesce(F.col(key).cast("string"), F.lit(""))
        absent[f"no_key_{i}"] = F.col(key).isNull()
    keys = [*filled, *absent]
    last = F.lit(2**63 - 1)
    keyed = df.withColumns(
        {**filled, **absent, "order_key": F.coalesce(order.cast("bigint"), last)}
    )
    columns = [*df.columns, F.col("position").cast("bigint").alias(name)]
    small, large = split_hot(keyed, hot)
    if hot.nulls:
        absent_key = F.col(hot.column).isNull()
        without = keyed.filter(absent_key)
        large = without if large is None else large.unionByName(without)
        small = small.filter(~absent_key)

    in_order = Window.partitionBy(*keys).orderBy("order_key", row_id)
    numbered = small.withColumn("position", F.row_number().over(in_order))
    if large is None:
        return numbered.select(*columns)

    moment = [*keys, "order_key"]
    sizes = large.groupBy(*moment).agg(F.count(F.lit(1)).alias("moment_rows"))
    before = ordered_scan(sizes, keys, "order_key", "moment_rows").select(
        *moment, (F.col("running") - F.col("moment_rows")).alias("rows_before")
    )
    ranked = ordered_scan(large.withColumn("one", F.lit(1)), moment, row_id, "one")
    placed = ranked.join(before, moment).withColumn("position", F.col("rows_before") + F.col("running"))
    return numbered.select(*columns).unionByName(placed.select(*columns))
