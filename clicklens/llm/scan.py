"""Running aggregates along a position, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 12
COMBINE = {"sum": F.sum, "xor": F.bit_xor}


def running(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    values: dict[str, tuple[str, Column]],
    ties: Sequence[str] = (),
) -> DataFrame:
    """``df`` with aggregates over the rows of its group up to and with each row.

    ``values`` names them: ``(sum or xor, BIGINT column)``. The order is by the
    BIGINT ``position``, then by ``ties``. ``group`` and ``position`` are never
    NULL. A group is cut into blocks of 4096 positions, each scanned by a task;
    what comes before a block is carried over from the totals of the blocks.
    """
    cut = df.withColumn("block_", F.shiftright(position, BLOCK_BITS))
    block = [*group, "block_"]
    before = (
        Window.partitionBy(*group)
        .orderBy("block_")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = cut.groupBy(*block).agg(
        *[COMBINE[kind](value).alias(f"{name}_total") for name, (kind, value) in values.items()]
    )
    carried = totals.select(
        *block,
        *[
            F.coalesce(COMBINE[kind](f"{name}_total").over(before), F.lit(0)).alias(f"{name}_before")
            for name, (kind, _) in values.items()
        ],
    )
    inside = (
        Window.partitionBy(*block)
        .orderBy(position, *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = cut.withColumns(
        {name: COMBINE[kind](value).over(inside) for name, (kind, value) in values.items()}
    ).join(carried, block)
    return scanned.select(
        *df.columns,
        *[
            (F.col(name) + F.col(f"{name}_before") if kind == "sum"
             else F.col(name).bitwiseXOR(F.col(f"{name}_before"))).cast("bigint").alias(name)
            for name, (kind, _) in values.items()
        ],
    )
