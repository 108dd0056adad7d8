"""Connected components by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.store import discard, stage

MAX_ROUNDS = 100
# A node is hot when it has more than HOT_EDGES edges and more than a
# MAX_HOT-th of all; so at most twice MAX_HOT nodes are ever broadcast.
HOT_EDGES = 64
MAX_HOT = 10_000


def _hand_over(edges: DataFrame, rows: int, condition: str) -> DataFrame:
    """For the neighbours ``b`` of each ``a``: ``b`` and the smallest of all."""
    least = edges.groupBy("a").agg(
        F.min(F.least("a", "b")).alias("least"), F.count(F.lit(1)).alias("degree")
    )
    hot = F.broadcast(
        least.filter(F.col("degree") > max(HOT_EDGES, rows // MAX_HOT)).drop("degree")
    )
    used = edges.filter(condition)
    joined = used.join(hot, "a").unionByName(
        used.join(hot, "a", "left_anti").join(least.drop("degree"), "a")
    )
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (BIGINT); ``root`` is
    the smallest node of its component. Nodes without an edge are not returned.

    Large-star and small-star rounds: each node hands its neighbours to the
    smallest one it knows, until the table stops changing; the number of rounds
    grows with the logarithm of the longest path. Neighbours of a hot node meet
    its smallest one by a broadcast of the hot nodes, all others by a shuffle.
    """
    current = stage(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    rows, seen = current.count(), None
    for _ in range(MAX_ROUNDS):
        # large star: larger neighbours of a node go to its smallest neighbour
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        middle = stage(_hand_over(both, 2 * rows, "b > a").distinct())
        # small star: smaller neighbours of a node, and itself, do so too
        itself = middle.groupBy("a").agg(F.min("b").alias("b"))
        following = stage(
            _hand_over(middle, rows, "true")
            .filter("a <> b")
            .unionByName(itself)
            .distinct()
        )
        discard(middle)
        discard(current)
        current = following
        state = current.agg(
            F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64("a", "b"))
        ).first()
        if state == seen:
            break
        rows, seen = state["rows"], state
    else:
        raise RuntimeError("components did not settle")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
