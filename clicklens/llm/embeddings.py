"""Near duplicates among embeddings by signs of random hyperplanes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.graph import components
from clicklens.llm.ranks import bucket_count, gapless
from clicklens.llm.store import stage

BLOCK = 2048
# A pair at the threshold is missed with this probability, at most.
MISS = 0.0013


def usable(vector) -> F.Column:
    """Whether a vector has a direction: no NULLs, finite, not all zero."""
    whole = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def plan_tables(rows: int, threshold: float, bucket_rows: int) -> tuple[int, int]:
    """``tables, bits`` for ``rows`` vectors.

    A bucket holds about ``bucket_rows`` vectors however large the table is, so
    work grows with the table and the number of tables, not with its square;
    there are as many tables as it takes to miss a pair at the threshold with
    probability ``MISS``. A signature is an INT, hence 31 bits at most.
    """
    bits = max(10, math.ceil(math.log2(max(1.0, rows / bucket_rows))))
    bits = min(31, bits)
    same = min(0.99, (1 - math.acos(threshold) / math.pi) ** bits)
    return math.ceil(math.log(MISS) / math.log1p(-same)), bits


def planes(size: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, tables * bits))


def unit(flat: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    scaled = flat / np.abs(flat).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.list_(pa.float64()))
    return np.asarray(column.flatten()).reshape(len(column), -1)


def signatures(classes: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """``sig`` beside ``class_id, copies, size, vector``: buckets by table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits)
        for batch in batches:
            lengths = np.asarray(batch.column("size"))
            for size in np.unique(lengths):
                own = batch.filter(pa.array(lengths == size))
                signs = unit(_matrix(own.column("vector"))) @ planes(
                    size, tables, bits, seed
                )
                sig = (signs > 0).reshape(-1, tables, bits) @ weights
                offsets = np.arange(len(sig) + 1, dtype=np.int32) * tables
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("class_id"),
                        own.column("copies"),
                        own.column("size"),
                        own.column("vector"),
                        pa.ListArray.from_arrays(
                            offsets, pa.array(sig.ravel().astype(np.int32))
                        ),
                    ],
                    ["class_id", "copies", "size", "vector", "sig"],
                )

    kind = dict(classes.dtypes)["vector"]
    schema = f"class_id bigint, copies bigint, size int, vector {kind}, sig array<int>"
    return classes.mapInArrow(run, schema)


def _compare(threshold: float):
    """A function that compares one block of a bucket with another or itself."""

    def run(key, table):
        number = key[0].as_py()
        ids = np.asarray(table.column("class_id"))
        copies = np.asarray(table.column("copies"))
        role = np.asarray(table.column("role"))
        vectors = unit(_matrix(table.column("vector").combine_chunks()))
        sig = np.asarray(
            table.column("sig").combine_chunks().flatten()
        ).reshape(len(ids), -1)
        left, right = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        within = not len(right)
        right = left if within else right
        links = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        edges = []
        for i in range(0, len(left), BLOCK):
            rows = left[i : i + BLOCK]
            near = vectors[rows] @ vectors[right].T >= threshold
            x, y = np.nonzero(near)
            x, y = rows[x], right[y]
            if within:
                x, y = x[x < y], y[x < y]
            # a pair that shares a bucket of an earlier table was seen there
            new = ~(sig[x, :number] == sig[y, :number]).any(axis=1)
            x, y = x[new], y[new]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            for a, b in zip(x.tolist(), y.tolist()):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    edges.append((int(ids[a]), int(ids[b])))
        linked = np.flatnonzero(links)
        return pa.table(
            {
                "a": pa.array(
                    [*ids[linked].tolist(), *[e[0] for e in edges]], pa.int64()
                ),
                "b": pa.array(
                    [*ids[linked].tolist(), *[e[1] for e in edges]], pa.int64()
                ),
                "links": pa.array(
                    [*links[linked].tolist(), *[0] * len(edges)], pa.int64()
                ),
            }
        )

    return run


def bucket_links(signed: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """``a, b, links``: links that connect what a bucket has linked, and per
    vector (``a = b``) how many rows it found.

    A bucket of more than ``block_rows`` vectors is cut into blocks, and each
    pair of blocks is a group of its own, so no task holds more than two blocks.
    """
    rows = signed.select(
        "class_id", "copies", "size", "vector", "sig",
        F.posexplode("sig").alias("number", "bucket"),
    )
    full = stage(
        rows.groupBy("number", "size", "bucket")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .withColumn("blocks", F.ceil(F.col("rows") / block_rows).cast("int"))
    )
    block = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    met = (
        rows.join(full.drop("rows"), ["number", "size", "bucket"])
        .withColumn("block", block)
        .withColumn("other", F.explode(every))
        .select(
            "number",
            "size",
            "bucket",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            (F.col("block") > F.col("other")).cast("int").alias("role"),
            "class_id",
            "copies",
            "vector",
            "sig",
        )
    )
    return met.groupBy("number", "size", "bucket", "low", "high").applyInArrow(
        _compare(threshold), "a bigint, b bigint, links bigint"
    )


def embedding_groups(
    vectors: DataFrame,
    threshold: float = 0.9,
    bucket_rows: float = 512,
    seed: int = 7,
    block_rows: int = 4096,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors``
    (``vec_id``, ``embedding``; labels and other columns are not read).

    Two vectors are linked when they share the signs of all hyperplanes of one
    table and their cosine in double precision is at least ``threshold``. Tables
    and hyperplanes come from the number of vectors (``plan_tables``): 28 tables
    of 10 up to 500,000 vectors, more on larger tables. A pair at the threshold
    is found with probability 0.998, a closer one more surely, and none below
    the threshold is linked.

    Equal vectors are one class and linked for sure. Vectors that are NULL,
    empty, zero or hold NULL or non-finite numbers link with nothing, vectors of
    different length neither. ``component_id`` is the smallest ``vec_id``
    reachable; a NULL ``vec_id`` is never one unless its component has no other.
    Repeated rows count as rows. No rows give no rows.
    """
    good = usable(F.col("embedding"))
    rows = stage(
        vectors.select(
            "vec_id",
            F.when(good, F.col("embedding")).alias("vector"),
        ).withColumn(
            "digest",
            F.when(
                F.col("vector").isNotNull(),
                F.unhex(F.sha2(F.to_json("vector"), 256)),
            ),
        )
    )
    classes = stage(
        rows.filter("digest is not null")
        .groupBy("digest", "vector")
        .agg(
            F.min("vec_id").alias("least_id"),
            F.count(F.lit(1)).alias("copies"),
        )
    )
    number = classes.count()
    own = gapless(
        classes.select("digest"), [], ["digest"], "class_id", bucket_count(number)
    )
    classes = stage(classes.join(own, "digest"))
    shape = classes.select(
        "class_id", "copies", F.size("vector").cast("int").alias("size"), "vector"
    )
    signed = signatures(shape, *plan_tables(number, threshold, bucket_rows), seed)
    found = stage(bucket_links(stage(signed), threshold, block_rows))
    counts = found.filter("a = b").groupBy("a").agg(F.sum("links").alias("others"))
    roots = components(found.filter("a <> b").select("a", "b"))
    linked = stage(
        classes.join(roots, F.col("class_id") == F.col("node"), "left").select(
            "digest",
            "class_id",
            "copies",
            "least_id",
            F.coalesce("root", "class_id").alias("root"),
        )
    )
    smallest = stage(linked.groupBy("root").agg(F.min("least_id").alias("component_id")))
    known = stage(
        linked.join(smallest, "root")
        .join(counts, F.col("class_id") == F.col("a"), "left")
        .select(
            "digest",
            "component_id",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        )
    )
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(
        F.col("component_id")
    )
    return (
        rows.drop("vector")
        .join(known, "digest", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            component.cast("bigint").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
