"""Writing result tables and staging intermediate ones."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clicklens.schema import ENHANCED_COLUMNS

# What the jobs that run now have staged, to be deleted when they end.
_open_jobs: list[list[str]] = []


def write_enhanced(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The enhanced log as parquet, a folder per day.

    The folders are named by a column of their own, so that ``day`` stays in the
    files as it is. Each day is gathered before it is written; adaptive
    execution splits a day too large for one file.
    """
    name = F.when(F.col("day").isNull(), "none").otherwise(F.concat(F.lit("d"), "day"))
    foldered = df.withColumn("day_folder", name).hint("rebalance", "day_folder")
    foldered.write.mode(mode).partitionBy("day_folder").parquet(path)


def read_enhanced(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*ENHANCED_COLUMNS)


def write_extract(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    """A chart extract in any Spark format; CSV gets a header."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def stage_folder(spark: SparkSession) -> str | None:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``."""
    return spark.conf.get("spark.checkpoint.dir", None)


def stage(df: DataFrame, sort_by: str | None = None) -> DataFrame:
    """``df`` written to a new table of the shared folder and read back.

    What several consumers need is computed once, and a lost executor costs its
    running tasks only: the table does not live on executors. Sorting each file
    by a column lets readers skip its blocks by that column. Without a shared
    folder ``df`` is returned as it is, and each consumer computes it.
    """
    folder = stage_folder(df.sparkSession)
    if folder is None:
        return df
    path = f"{folder}/clicklens/{uuid.uuid4().hex}"
    (df.sortWithinPartitions(sort_by) if sort_by else df).write.parquet(path)
    if _open_jobs:
        _open_jobs[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_observed(
    df: DataFrame, **metrics: Column
) -> tuple[DataFrame | None, dict]:
    """``df`` staged, and aggregates of it that were taken while it was written;
    None and no values without a shared folder."""
    if stage_folder(df.sparkSession) is None:
        return None, {}
    seen = Observation()
    named = [metric.alias(name) for name, metric in metrics.items()]
    return stage(df.observe(seen, *named)), seen.get


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Deletes what is staged inside, when its result has been written."""
    _open_jobs.append([])
    try:
        yield
    finally:
        for name in _open_jobs.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            conf = spark._jsc.sc().hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)
