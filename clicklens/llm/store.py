"""Tables that several steps read, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where it is unset, as in tests, a session of one machine takes its warehouse
    folder; a cluster has none that all executors are known to share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir names no folder for staged tables")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/staged"


def stage(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet and read back: computed once, lineage cut.

    Unlike ``checkpoint()`` it runs one job, keeps columns apart and compresses.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/clicklens-llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read.staged_path = path
    return read


def discard(df: DataFrame) -> None:
    """Deletes a staged table that no later step reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    files = path.getFileSystem(spark._jsc.sc().hadoopConfiguration())
    files.delete(path, True)
