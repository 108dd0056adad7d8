"""Exact duplicates by merging sorted runs of digests in a tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.store import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What tells texts apart. A row joins an entry of a run only when all three
# agree, so every merge verifies the digest by length and by a second hash.
IDENTITY = ["digest", "n_bytes", "check_hash"]


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    # a text without multi-byte characters has no other letters to change
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def text_digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the identity of each normalised text; NULL is empty."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    return docs.select("doc_id", text.alias("normal")).select(
        "doc_id",
        F.unhex(F.sha2("normal", 256)).alias("digest"),
        F.octet_length("normal").alias("n_bytes"),
        F.xxhash64("normal").alias("check_hash"),
    )


def sorted_runs(rows: DataFrame, keep: str, runs: int) -> DataFrame:
    """The runs that the tree starts from: ``run``, identity, ``keep_id`` and
    ``group_size``, an entry per run and text.

    Rows are dealt by their id, and combined before they are shuffled, so that a
    text which a third of all rows share sends one entry per task and run.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    return (
        rows.withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(runs)).cast("int"))
        .groupBy("run", *IDENTITY)
        .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )


def merge_runs(rows: DataFrame, keep: str, runs: int, fan_in: int) -> DataFrame:
    """One entry per text: its identity, the id to keep and the rows it has.

    In each round runs that are a power of ``fan_in`` apart go to the first of
    ``fan_in`` of them, whose number they take, and are merged there in the order
    of digest, length, check hash and id. Entries of one text follow each other
    then, at most ``fan_in`` of them; the first one stays and adds up their rows.
    Entries with one digest that differ in length or check hash both stay. A run
    is cut by digest into as many parts as there are shuffle partitions, so the
    last run is never in one task.
    """
    level = sorted_runs(rows, keep, runs)
    first = {"smallest": F.asc_nulls_last, "largest": F.desc_nulls_last}[keep]("keep_id")
    entries = Window.partitionBy("run", *IDENTITY)
    apart = 1
    while apart < runs:
        apart *= fan_in
        level = (
            level.withColumn("run", F.col("run") - F.col("run") % apart)
            .repartition("run", "digest")
            .sortWithinPartitions("run", *IDENTITY, first)
            .select(
                "run",
                *IDENTITY,
                "keep_id",
                F.row_number().over(entries.orderBy(first)).alias("place"),
                F.sum("group_size").over(entries).alias("group_size"),
            )
            .filter("place = 1")
            .drop("place")
        )
    return level.drop("run")


def exact_dedup(
    docs: DataFrame, keep: str = "smallest", runs: int = 64, fan_in: int = 8
) -> DataFrame:
    """Every row with the row of its text that stays.

    Texts are equal when identical after lower-casing A-Z only. Returns
    ``doc_id, keep_id, group_size, kept, text_sha256`` for each row of ``docs``
    (``doc_id``, ``text``; other columns are not read). NULL text counts as
    empty. Repeated rows with one id are all kept or all dropped. A NULL id is
    kept only where all ids of its text are NULL (``keep_id`` is then NULL). No
    rows give no rows.
    """
    rows = stage(text_digests(docs))
    shared = stage(merge_runs(rows, keep, runs, fan_in).filter("group_size > 1"))
    # only texts with copies are looked up; one side of the join has unique keys
    return rows.join(shared, IDENTITY, "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id"))
        .otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (
            F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
        ).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
