"""The training-data pipeline: stages over ``documents``, each on what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm.exact import exact_dedup
from clicklens.llm.packing import pack_documents
from clicklens.llm.quality import score_quality
from clicklens.llm.secrets import scan_secrets
from clicklens.llm.simhash import simhash_groups
from clicklens.llm.store import stage


# A row's own number; no table is expected to have a column of that name.
ROW = "clicklens_row"
# As text, since no BIGINT holds them.
AFTER_ALL_IDS, ROWS_PER_ID = str(2**63), str(10**19)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number per row that orders them by ``doc_id``, NULL last.

    Ids may be repeated or NULL, so no stage tells rows apart by them. The table
    is written, so that a row keeps its number when a task runs again.
    """
    of_id = F.coalesce(F.col("doc_id").cast("decimal(19,0)"), F.lit(AFTER_ALL_IDS).cast("decimal(19,0)"))
    number = of_id * F.lit(ROWS_PER_ID).cast("decimal(20,0)")
    row = F.monotonically_increasing_id().cast("decimal(19,0)")
    return stage(docs.withColumn(ROW, (number + row).cast("decimal(38,0)")))


def _by_number(numbered: DataFrame) -> DataFrame:
    """What an operator on ``doc_id`` and ``text`` gets to see."""
    return numbered.select(F.col(ROW).alias("doc_id"), "text")


def _only(numbered: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose numbers are in ``kept.doc_id``, without the numbers."""
    chosen = kept.select(F.col("doc_id").alias(ROW))
    columns = [c for c in numbered.columns if c != ROW]
    return numbered.join(chosen, ROW, "left_semi").select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the classifier does not reject, each judged by its own."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("whole"))
    scored = score_quality(rows, labels, keep=["whole"])
    return scored.filter("predicted = 1").select("whole.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, one with the smallest id; of rows with that id, any."""
    numbered = _numbered(docs)
    return _only(numbered, exact_dedup(_by_number(numbered)).filter("kept"))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, one with the smallest id."""
    numbered = _numbered(docs)
    groups = simhash_groups(_by_number(numbered), words=4, bits=4)
    return _only(numbered, groups.filter("doc_id = component_id"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets marked in their texts."""
    scanned = scan_secrets(docs).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return scanned
    length = F.coalesce(F.length("text"), F.lit(0))
    return scanned.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("simhash", simhash),
    ("secrets", secrets),
    ("packing", packing),
]

# Learned models and hashes decide here, which SQL has no form for; the tests
# hold the stages against plain versions of themselves.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
