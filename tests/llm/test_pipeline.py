"""The pipeline's stages on a small table, each against what it should leave."""

from __future__ import annotations

import pytest

import __spark_entry__
import corpus_pipeline
from clicklens.llm.quality import score_quality
from clicklens.llm.simhash import fingerprint
from catalog.compare import canonical
from tests.llm.test_duplicates import groups_of, lower

import duckdb

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def left(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    results = [docs]
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        results.append(docs)
    return results


def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def test_columns(left):
    assert all(docs.columns == left[0].columns for docs in left[:-1])
    assert [dict(d.dtypes) for d in left[1:-1]] == [dict(left[0].dtypes)] * 4


def test_stages(spark, left):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in score_quality(left[0], labels).collect() if r["predicted"]}
    assert set(texts(left[1])) == good & set(texts(left[0]))

    first: dict[str, int] = {}
    for i, t in sorted(texts(left[1]).items()):
        first.setdefault(lower(t), i)
    assert set(texts(left[2])) == set(first.values())

    prints = {i: fingerprint(t.encode()) for i, t in texts(left[2]).items()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    assert set(texts(left[3])) == set(groups_of(prints, links).values())

    assert set(texts(left[4])) == set(texts(left[3]))
    assert {r["doc_id"] for r in left[5].collect()} == set(texts(left[4]))
    run = corpus_pipeline.run(spark, SF)
    assert run.exceptAll(left[5]).isEmpty() and left[5].exceptAll(run).isEmpty()


def test_stages_with_odd_rows(spark, odd_documents, no_documents):
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, no_documents, SF).count() == 0, name
        found = step(spark, odd_documents, SF)
        assert found.count() > 0, name
        if name != "packing":
            assert found.columns == odd_documents.columns, name


def test_rows_that_share_an_id(spark):
    """One row of each text stays, whatever ids the rows have."""
    texts = {name: f"{name} " + " ".join(f"{name}{i}" for i in range(30)) for name in "ABC"}
    rows = [(1, "A"), (1, "A"), (2, "B"), (3, "A"), (2, "A"), (None, "C"), (None, "C"), (None, "B")]
    docs = spark.createDataFrame(
        [(i, texts[t], "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
    for step in (corpus_pipeline.exact, corpus_pipeline.simhash):
        left = sorted((r["text"][0], r["doc_id"]) for r in step(spark, docs, SF).collect())
        assert left == [("A", 1), ("B", 2), ("C", None)]
    judged = corpus_pipeline.quality(spark, docs, SF)
    assert judged.count() in {sum(t in kept for _, t in rows) for kept in ("", "A", "B", "C", "AB", "AC", "BC", "ABC")}


def test_queries_against_their_sql(spark):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    for name, sql in __spark_entry__.oracle_sql().items():
        if name.startswith("op"):
            df = __spark_entry__.queries()[name](spark, SF)
            result = con.execute(sql)
            columns = [d[0] for d in result.description]
            assert canonical(df.columns, df.collect()) == canonical(columns, result.fetchall())
