from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def texts() -> list[str | None]:
    """Ties, copies, near copies, nulls, blanks and a very long text."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdeghilmnorst", k=rng.randint(2, 9))) for _ in range(300)]
    made: list[str | None] = [None, "", " \n\t ", "one", "two words", "ÄÖ é 日本 𓀀"]
    for _ in range(30):
        words = rng.choices(vocabulary, k=rng.randint(5, 120))
        text = " ".join(words)
        made += [text, text.upper() if rng.random() < 0.3 else text]
        words[rng.randrange(len(words))] = "changed"
        made.append(" ".join(words))
        made.append("\n".join([" ".join(words[:20]), " ".join(words[20:]), "a shared line of six words"]))
    made.append(" ".join(rng.choices(vocabulary, k=30_000)))
    made += ["the same text again"] * 40
    return made


@pytest.fixture(scope="session")
def documents(spark):
    rows = [(i, t, "en", f"src{i % 7 if i % 3 else 0}", len(t or "")) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, DOCS).cache()


@pytest.fixture(scope="session")
def odd_documents(spark, documents):
    """NULLs in every column, repeated rows, and columns named like results."""
    clashing = (
        "component_id fingerprint keep_id kept group size digest shard slot piece place"
        " words halves score predicted features cluster part bin chunk node root fp"
        " class_id level run chosen_id"
    ).split()
    rows = documents.unionByName(documents.limit(9)).union(
        spark.createDataFrame([(None, "one", None, None, None), (None, None, None, None, None)] * 2, DOCS)
    )
    return rows.withColumns({name: F.lit("clash") for name in clashing}).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
