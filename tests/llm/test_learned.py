"""Quality and secrets: held-out accuracy, and defined results for odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from clicklens.llm.quality import fit_labelled, fit_ranking, score_quality
from clicklens.llm.labelled import SECRETS, marked_texts
from clicklens.llm.secrets import (
    MARK,
    Forest,
    candidates,
    findings,
    marked_findings,
    scan_secrets,
    scan_text,
    text_findings,
    train_forest,
)

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_held_out_documents(spark, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = score_quality(docs, labels)
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)
    assert all((r["predicted"] == 1) == (r["score"] >= 0.7) for r in rows)


def test_quality_does_not_look_at_held_out_labels(spark, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) quality"
    )
    a, b = (
        {r["doc_id"]: r["score"] for r in score_quality(docs, x).collect()}
        for x in (labels, turned)
    )
    assert a == b


def test_quality_of_odd_rows(spark, odd_documents, no_documents, labels):
    found = score_quality(odd_documents, labels).collect()
    assert len(found) == odd_documents.count()
    assert all(0 <= r["score"] <= 1 for r in found)
    assert {r["held_out"] for r in found if r["doc_id"] is None} == {False}
    nothing = score_quality(odd_documents, labels.filter("quality = 1")).collect()
    assert all(r["score"] == pytest.approx(0.7) and r["predicted"] == 1 for r in nothing)
    assert score_quality(no_documents, labels).count() == 0


def test_ranking_orders_by_the_feature_that_matters():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(400, 22))
    rows = [(int(v[3] + 0.1 * n > 0), v.tolist()) for v, n in zip(vectors, rng.normal(size=400))]
    ranking = fit_ranking(rows, 4000, 1)
    assert np.argmax(np.abs(ranking.weights)) == 3
    right = [(np.dot(v, ranking.weights) >= ranking.threshold) == bool(y) for y, v in rows]
    assert np.mean(right) > 0.9


def planted():
    rng = random.Random(6)
    rows = []
    for i in range(240):
        words = ["".join(rng.choices("aeilnorst", k=6)) for _ in range(30)]
        secret = None
        kind = i % 6
        if kind == 0:
            secret = "".join(rng.choices("0123456789abcdef", k=40))
            words.insert(9, f'token = "{secret}"')
        elif kind == 1:
            secret = "AKIA" + "".join(rng.choices("ABCDEFGHJKLMNPQR234567", k=16))
            words.insert(9, secret)
        elif kind == 2:
            secret = "".join(rng.choices("abcdefXYZ0123456789!", k=12)).strip("!")
            words.insert(9, f"password={secret}")
        elif kind == 3:
            words.insert(9, "".join(rng.choices("0123456789", k=16)))
        elif kind == 4:
            words.insert(9, f"see http://site{i}.example.com/page/{i} version 4.0.1")
        rows.append((i, " ".join(words), "src1", secret))
    return rows


def test_secrets_are_found_and_clean_texts_left_alone(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, secret string")
    found = {r["doc_id"]: r for r in scan_secrets(docs).collect()}
    for doc_id, text, _, secret in rows:
        got = found[doc_id]
        if secret is None:
            assert (got["n_secrets"], got["text"]) == (0, text)
        else:
            assert got["text"] == text.replace(secret, MARK)
            span = got["secret_spans"][0]
            assert text[span["start"] : span["end"]] == secret


def test_secrets_of_held_out_texts(spark):
    texts = marked_texts()
    random.Random(3).shuffle(texts)
    held, rest = texts[: len(texts) // 4], texts[len(texts) // 4 :]
    forest = train_forest(marked_findings(spark, rest))
    caught = missed = false = 0
    for m in held:
        _, spans, _ = scan_text(m.text, m.source, forest, 0.5)
        right = [start < m.end and m.start < end for start, end in spans]
        caught += any(right)
        missed += bool(m.secret) and not any(right)
        false += len(spans) - sum(right)
    assert caught > 80 and caught / (caught + missed) >= 0.95 and caught / (caught + false) >= 0.95


def test_labelled_texts():
    texts = marked_texts(each=4)
    secrets = [m for m in texts if m.secret]
    assert len(secrets) == 4 * len(SECRETS) < len(texts) / 2
    # every secret is a candidate, so that the forest decides on it
    found = [any(s <= m.start and e >= m.end for s, e, _ in candidates(m.text)) for m in secrets]
    assert sum(found) >= 0.95 * len(found)
    assert texts == marked_texts(each=4)


def test_findings_are_labelled_by_their_spans(spark):
    row = ("id 12345678 token=abcdef1234567 x", None, [(18, 31)])
    schema = "text string, source string, secret_spans array<struct<start:int,end:int>>"
    rows = spark.createDataFrame([row] * 50 + [(None, None, None), ("a 1234567", "s", None)], schema)
    found = findings(rows)
    assert [r["label"] for r in found.collect()] == [0, 1] * 50 + [0]
    # a finding repeated fifty times is one of the two learned from
    forest = train_forest(found, max_findings=1)
    assert forest.trees


def test_a_long_text_is_scanned_in_step_with_its_length():
    text = " ".join(f"token=k{i:09d}x and some words of prose" for i in range(20_000))
    found, vectors = text_findings(text, "")
    assert len(found) == len(vectors) == 20_000


def test_the_least_length_is_a_parameter():
    assert [n for *_, n in candidates("pw=a1 b2c3", 6)] == ["pw"]
    assert len(list(candidates("pw=a1 b2c3", 4))) == 2


def test_key_blocks():
    text = "a -----BEGIN RSA PRIVATE KEY-----\nMIIB\n-----END RSA PRIVATE KEY----- b"
    (start, end, name), *rest = candidates(text)
    assert name == "BEGIN" and text[start:end].endswith("KEY-----") and not rest


def test_secrets_of_odd_rows(odd_documents, no_documents):
    found = scan_secrets(odd_documents, Forest([], 0.0))
    assert found.count() == odd_documents.count()
    added = ["n_candidates", "n_secrets", "secret_spans"]
    assert found.columns == [*odd_documents.columns, *added]
    clashing = odd_documents.selectExpr("*", "'clash' AS n_secrets")
    assert dict(scan_secrets(clashing, Forest([], 0.0)).dtypes)["n_secrets"] == "int"
    old = sorted(r["text"] or "" for r in odd_documents.collect())
    assert sorted(r["text"] or "" for r in found.collect()) == old
    assert scan_secrets(no_documents).count() == 0


def test_quality_learns_from_every_label(spark):
    """Good documents only among the last 400 of 20,400 by the hash of their ids."""
    ids = spark.range(28_000).selectExpr("id doc_id", "xxhash64(id) h").filter(
        "crc32(cast(id as string)) % 4 != 2"
    )
    last = {r["doc_id"] for r in ids.orderBy("h").limit(20_400).collect()[20_000:]}
    known = [r["doc_id"] for r in ids.orderBy("h").limit(20_400).collect()]
    rows = [
        (i, "some plain words of a text" if i in last else "#### 12 $$ || 345", int(i in last))
        for i in known
    ]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    found = score_quality(table.drop("quality"), table.drop("text")).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"] for r in found if r["predicted"]} == last


def labelled_vectors(n, rare=2):
    rng = np.random.default_rng(2)
    vectors = np.round(rng.normal(size=(n, 22)), 2)
    vectors[1 :: 5] = vectors[0]  # many copies of one
    noise = rng.normal(size=n)
    return [
        (int(v[3] + 0.5 * e > 0 if i % rare else v[3] > 9), v.astype(np.float32).tolist())
        for i, (v, e) in enumerate(zip(vectors, noise))
    ]


def test_ranking_over_tables_is_that_of_all_pairs(spark):
    rows = labelled_vectors(600)
    table = spark.createDataFrame(rows, "quality int, features array<float>")
    good, bad = (np.array([v for y, v in rows if y == label]) for label in (1, 0))
    pairs = (good[:, None, :] - bad[None, :, :]).reshape(-1, 22)
    spread = np.array([v for _, v in rows]).std(axis=0) + 1e-3
    found = fit_labelled(table)
    weights = np.array(found.weights)
    # where the plain loss of all pairs is flat
    missed = 1 / (1 + np.exp(pairs @ weights))
    assert np.abs((pairs / spread * missed[:, None]).mean(axis=0) - 1e-4 * weights * spread).max() < 1e-5
    alone = fit_ranking(rows, len(pairs), 1)
    assert found.weights == pytest.approx(alone.weights, abs=2e-6)
    assert found.threshold == pytest.approx(alone.threshold, abs=1e-4)
    assert found.scale == pytest.approx(alone.scale, rel=1e-4)


def test_ranking_by_blocks_and_with_a_rare_label(spark):
    for rare in (2, 1):
        rows = labelled_vectors(4000) if rare == 2 else [
            (y if i < 60 else 0, v) for i, (y, v) in enumerate(labelled_vectors(4000))
        ]
        table = spark.createDataFrame(rows, "quality int, features array<float>")
        whole = fit_labelled(table)
        blocks = fit_labelled(table.repartition(3), block_rows=256)
        assert blocks == fit_labelled(table.repartition(7), block_rows=256)
        a, b = (np.array([np.dot(v, r.weights) for _, v in rows]) for r in (whole, blocks))
        assert np.corrcoef(a, b)[0, 1] > 0.98
