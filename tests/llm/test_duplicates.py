"""Exact, SimHash and line duplicates against plain versions of themselves."""

from __future__ import annotations

import hashlib
import random
import re
from decimal import Decimal

import pytest
import xxhash
from pyspark.sql import functions as F

from clicklens.llm.exact import exact_dedup, merge_runs
from clicklens.llm.graph import components
from clicklens.llm.lines import _neighbourhood, document_lines, mark_lines, split_lines, without_lines
from clicklens.llm import simhash
from clicklens.llm.simhash import (
    fingerprint,
    hot_lists,
    index_masks,
    midpoint_links,
    posting_links,
    postings_of,
    simhash_groups,
)

MASK = 2**64 - 1


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def groups_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact(documents, keep):
    rows = [(r["doc_id"], lower(r["text"] or "")) for r in documents.collect()]
    pick = min if keep == "smallest" else max
    wanted = set()
    for doc_id, text in rows:
        same = [i for i, t in rows if t == text]
        digest = hashlib.sha256(text.encode()).hexdigest()
        wanted.add((doc_id, pick(same), len(same), doc_id == pick(same), digest))
    found = exact_dedup(documents, keep=keep, runs=8, fan_in=2).collect()
    assert {tuple(r) for r in found} == wanted and len(found) == len(rows)


def test_runs_are_sorted_and_merged_in_rounds(spark, capsys):
    rows = spark.range(60).selectExpr(
        "id AS doc_id", "unhex(sha2(cast(id % 7 AS string), 256)) AS digest",
        "cast(id % 7 AS int) AS n_bytes", "id % 14 AS check_hash",  # seven digests, twice as many texts
    )
    merged = merge_runs(rows, "smallest", runs=8, fan_in=2)
    merged.explain()
    plan = capsys.readouterr().out
    # a shuffle for the first runs and one a round, each sorted once and not hashed
    assert (plan.count("Exchange"), plan.count("HashAggregate")) == (4, 2)
    assert plan.count("Sort [") == 3 and plan.count("+- Sort [run") == 3
    found = {r["keep_id"]: r["group_size"] for r in merged.collect()}
    assert found == {i: len(range(i, 60, 14)) for i in range(14)}


def test_exact_with_odd_rows(odd_documents, no_documents):
    found = exact_dedup(odd_documents)
    assert found.count() == odd_documents.count()
    lone = {r["kept"] for r in found.filter("doc_id is null").collect()}
    assert lone == {False}  # both texts also come with an id
    assert exact_dedup(no_documents).count() == 0


def plain_fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles if words]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_one_of_spark_hashes(spark, documents):
    for row in documents.filter("length(text) < 2000").limit(60).collect():
        text = row["text"] or ""
        assert fingerprint(text.encode()) == plain_fingerprint(text)
    ours = spark.range(1).select(F.xxhash64(F.lit("a b c é"))).first()[0] & MASK
    assert fingerprint("a b c é".encode()) == ours


@pytest.mark.parametrize("dense_limit, wide_from, max_hot", [(8192, 1 << 31, 20_000), (2, 0, 20_000), (2, 1 << 31, 1)])
def test_simhash_groups(documents, monkeypatch, dense_limit, wide_from, max_hot):
    monkeypatch.setattr(simhash, "MAX_HOT", max_hot)
    prints = {r["doc_id"]: fingerprint((r["text"] or "").encode()) for r in documents.collect()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    wanted = groups_of(prints, links)
    found = simhash_groups(documents, dense_limit=dense_limit, wide_from=wide_from).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted
    assert {r["doc_id"]: r["fingerprint"] for r in found} == {i: f"{p:016x}" for i, p in prints.items()}


@pytest.mark.parametrize("width, lists", [(3, 20), (4, 70)])
def test_every_pair_within_four_bits_meets_in_the_index(width, lists):
    masks, rng = index_masks(4, width), random.Random(1)
    assert len(masks) == lists
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << i for i in rng.sample(range(64), 4))
        assert any(a & m == b & m for m in masks)


def test_lists_longer_than_a_limit_are_counted_before_the_shuffle(spark):
    rng = random.Random(3)
    lengths = {(rng.randrange(3), rng.getrandbits(60)): rng.randint(1, 30) for _ in range(200)}
    rows = [(*key, i) for key, n in lengths.items() for i in range(n)]
    postings = spark.createDataFrame(rows, "position bigint, value bigint, fp bigint")
    for buckets in (1, 16, 1 << 16):
        found = {tuple(r) for r in hot_lists(postings, 20, buckets).collect()}
        assert found == {key for key, n in lengths.items() if n > 20}


@pytest.mark.parametrize("batch_rows", [3, 1000])
def test_long_lists_come_out_dense_over_any_batches(spark, batch_rows):
    # 20 members that differ in one byte, far apart; a pair one bit apart elsewhere
    prints = [i * 0x13 & 0xFF for i in range(20)] + [7 << 40, 7 << 40 | 1 << 33]
    rows = spark.createDataFrame([(p,) for p in set(prints)], "fp bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        found = posting_links(postings_of(rows, index_masks(4)), 4, 10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["a"] for r in found if r["dense"]} >= set(prints[:20])
    assert {frozenset(r[:2]) for r in found if not r["dense"]} >= {frozenset(prints[20:])}


def test_midpoints_link_what_lies_within_four_bits(spark):
    rng = random.Random(2)
    base = rng.getrandbits(62)
    prints = {base ^ sum(1 << i for i in rng.sample(range(60), rng.randint(0, 6))) for _ in range(25)}
    rows = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    found = [(r["a"], r["b"]) for r in midpoint_links(rows, 4).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    links = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    assert groups_of(prints, found) == groups_of(prints, links)


def test_simhash_with_odd_rows(odd_documents, no_documents):
    found = simhash_groups(odd_documents)
    assert found.count() == odd_documents.count()
    blank = found.filter(F.col("fingerprint") == "0" * 16).select("component_id").distinct()
    assert [r[0] for r in blank.collect()] == [0]
    assert simhash_groups(no_documents).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, i) for i in range(200, 400)] + [(500, i) for i in range(501, 700)]
    other = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    edges = path + star + other
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["root"] for r in found} == groups_of(nodes, edges)


def within_one_word(a: list[str], b: list[str]) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def test_lines(spark):
    rng = random.Random(5)
    base = ["a b c d e f g", "x y z", "one two three four five", "p q r s t u v w", "m n o p q"]
    lines = []
    for _ in range(150):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = rng.choice([[], ["new"], [rng.choice("abc")]])
            words = words or ["left"]
        lines.append(" ".join(words) if rng.random() > 0.05 else "")
    docs = [(i, "\n".join(lines[i * 5 : i * 5 + 5])) for i in range(30)]
    order = [line for _, text in docs for line in text.split("\n")]
    gone = []
    for i, line in enumerate(order):
        words = line.split(" ")
        near = any(
            other == line
            or (min(len(words), len(other.split(" "))) >= 5 and within_one_word(words, other.split(" ")))
            for other in order[:i]
        )
        gone.append(bool(line.strip()) and near)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    per_document = document_lines(mark_lines(frame))
    found = {r["doc_id"]: r["removed"] for r in per_document.collect()}
    wanted = {i: [j for j in range(5) if gone[i * 5 + j]] for i, _ in docs}
    assert found == wanted and any(wanted.values())
    left = {r["doc_id"]: r["text"] for r in without_lines(frame, per_document).collect()}
    assert left == {
        i: "\n".join(x for j, x in enumerate(t.split("\n")) if j not in wanted[i]) for i, t in docs
    }


def test_words_of_a_line_are_sorted_once_and_not_by_decimals(spark):
    texts = ["a b c d e f", "a b x d e f", "a b d e f", "ä  𓀀 b c d", "ä  𓀀 b c", " a b c d e f", "a b c d e g h"]
    counted = split_lines(spark.createDataFrame([(1, "\n".join(texts))], "doc_id bigint, text string"))
    assert {r["line"]: r["words"] for r in counted.collect()} == {t: len(t.split(" ")) for t in texts}
    rows = [(i, Decimal(10**28 + i), len(t.split(" ")), t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "number bigint, place decimal(38,0), words int, line string")
    keys = _neighbourhood(frame)
    tree = keys._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bWindow \[", tree)) == 1
    assert re.findall(r"\bSort \[(\w+)#", tree) == ["number"]
    at = [(int(r["place"]) - 10**28, r["kind"], r["key"]) for r in keys.collect()]
    met = {(a, b) for a, kind, key in at for b, other, same in at if a < b and key == same and (kind, other) in ((0, 0), (1, 2), (2, 1))}
    words = [t.split(" ") for t in texts]
    assert met == {
        (a, b)
        for a in range(len(texts))
        for b in range(a + 1, len(texts))
        if min(len(words[a]), len(words[b])) >= 5 and within_one_word(words[a], words[b])
    } and len(met) > 3


def test_lines_with_odd_rows(odd_documents, no_documents):
    marked = mark_lines(odd_documents)
    sizes = odd_documents.select(F.size(F.split(F.coalesce("text", F.lit("")), "\n")).alias("n"))
    assert marked.count() == sizes.agg(F.sum("n")).first()[0]
    assert mark_lines(no_documents).count() == 0


def test_lines_of_rows_that_share_an_id(spark):
    first, near = "the quick brown fox jumps over", "the quick brown fox jumps under"
    for ids in ([1, 5, 6], [1, 5, 5], [None, None, None], [1, None, None], [2, 2, 2]):
        rows = list(zip(ids, [first, near, "something else that is long enough"]))
        docs = spark.createDataFrame([*rows, rows[1]], "doc_id bigint, text string")
        found = document_lines(mark_lines(docs))
        assert found.count() == 4
        gone = without_lines(docs, found).groupBy("text").count().collect()
        left = sorted(r["text"] for r in gone)
        # one of the two stays, by id or else by hash
        assert len(left) == 3 and left[0] == "" and left[1] == rows[2][1], ids
        if ids[0] == 1:
            assert left[2] == first
