"""The manifest against trees built node by node."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from clicklens.llm.manifest import merkle_manifest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    told = [None if x is None else str(x) for x in (doc_id, source, lang, n_chars, text)]
    return digest("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in told))


def tree(nodes):
    """Levels, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([digest("".join(low[i : i + 2])) for i in range(0, len(low), 2)])
    return levels


def climb(levels, place, found, value):
    for low in levels[:-1]:
        run = low[place // 2 * 2 : place // 2 * 2 + 2]
        found += [x for i, x in enumerate(run) if i != place % 2]
        run[place % 2] = value
        value, place = digest("".join(run)), place // 2
    return value


def plain(rows, changed):
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: tree([x[2] for x in sorted(groups[lang], key=lambda x: x[:3])]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for at, lang in enumerate(langs):
        for place, (_, _, own, row) in enumerate(sorted(groups[lang], key=lambda x: x[:3])):
            new = leaf(*row[:4], row[4] if row[4] is None else row[4] + changed(row[0]))
            found: list = []
            subroot = climb(trees[lang], place, found, new)
            root = climb(top, at, found, subroot)
            out.append(
                (row[0], own, trees[lang][-1][0], top[-1][0], digest("".join(found)), root, root == top[-1][0])
            )
    return sorted(out, key=repr)


def tables():
    rng = random.Random(2)
    ids = [rng.choice([rng.randrange(-500, 5000), rng.randrange(-(2**62), 2**62)]) for _ in range(1500)]
    rows = [
        (i, rng.choice(["", None, "é𓀀", f"text {i}"]), rng.choice(["en", "en", "en", "fr", None, "", "日"]),
         rng.choice(["a", None]), rng.choice([None, 5, -7])) for i in ids
    ]
    yield "odd", [*rows, *rows[:40], *rows[:40], *[(None, f"n{i % 30}", "en", None, 1) for i in range(90)],
                  *[(77, f"t{i}", "fr", "s", i) for i in range(50)], (1, "x" * 200_000, "long", "s", 1)]
    yield "deep", [(i * 3, str(i), "en", "s", i) for i in range(2049)] + [(5, "b", "fr", "s", 1)]
    yield "lone", [(3, "only", None, "s", 4)]
    yield "lone leaves", [(i, "t", f"l{i}", "s", 1) for i in range(5)]
    yield "many groups", [(i, "t", f"l{i % 1100}", "s", 1) for i in range(1500)]


@pytest.mark.parametrize("name, rows", list(tables()), ids=[name for name, _ in tables()])
def test_against_plain_trees(spark, name, rows):
    docs = spark.createDataFrame(rows, DOCS).withColumns(
        {c: F.lit("clash") for c in ("group", "slot", "leaf", "tampered", "word", "bits", "n", "digest", "path", "part")}
    )
    odd = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    got = merkle_manifest(docs, F.when(odd, F.col("n_chars") + 1).otherwise(F.col("n_chars")))
    want = plain(rows, lambda i: int(i is not None and i % 3 == 0))
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_untampered_rows_verify_and_no_rows_give_none(spark):
    rows = [(i, f"t{i}", "en" if i % 2 else "de", "s", i) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS)
    assert merkle_manifest(docs).filter("verified").count() == 30
    assert merkle_manifest(docs.limit(0)).count() == 0
