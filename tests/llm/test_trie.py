"""Trie nodes against prefixes counted one by one."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clicklens.llm.scan import running
from clicklens.llm.trie import conversation_trie, order_turns, prefix_trie, with_family_heads

TURNS = "conv_id bigint, turn bigint, role string, text string"


def told(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def rebuilt(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, told(role, text), (role or "", text or "")))
    plain = {c: [x[3] for x in sorted(turns)] for c, turns in convs.items()}
    for c, turns in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        yield c, plain.get(c - c % 100, [])[:h] + turns[h:]


def nodes(rows):
    whole = dict(rebuilt(rows))
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(whole[c]) == len(p))
        out.append(
            (min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def table():
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 420, 2), *range(1000, 1100), 7700, 7750, 5 * 10**12]:
        length = rng.choice([0, 1, 2, 3, 5, 8, 9])
        start = [("system", "be kind"), ("user", f"q{c % 3}")]
        for turn in range(length):
            role, text = start[turn] if turn < 2 else (rng.choice(["user", None]), rng.choice(["a", "bb é𓀀", None, ""]))
            rows.append((c, turn, role, text))
    rows += [(9000, t, "user", f"long {t}") for t in range(150)]
    rows += [(9001 + i, t, "user", f"common {t}") for i in range(30) for t in range(40)]
    rows += [(9500 + i, t, "user", "comb") for i in range(12) for t in range(i)]
    # ties, repeated rows and NULLs
    rows += [(8800, None, "user", f"n{i % 4}") for i in range(9)] + [(8800, 3, "x", "same")] * 3
    rows += [(None, 1, "user", "nobody"), (None, None, None, None), (8801, 2**62, "", "far"), (8801, -(2**62), "", "near")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return table()


def test_against_counted_prefixes(spark, rows):
    df = spark.createDataFrame(rows, TURNS).withColumns(
        {c: F.lit("clash") for c in ("position", "key", "depth", "n", "ends", "a", "b", "block_", "part", "copies")}
    )
    got = conversation_trie(df)
    assert sorted(map(tuple, got.collect()), key=repr) == nodes(rows)


@pytest.mark.parametrize("max_sequences, max_turns", [(1, 10**9), (3, 20), (10**9, 10**9)])
def test_limits_of_containers_change_nothing(spark, rows, max_sequences, max_turns):
    few = [row for row in rows if row[0] is None or row[0] != 9000]
    turns, convs = with_family_heads(order_turns(spark.createDataFrame(few, TURNS)), 100, 6)
    got = prefix_trie(turns, convs, max_sequences, max_turns)
    assert sorted(map(tuple, got.collect()), key=repr) == nodes(few)


def test_a_long_conversation_is_a_chain(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (9001, 9002) for t in range(20_000)]
    got = conversation_trie(spark.createDataFrame(rows, TURNS), heads=1).cache()
    assert got.filter("n_convs = 2 AND n_leaves = 1 AND conv_id = 9001").count() == 20_001
    assert got.filter("depth = 20000 AND n_children = 0 AND saved_tokens = 10").count() == 1


def test_no_turns_and_one_turn(spark):
    assert conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    for rows in ([(100, 0, "user", "a")], [(101, 0, "user", "a")]):
        got = conversation_trie(spark.createDataFrame(rows, TURNS))
        assert sorted(map(tuple, got.collect()), key=repr) == nodes(rows)


def test_running_totals(spark):
    rng = random.Random(5)
    rows = [(g, p, rng.randrange(-9, 9)) for g in (1, 2) for p in rng.sample(range(-50_000, 50_000), 300)]
    df = spark.createDataFrame(rows, "g bigint, p bigint, v bigint")
    got = running(df, ["g"], "p", {"total": ("sum", F.col("v")), "mixed": ("xor", F.col("v"))}).collect()
    for row in got:
        before = [v for g, p, v in rows if g == row.g and p <= row.p]
        mixed = 0
        for v in before:
            mixed ^= v
        assert (row.total, row.mixed) == (sum(before), mixed)
