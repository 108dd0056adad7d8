from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from clicklens.llm.packing import pack_documents
from clicklens.llm.ranks import gapless
from clicklens.llm.sharding import shard_documents


def check_shards(docs, shards):
    rows, found = docs.collect(), shard_documents(docs, shards).collect()
    total = len(rows)
    own = Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()))
        for r in rows
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == own
    slots = defaultdict(list)
    for r in found:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    for i in range(shards):
        n = total // shards + (i < total % shards)
        assert sorted(slots[i]) == list(range(n))
    return found


def test_shards_are_even_and_keep_copies_together(documents):
    found = check_shards(documents, 5)
    of = defaultdict(set)
    sizes = Counter(r["text_crc32"] for r in found)
    for r in found:
        of[r["text_crc32"]].add(r["shard"])
    pairs = [len(of[t]) for t, n in sizes.items() if n == 2]
    assert pairs and sum(n == 1 for n in pairs) >= 0.8 * len(pairs)


def test_a_group_larger_than_a_shard_is_spread(spark):
    rows = [(i, "same" if i % 3 else f"text {i}") for i in range(400)]
    found = check_shards(spark.createDataFrame(rows, "doc_id bigint, text string"), 10)
    held = Counter(r["shard"] for r in found if r["size"] == 20)
    # 266 rows fill seven shards of 40
    assert sum(n for _, n in held.most_common(7)) >= 0.9 * held.total()


def test_repeated_rows_are_numbered_without_gaps(spark):
    rows = [(1, None)] * 5000 + [(2, 7)] * 3 + [(1, i % 9) for i in range(40)]
    frame = spark.createDataFrame(rows, "part int, value int")
    assert numbers_in(gapless(frame, ["part"], ["value"], "n", 4)) == {1: 5040, 2: 3}
    whole = gapless(frame.select("value"), [], ["value"], "n", 4)
    assert numbers_in(whole.withColumn("part", F.lit(0))) == {0: 5043}


def numbers_in(found):
    held = defaultdict(list)
    for r in found.collect():
        held[r["part"]].append(r["n"])
    assert all(sorted(ns) == list(range(len(ns))) for ns in held.values())
    return {part: len(ns) for part, ns in held.items()}


def test_shards_of_odd_rows(odd_documents, no_documents, documents):
    check_shards(odd_documents, 7)
    check_shards(documents.limit(3), 40)
    assert shard_documents(no_documents).count() == 0


def check_bins(docs, capacity, part_rows):
    rows, found = docs.collect(), pack_documents(docs, capacity, part_rows).collect()
    whole = Counter(r["doc_id"] for r in rows)
    assert Counter(r["doc_id"] for r in found if r["start"] == 0) == whole
    lengths = Counter()
    for r in found:
        lengths[r["doc_id"]] += r["length"]
    for r in rows:
        assert lengths[r["doc_id"]] % whole[r["doc_id"]] == 0 or r["doc_id"] is None
    assert sum(r["length"] for r in found) == sum(len((r["text"] or "").encode()) for r in rows)
    bins = defaultdict(list)
    for r in found:
        bins[r["part"], r["bin"]].append(r)
    source = {r["doc_id"]: r["source"] for r in rows}
    text = {r["doc_id"]: (r["text"] or "").strip(" ").lower() for r in rows}
    for held in bins.values():
        held.sort(key=lambda r: (r["bin_start"], r["length"]))
        for a, b in zip(held, held[1:]):
            assert a["bin_start"] + a["length"] <= b["bin_start"]
        assert held[-1]["bin_start"] + held[-1]["length"] <= capacity
        for named in (source, text):
            inside = [named[r["doc_id"]] for r in held if r["doc_id"] is not None]
            assert len(set(inside)) == len(inside)
    return found


def test_bins(documents):
    found = check_bins(documents, 2000, 50)
    assert len({r["part"] for r in found}) > 1


def plain_best_fit(sizes, capacity):
    """``(row, chunk) -> (bin, bin_start)``: every open bin is looked at for each piece."""
    placed, residual, inside = {}, [], []
    pieces = []
    for row, (size, _, _) in enumerate(sizes):
        for chunk in range(size // capacity):
            placed[row, chunk] = (len(residual), 0)
            residual.append(0)
            inside.append(set())
        if size % capacity or not size:
            pieces.append((size % capacity, row, size // capacity))
    for length, row, chunk in sorted(pieces, key=lambda p: (-p[0], p[1])):
        _, source, cluster = sizes[row]
        own = {("source", source), ("cluster", cluster)}
        fits = [
            (residual[b], b) for b in range(len(residual))
            if residual[b] >= max(length, 1) and not inside[b] & own
        ]
        if fits:
            _, b = min(fits)
        else:
            b = len(residual)
            residual.append(capacity)
            inside.append(set())
        placed[row, chunk] = (b, capacity - residual[b])
        residual[b] -= length
        inside[b] |= own
    return placed


def test_bins_against_plain_best_fit(documents):
    text = {r["doc_id"]: (r["source"], r["text"] or "") for r in documents.collect()}
    parts = defaultdict(list)
    for r in pack_documents(documents, 1500, 60).collect():
        parts[r["part"]].append(r)
    assert len(parts) > 1
    for rows in parts.values():
        ids = sorted({r["doc_id"] for r in rows})
        sizes = [
            (len(text[i][1].encode()), text[i][0], text[i][1].strip(" ").lower()) for i in ids
        ]
        wanted = plain_best_fit(sizes, 1500)
        found = {(ids.index(r["doc_id"]), r["chunk"]): (r["bin"], r["bin_start"]) for r in rows}
        assert found == wanted


def test_copies_of_a_row_spread_over_the_parts(spark):
    rows = [(None, "same", "s")] * 9000 + [(i, f"text {i}", f"s{i % 50}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = pack_documents(docs, 64, 1000).collect()
    assert len(found) == len(rows)
    of = Counter(r["part"] for r in found if r["doc_id"] is None)
    assert of.total() == 9000 and len(of) == 12 and max(of.values()) < 900
    bins = Counter((r["part"], r["bin"]) for r in found if r["doc_id"] is None)
    assert max(bins.values()) == 1


def test_bins_are_tight(spark):
    rows = [(i, chr(97 + i) * n, f"s{i}") for i, n in enumerate([60, 50, 40, 50, 30, 70])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert len({r["bin"] for r in check_bins(docs, 100, 100)}) == 3


def test_bins_of_odd_rows(odd_documents, no_documents):
    check_bins(odd_documents, 3000, 64)
    assert pack_documents(no_documents).count() == 0
