"""Near duplicates by SimHash and an index of byte positions."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.graph import components
from clicklens.llm.store import stage

SEED = 42
BYTES = 8
CHUNK = 1 << 16
# At most MAX_HOT posting lists are hot, so a broadcast of them stays small.
MAX_HOT = 20_000
HOT_BUCKETS = 1 << 16


def fingerprint(text: bytes, words: int = 4) -> int:
    """The 64-bit SimHash of the word shingles of a UTF-8 text."""
    found = text.lower().split()  # bytes: A-Z, and white space of ASCII only
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(found) >= words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), CHUNK):
        spans = zip(starts[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    # unpackbits gives the highest bit of the lowest byte first
    over = (2 * ones > len(starts)).reshape(8, 8)[::-1].reshape(64)
    return int.from_bytes(np.packbits(over).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed BIGINT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            prints = [fingerprint(t.as_py() or b"", words) for t in texts]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed)], ["doc_id", "fp"]
            )

    rows = docs.select("doc_id", F.col("text").cast("string"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, fp bigint")


def index_masks(bits: int, width: int = 3) -> list[int]:
    """Byte positions to index by, ``width`` at a time, as masks.

    Two fingerprints that differ in at most ``bits`` bits share at least
    ``8 - bits`` bytes in place, so that each pair with four shared bytes meets
    in a posting list: of all 70 sets of four positions, or of 20 of the 56
    triples, from a design in which every four positions hold one of them
    (Turan's).
    """
    if BYTES - bits < 4:
        raise ValueError("at most 4 bits: fewer than 4 bytes would be sure to agree")
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    lone = {(0, 0, 0), (1, 1, 1), (0, 0, 1), (1, 1, 2), (0, 2, 2)}
    masks = []
    for chosen in combinations(range(BYTES), width):
        if width == 4 or tuple(sorted(group[i] for i in chosen)) in lone:
            masks.append(sum(0xFF << (8 * i) for i in chosen))
    return masks


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def shared_bytes(a: np.ndarray, b: np.uint64) -> np.ndarray:
    """How many bytes of each fingerprint equal the byte of ``b`` in its place."""
    same = (a ^ b).reshape(-1, 1).view(np.uint8) == 0
    return same.sum(axis=1)


def _forest(prints: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """Links that connect what is linked within one posting list: a link to each
    fingerprint from the one that reached it first, not all pairs."""
    left = prints
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            # tally shared bytes, keep those with enough, verify the distance
            enough = np.flatnonzero(shared_bytes(left, at) >= BYTES - bits)
            near = enough[np.bitwise_count(left[enough] ^ at) <= bits]
            for other in left[near]:
                yield int(at), int(other)
            queue.extend(left[near])
            left = np.delete(left, near)


def postings_of(distinct: DataFrame, masks: list[int]) -> DataFrame:
    """``fp, position, value``: the posting lists that each fingerprint is in."""
    values = [F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]
    found = distinct.select(
        "fp", F.posexplode(F.array(*values)).alias("position", "value")
    )
    return found.withColumn("position", F.col("position").cast("bigint"))


def hot_lists(postings: DataFrame, limit: int, buckets: int = HOT_BUCKETS) -> DataFrame:
    """``position, value`` of every posting list longer than ``limit``.

    Lists are counted by bucket first, which shuffles ``buckets`` numbers a task
    at most; only lists in buckets that exceed the limit are counted themselves.
    """
    lists = postings.select(
        "position",
        "value",
        F.pmod(F.xxhash64("position", "value"), F.lit(buckets)).alias("bucket"),
    )
    full = lists.groupBy("bucket").count().filter(F.col("count") > limit)
    return (
        lists.join(F.broadcast(full.select("bucket")), "bucket", "left_semi")
        .groupBy("position", "value")
        .count()
        .filter(F.col("count") > limit)
        .select("position", "value")
    )


def posting_links(postings: DataFrame, bits: int, dense_limit: int) -> DataFrame:
    """``a, b, dense``: links from the posting lists of distinct fingerprints.

    A list longer than ``dense_limit`` is not compared pair by pair; its members
    come out with ``dense`` set, as they are read.
    """

    def result(a, b, dense) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.bool_()]
        columns = [pa.array(c, k) for c, k in zip((a, b, dense), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "dense"])

    def as_dense(members: np.ndarray) -> pa.RecordBatch:
        return result(members, members, np.ones(len(members), bool))

    def links(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        position, value, fp = table
        new = (np.diff(position) != 0) | (np.diff(value) != 0)
        bounds = np.concatenate([[0], np.flatnonzero(new) + 1, [len(fp)]])
        pairs = []
        for i in np.flatnonzero(np.diff(bounds) > 1):
            members = fp[bounds[i] : bounds[i + 1]]
            if len(members) > dense_limit:
                yield as_dense(members)
            else:
                pairs.extend(_forest(members.view(np.uint64), bits))
        a = [_signed(a) for a, _ in pairs]
        b = [_signed(b) for _, b in pairs]
        yield result(a, b, np.zeros(len(pairs), bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((3, 0), np.int64)  # the list that may go on in the next batch
        long = None  # the list found too long, of which members may still come
        for batch in batches:
            table = np.array([np.asarray(batch.column(i), np.int64) for i in range(3)])
            if long is not None:
                more = int(np.sum((table[:2] == long).all(axis=0)))
                if more:
                    yield as_dense(table[2, :more])
                table = table[:, more:]
            if not table.shape[1]:
                continue
            long = None
            table = np.concatenate([held, table], axis=1)
            same = (table[:2] == table[:2, -1:]).all(axis=0)
            cut = int(np.argmax(same))  # where the last list starts
            held = table[:, cut:]
            if cut:
                yield from links(table[:, :cut])
            if held.shape[1] > dense_limit:
                long = held[:2, :1]
                yield as_dense(held[2])
                held = held[:, :0]
        if held.shape[1]:
            yield from links(held)

    dealt = (
        postings.select("position", "value", "fp")
        .repartition("position", "value")
        .sortWithinPartitions("position", "value", "fp")
    )
    return dealt.mapInArrow(run, "a bigint, b bigint, dense boolean")


def midpoint_links(members: DataFrame, bits: int) -> DataFrame:
    """All links among fingerprints ``fp`` that lie densely, without pairs.

    Two are within ``bits`` bits when some value is within half of that from
    both. So each emits all values around it, equal values meet, and all that
    meet are joined to the smallest: work grows with the members, not with their
    square.
    """
    if bits != 4:
        raise ValueError("midpoints are built for 4 bits")
    flips = F.explode(F.sequence(F.lit(0), F.lit(64)))
    one = F.lit(1).cast("bigint")

    def flip(value, at):
        bit = F.call_function("shiftleft", one, at)
        return F.when(at < 64, value.bitwiseXOR(bit)).otherwise(value)

    around = (
        members.withColumn("i", flips)
        .withColumn("j", flips)
        .filter("i < j or (i = 64 and j = 64)")
        .select("fp", flip(flip(F.col("fp"), F.col("i")), F.col("j")).alias("mid"))
    )
    met = (
        around.groupBy("mid")
        .agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
        .filter("least < most")
    )
    return (
        around.join(met, "mid")
        .filter("fp > least")
        .select(F.col("fp").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def simhash_groups(
    docs: DataFrame,
    words: int = 4,
    bits: int = 4,
    dense_limit: int = 8192,
    wide_from: int = 1 << 31,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    The fingerprint (16 hex digits) is the SimHash of shingles of ``words``
    words; fingerprints that differ in at most ``bits`` bits are linked, and
    ``component_id`` is the smallest ``doc_id`` reachable over links.

    From ``wide_from`` distinct fingerprints on, posting lists are keyed by four
    bytes instead of three, so that lists stay short; both keys lose no pair.
    Lists longer than ``dense_limit`` are linked by midpoints; hot ones, which
    hold a 20,000th of all postings, are taken out before the shuffle.

    Rows with one fingerprint are one node from the start. NULL and blank texts
    have the fingerprint zero and are linked like others; shorter texts are one
    shingle. Repeated rows are returned as often as they come. A NULL id stays
    NULL and is never a ``component_id`` unless its component has no other. No
    rows give no rows; columns besides ``doc_id`` and ``text`` are not read.
    """
    prints = stage(fingerprints(docs, words))
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    rows = distinct.count()
    masks = index_masks(bits, width=4 if rows >= wide_from else 3)
    postings = postings_of(distinct.select("fp"), masks)
    hot = F.broadcast(
        stage(hot_lists(postings, max(dense_limit, rows * len(masks) // MAX_HOT)))
    )
    by = ["position", "value"]
    links = stage(
        posting_links(postings.join(hot, by, "left_anti"), bits, dense_limit)
    )
    edges = links.filter("not dense").select("a", "b")
    dense = (
        links.filter("dense")
        .select(F.col("a").alias("fp"))
        .union(postings.join(hot, by, "left_semi").select("fp"))
    )
    if not dense.isEmpty():
        edges = edges.union(midpoint_links(dense.distinct(), bits))
    roots = components(edges)
    linked = distinct.join(roots, F.col("fp") == F.col("node")).select(
        "fp", "root", "least_id"
    )
    smallest = stage(
        linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    )
    groups = stage(linked.join(smallest, "root").select("fp", "component_id"))
    owner = distinct.join(groups, "fp", "left").select(
        "fp", F.coalesce("component_id", "least_id").alias("component_id")
    )
    return prints.join(stage(owner), "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
