"""Packing documents into bins of fixed size, best fit under conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTPUT = (
    "doc_id bigint, chunk int, start bigint, length bigint,"
    " part int, bin bigint, bin_start bigint"
)


def pack_part(rows: pd.DataFrame, capacity: int) -> Iterator[tuple]:
    """Best fit, largest first: ``row, chunk, start, length, bin, bin_start``.

    Open bins are kept in order of their residual space, and carry a bitmap of
    the sources and one of the clusters they hold. For each piece the search
    starts at the tightest bin it fits and goes on to the successor while that
    one holds its source or its cluster.
    """
    bits: dict = {}

    def bit(kind: str, value) -> int:
        return 1 << bits.setdefault((kind, value), len(bits))

    bins = 0
    rest = []
    for row, size in enumerate(rows["size"].tolist()):
        full, last = divmod(size, capacity)
        for chunk in range(full):
            yield row, chunk, chunk * capacity, capacity, bins, 0
            bins += 1
        if last or not full:
            rest.append((-last, row, full))
    rest.sort()

    sources, clusters = rows["source"].tolist(), rows["cluster"].tolist()
    order: list[tuple[int, int]] = []  # (residual, bin), tightest first
    held: dict[int, tuple[int, int]] = {}
    for negative, row, chunk in rest:
        length = -negative
        source, cluster = bit("s", sources[row]), bit("c", clusters[row])
        at = bisect_left(order, (length, -1))
        while at < len(order):
            in_bin = held[order[at][1]]
            if not (in_bin[0] & source or in_bin[1] & cluster):
                break
            at += 1
        if at < len(order):
            residual, number = order.pop(at)
        else:
            residual, number = capacity, bins
            held[number] = (0, 0)
            bins += 1
        yield row, chunk, chunk * capacity, length, number, capacity - residual
        held[number] = (held[number][0] | source, held[number][1] | cluster)
        if residual > length:
            insort(order, (residual - length, number))


def pack_documents(
    docs: DataFrame, capacity: int = 8192, part_rows: int = 4096
) -> DataFrame:
    """Where each piece of each document goes.

    Returns ``doc_id, chunk, start, length`` (bytes of the UTF-8 text), the bin
    (``part``, ``bin``) and the place in it (``bin_start``). A document longer
    than ``capacity`` bytes fills bins of its own, and its last piece is packed
    like a short one. No bin holds two packed pieces of one source, nor of one
    duplicate cluster (texts equal but for case and outer white space).

    Documents are dealt by hash into parts of about ``part_rows``, each packed
    in one task; the parts grow in number with the table. A source that holds a
    third of all rows opens a bin for each of its documents, which the others
    then fill. Repeated rows are counted before the shuffle, and their copies
    are dealt evenly over all parts.

    NULL and empty texts are pieces of length 0. A NULL source is a source like
    others. Repeated rows are packed each, in different bins. NULL ids pass
    through. No rows give no rows; columns besides ``doc_id``, ``text`` and
    ``source`` are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("source"),
        F.xxhash64(F.lower(F.trim(text))).alias("cluster"),
    )
    parts = max(1, -(-docs.count() // part_rows))
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("all"))
    # a row goes to as many parts as it has copies, or to every part several times
    turn = F.explode(F.sequence(F.lit(0), F.least("all", F.lit(parts)) - 1))
    first = F.pmod(F.xxhash64(*rows.columns), F.lit(parts))
    one_more = F.col("turn") < F.col("all") % parts
    dealt = counted.withColumn("turn", turn).select(
        *rows.columns,
        (F.expr(f"`all` div {parts}") + one_more.cast("bigint")).alias("copies"),
        ((first + F.col("turn")) % parts).cast("int").alias("part"),
    )

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "cluster", "source", "size"])
        group = group.loc[group.index.repeat(group["copies"])]
        found = pd.DataFrame(
            pack_part(group, capacity),
            columns=["row", "chunk", "start", "length", "bin", "bin_start"],
        )
        ids = group["doc_id"].astype("Int64").reset_index(drop=True)
        found["doc_id"] = ids.take(found["row"]).reset_index(drop=True)
        found["part"] = key[0]
        names = [field.split()[0] for field in OUTPUT.split(",")]
        return found[names]

    return dealt.groupBy("part").applyInPandas(run, OUTPUT)
