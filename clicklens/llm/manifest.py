"""Merkle manifest of a table: a digest per row, a proof per digest, one root.

Where a leaf stands in its group comes from compressed bitmaps of the group's ids
(64-bit words, empty ones left out) under a directory of running counts: the rank
of an id is the count before its word and the bits set below it in the word. No
rows are sorted for it. Slots are then gathered into arrays of 1024, each reduced
ten levels in one go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.store import stage
from clicklens.operators.skew import ordered_scan

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WORD_BITS = 6
ARRAY_BITS = 10
# Leaves of one id are cut by this many hex digits before any are ordered.
TIE_DIGITS = 4
TOP = "top"
NODE = "group string, slot bigint, n bigint, digest string"


# --- leaves -----------------------------------------------------------------


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(**fields: Column) -> Column:
    """SHA-256 of the fields, each with its length before it, ``-`` for NULL."""
    return F.sha2(F.concat(*[_field(fields[name]) for name in FIELDS]), 256)


def group_key(lang: Column) -> Column:
    """Never NULL, and ordered as the languages are, NULL first."""
    return F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), lang))


# --- ranks from bitmaps -----------------------------------------------------


def _bit(doc_id: Column) -> Column:
    return doc_id.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")


def id_bitmaps(leaves: DataFrame) -> DataFrame:
    """``group, word, bits, repeats, before``: the words of each group's bitmap.

    ``repeats`` lists the bits that stand for several rows and how many more;
    ``before`` counts the rows of all lower words.
    """
    counted = (
        leaves.filter("doc_id IS NOT NULL")
        .groupBy("group", "doc_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    bit = _bit(F.col("doc_id"))
    words = counted.groupBy(
        "group", F.shiftright("doc_id", WORD_BITS).alias("word")
    ).agg(
        F.expr(f"bit_or(shiftleft(1L, CAST(doc_id & {(1 << WORD_BITS) - 1} AS INT)))").alias("bits"),
        F.collect_list(
            F.when(
                F.col("rows") > 1,
                F.struct(bit.alias("bit"), (F.col("rows") - 1).alias("more")),
            )
        ).alias("repeats"),
        F.sum("rows").alias("rows"),
    )
    return ordered_scan(stage(words), ["group"], "word", "rows").select(
        "group", "word", "bits", "repeats", (F.col("running") - F.col("rows")).alias("before")
    )


def rank_in_word() -> Column:
    """Rows of a word that come before the id of ``bit_``, from its bitmap."""
    below = F.expr("~shiftleft(-1L, bit_)")
    more = F.aggregate(
        F.filter("repeats", lambda r: r["bit"] < F.col("bit_")),
        F.lit(0).cast("bigint"),
        lambda total, r: total + r["more"],
    )
    return F.bit_count(F.col("bits").bitwiseAND(below)) + more


def leaf_slots(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``slot``, their place in the group, and ``n``, its size.

    The order is by ``doc_id``, NULL first; rows of one id are ordered by digest,
    among as many parts as the digest's first digits tell apart.
    """
    words = stage(id_bitmaps(leaves))
    sizes = leaves.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nulls"),
    )
    several = stage(
        leaves.groupBy("group", "doc_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select(F.col("group").alias("group_"), F.col("doc_id").alias("doc_id_"))
    )
    same = (F.col("group") == F.col("group_")) & F.col("doc_id").eqNullSafe(F.col("doc_id_"))
    single = leaves.join(several, same, "left_anti").withColumn("tie", F.lit(0).cast("bigint"))
    tied = _numbered_ties(leaves.join(several, same, "left_semi"))

    rows = single.unionByName(tied.select(*single.columns))
    word, bit = F.shiftright("doc_id", WORD_BITS), _bit(F.col("doc_id"))
    known = (
        rows.filter("doc_id IS NOT NULL")
        .withColumns({"word": word, "bit_": bit})
        .join(words, ["group", "word"])
        .withColumn("rank", F.col("before") + rank_in_word())
        .select(*rows.columns, "rank")
    )
    unknown = rows.filter("doc_id IS NULL").withColumn("rank", F.lit(None).cast("bigint"))
    return (
        known.unionByName(unknown)
        .join(sizes, "group")
        .select(
            *leaves.columns,
            (F.coalesce(F.col("nulls") + F.col("rank"), F.lit(0)) + F.col("tie")).alias("slot"),
            "n",
        )
    )


def _numbered_ties(rows: DataFrame) -> DataFrame:
    """Rows that share group and id with ``tie``: 0, 1, ... by digest."""
    one_id = ["group", "doc_id"]
    equal = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    equal = stage(equal).withColumn("part", F.substring("leaf", 1, TIE_DIGITS))
    lower = Window.partitionBy(*one_id).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = equal.groupBy(*one_id, "part").agg(F.sum("copies").alias("rows")).select(
        *[F.col(c).alias(f"{c}_") for c in (*one_id, "part")],
        F.coalesce(F.sum("rows").over(lower), F.lit(0)).alias("start"),
    )
    inside = (
        Window.partitionBy(*one_id, "part")
        .orderBy("leaf")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    same = (
        (F.col("group") == F.col("group_"))
        & F.col("doc_id").eqNullSafe(F.col("doc_id_"))
        & (F.col("part") == F.col("part_"))
    )
    placed = equal.withColumn(
        "earlier", F.coalesce(F.sum("copies").over(inside), F.lit(0))
    ).join(parts, same)
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))
    return placed.withColumn("copy", copy).select(
        *rows.columns, (F.col("start") + F.col("earlier") + F.col("copy")).alias("tie")
    )


# --- levels -----------------------------------------------------------------


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def array_levels(digests: list[str], n: int) -> list[list[str]]:
    """All levels of one slot array in a group of ``n`` nodes, lowest first."""
    levels = [digests]
    for _ in range(min(ARRAY_BITS, (n - 1).bit_length())):
        low = levels[-1]
        levels.append([_digest("".join(low[i : i + 2])) for i in range(0, len(low), 2)])
    return levels


def siblings(levels: list[list[str]], place: int) -> list[str]:
    """What a node meets on its way up: ``<`` or ``>`` and the sibling, which
    stands left or right of it, or ``=`` where it stands alone."""
    found = []
    for low in levels[:-1]:
        other = place ^ 1
        found.append(("<" if other < place else ">") + low[other] if other < len(low) else "=")
        place >>= 1
    return found


def folded(digest: str, path: Iterable[str]) -> str:
    """The root that a digest and its path lead to."""
    for step in path:
        side, other = step[0], step[1:]
        digest = _digest(other + digest if side == "<" else digest + other)
    return digest


def _sorted_array(table: pa.Table) -> tuple[list[dict], list[list[str]]]:
    rows = sorted(table.to_pylist(), key=lambda row: row["slot"])
    return rows, array_levels([row["digest"] for row in rows], rows[0]["n"])


def _reduce_array(table: pa.Table) -> pa.Table:
    rows, levels = _sorted_array(table)
    n = rows[0]["n"]
    return pa.table(
        {
            "group": [rows[0]["group"]],
            "slot": [rows[0]["slot"] >> ARRAY_BITS],
            "n": [-(-n >> ARRAY_BITS) if n > 1 else 1],
            "digest": [levels[-1][0]],
        }
    )


def _paths_of_array(nodes: pa.Table, above: pa.Table) -> pa.Table:
    if not nodes.num_rows:
        return pa.table({"group": pa.array([], pa.string()), "slot": pa.array([], pa.int64()), "path": pa.array([], pa.string())})
    rows, levels = _sorted_array(nodes)
    rest = above["path"][0].as_py()
    return pa.table(
        {
            "group": [row["group"] for row in rows],
            "slot": [row["slot"] for row in rows],
            "path": [",".join([*siblings(levels, i), *([rest] if rest else [])]) for i in range(len(rows))],
        }
    )


def _array(slot: str = "slot") -> Column:
    return F.shiftright(slot, ARRAY_BITS).alias("array")


def reduced(nodes: DataFrame) -> list[DataFrame]:
    """All stages of ``group, slot, n, digest``, ten levels apart, the last with
    one node a group."""
    stages = [nodes]
    while (stages[-1].agg(F.max("n")).first()[0] or 0) > 1:
        up = stages[-1].select("group", "slot", "n", "digest")
        stages.append(stage(up.groupBy("group", _array()).applyInArrow(_reduce_array, NODE)))
    return stages


def _per_array(
    nodes: DataFrame, above: DataFrame, run: Callable, schema: str
) -> DataFrame:
    """Slot arrays with the row of the node that each of them was reduced to."""
    arrays = nodes.groupBy("group", _array())
    return arrays.cogroup(above.groupBy("group", F.col("slot").alias("array"))).applyInArrow(
        run, schema
    )


def paths(stages: list[DataFrame], top: DataFrame) -> DataFrame:
    """Paths of the nodes of the first stage, from those of the last."""
    for nodes in reversed(stages[:-1]):
        own = nodes.select("group", "slot", "n", "digest")
        top = stage(_per_array(own, top, _paths_of_array, "group string, slot bigint, path string"))
    return top


def numbered_groups(groups: DataFrame) -> DataFrame:
    """Groups in order, ``slot`` 0, 1, ...: ranges of them are sorted apart."""
    cut = stage(
        groups.repartitionByRange("group").withColumn("part", F.spark_partition_id())
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per range: as many as there are shuffle partitions
    starts = cut.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("part").orderBy("group")
    return (
        cut.withColumn("row", F.row_number().over(inside))
        .join(starts, "part")
        .select(*groups.columns, (F.col("start") + F.col("row") - 1).alias("slot"))
    )


def _proofs_of_array(root: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(leaves: pa.Table, above: pa.Table) -> pa.Table:
        out = {name: [] for name in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")}
        if leaves.num_rows:
            rows, levels = _sorted_array(leaves)
            rest, subroot = above["path"][0].as_py(), above["subroot"][0].as_py()
            shared = rest.split(",") if rest else []
            for place, row in enumerate(rows):
                path = [*siblings(levels, place), *shared]
                again = folded(row["tampered"], path)
                out["doc_id"].append(row["doc_id"])
                out["leaf"].append(row["digest"])
                out["subroot"].append(subroot)
                out["root"].append(root)
                out["proof_sha256"].append(_digest("".join(step[1:] for step in path)))
                out["folded_root"].append(again)
                out["verified"].append(again == root)
        types = {"doc_id": pa.int64(), "verified": pa.bool_()}
        return pa.table({name: pa.array(values, types.get(name, pa.string())) for name, values in out.items()})

    return run


def merkle_manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """A row for every row of ``docs``: its leaf, its proof and what it leads to.

    ``docs`` has the columns of ``FIELDS``; others are not read. ``tampered``
    gives another ``n_chars`` for the check; without it rows are checked as they
    are. Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified``.

    A tree per language holds its leaves by ``doc_id`` (NULL first, rows of one
    id by digest, so repeated rows stand side by side); a tree over the languages
    (NULL first) holds the subroots. Two nodes become the digest of both texts, a
    node without a neighbour the digest of its own. NULLs in any column are
    values of their own. A lone leaf is its subroot, a lone subroot the root. No
    rows give no rows.
    """
    columns = {name: F.col(name) for name in FIELDS}
    leaf = leaf_digest(**columns)
    n_chars = columns["n_chars"]
    changed = n_chars if tampered is None else tampered
    leaves = stage(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            group_key(F.col("lang")).alias("group"),
            leaf.alias("leaf"),
            # most rows are as they were: their digest is not made twice
            F.when(
                ~changed.eqNullSafe(n_chars), leaf_digest(**{**columns, "n_chars": changed})
            ).alias("tampered"),
        )
    )
    slots = stage(
        leaf_slots(leaves).select(
            "group",
            "slot",
            "n",
            F.col("leaf").alias("digest"),
            "doc_id",
            F.coalesce("tampered", "leaf").alias("tampered"),
        )
    )
    trees = reduced(slots)
    subroots = stage(numbered_groups(trees[-1].select("group", "digest")))
    count = subroots.count()
    top = reduced(
        subroots.select(
            F.lit(TOP).alias("group"), "slot", F.lit(count).cast("bigint").alias("n"), "digest"
        )
    )
    root = top[-1].first()
    root = root["digest"] if root else ""

    summit = top[-1].select("group", "slot", F.lit("").alias("path"))
    of_groups = paths(top, summit).select(F.col("slot").alias("place"), "path")
    above = subroots.join(of_groups, subroots["slot"] == of_groups["place"]).select(
        "group", F.lit(0).cast("bigint").alias("slot"), "path", F.col("digest").alias("subroot")
    )
    last = above.select("group", "subroot")
    for nodes in reversed(trees[1:-1]):
        own = nodes.select("group", "slot", "n", "digest")
        found = _per_array(own, above.select("group", "slot", "path"), _paths_of_array, "group string, slot bigint, path string")
        above = stage(found.join(last, "group"))
    if len(trees) == 1:
        # every group is one leaf: its own array, with nothing to reduce
        trees.append(trees[0])
    schema = (
        "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string,"
        " folded_root string, verified boolean"
    )
    return _per_array(trees[0], above, _proofs_of_array(root), schema)
