"""Prefix trie of conversations, as burst tries.

Containers hold the rest of every conversation that shares a head, the turns read
so far. A container with too many conversations or turns bursts by the next turn
id into a container per child, and its head becomes a node of the trie above.
What remains is small: each container is sorted and swept into nodes by one task.

Prefixes are told apart by two 64-bit hashes over position and turn, which add up
along a conversation in any order of work, so a conversation of any length is
scanned in blocks. Whoever gathers rows of a prefix checks that they agree in the
last turn and in the prefix before it, so a collision fails and is never counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.scan import running
from clicklens.llm.store import stage

# A container is swept when it holds at most so many different conversations and
# turns, or a single conversation.
MAX_SEQUENCES = 64
MAX_TURNS = 8_192
# Members that end at a node are joined in chunks of this many ids.
ID_BITS = 10
NO_ENDS = hashlib.sha256(b"").hexdigest()

PREFIX = ["depth", "a", "b"]
NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,"
    " n_leaves bigint, saved_tokens bigint, ends_sha256 string, above_a bigint, above_b bigint"
)
NODE_COLUMNS = [field.split()[0] for field in NODE.split(", ")]


# --- conversations ----------------------------------------------------------


def turn_key(role: Column, text: Column) -> Column:
    """Half of the SHA-256 of role and text; NULL is empty."""
    role, text = (F.coalesce(c, F.lit("")) for c in (role, text))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(told, 256), 1, 32))


def order_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, position (1, 2, ...), key, n_chars`` of every turn.

    The order is by ``turn``, NULL first, then by the key of the turn. Turns that
    share conversation and number are first counted by key prefix, so that no
    task orders more of them than share both.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        # room below the smallest number for NULL
        F.coalesce(F.col("turn").cast("bigint"), F.lit(-(2**63))).alias("turn"),
        turn_key(F.col("role"), F.col("text")).alias("key"),
        F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"),
    )
    # repeated turns are alike in all that follows: one row counts them
    equal = stage(
        rows.groupBy("conv_id", "turn", "key", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
    ).withColumn("part", F.hex(F.substring("key", 1, 2)))
    parts = equal.groupBy("conv_id", "turn", "part").agg(F.sum("copies").alias("rows"))
    starts = running(
        parts, ["conv_id"], "turn", {"upto": ("sum", F.col("rows"))}, ties=["part"]
    ).select("conv_id", "turn", "part", (F.col("upto") - F.col("rows")).alias("start"))
    inside = running(
        equal.withColumn("zero", F.lit(0).cast("bigint")),
        ["conv_id", "turn", "part"],
        "zero",
        {"upto": ("sum", F.col("copies"))},
        ties=["key"],
    )
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return (
        inside.join(starts, ["conv_id", "turn", "part"])
        .select("*", copy.alias("copy"))
        .select(
            "conv_id",
            (F.col("start") + F.col("upto") - F.col("copies") + F.col("copy")).alias("position"),
            "key",
            "n_chars",
        )
    )


def with_family_heads(turns: DataFrame, family: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first one of their family.

    Conversation ``c`` gets the first ``h = crc32(c) % heads`` turns of
    conversation ``c - c % family`` and its own turns after its first ``h``.
    Returns the turns ``conv_id, depth, key, n_chars`` and all ``conv_id``.
    """
    own_h = F.crc32(F.col("conv_id").cast("string")) % heads
    base = F.col("conv_id") - F.col("conv_id") % family
    # at most heads - 1 turns of each first conversation
    first = (
        turns.filter((F.col("position") < heads) & (F.col("conv_id") % family == 0))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("position", "key", "n_chars"))).alias("opening"))
    )
    convs = (
        turns.select("conv_id")
        .distinct()
        .withColumns({"h": own_h, "base": base})
        .join(first, "base", "left")
        .select(
            "conv_id",
            "h",
            F.slice(F.coalesce("opening", F.array().cast(first.schema["opening"].dataType)), F.lit(1), F.col("h").cast("int")).alias("opening"),
        )
    )
    convs = stage(convs)
    openings = convs.select("conv_id", F.explode("opening").alias("turn")).select(
        "conv_id",
        F.col("turn.position").alias("depth"),
        F.col("turn.key").alias("key"),
        F.col("turn.n_chars").alias("n_chars"),
    )
    lengths = convs.select("conv_id", "h", F.size("opening").alias("n_opening"))
    rest = (
        turns.join(lengths, "conv_id")
        .filter("position > h")
        .select("conv_id", (F.col("position") - F.col("h") + F.col("n_opening")).alias("depth"), "key", "n_chars")
    )
    return openings.unionByName(rest), convs.select("conv_id")


# --- sequences --------------------------------------------------------------


def _hashed() -> tuple[Column, Column]:
    return F.xxhash64("depth", "key"), F.xxhash64("key", F.lit("second"), "depth")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with the hashes of the prefix that ends there (``a, b``), of the
    one before (``above_a, above_b``) and its code points (``through``)."""
    first, second = _hashed()
    values = {
        "a": ("xor", first),
        "b": ("xor", second),
        "through": ("sum", F.col("n_chars")),
    }
    return running(turns, ["conv_id"], "depth", values).withColumns(
        {"above_a": F.col("a").bitwiseXOR(first), "above_b": F.col("b").bitwiseXOR(second)}
    )


def _ends_of_sequences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of ids, sorted by sequence and place, to a row per sequence. Only
    the running digest is held, however many members there are."""
    current, first, n, digest = None, None, 0, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"conv_id": pa.array([first], pa.int64()), "n": pa.array([n], pa.int64()),
             "n_turns": pa.array([current[0]], pa.int64()), "total": pa.array([current[1]], pa.int64()),
             "ends": pa.array([digest.hexdigest()], pa.string())}
        )

    for batch in batches:
        for chunk in batch.to_pylist():
            key = tuple(chunk[c] for c in ("n_turns", "total", "a", "b", "key"))
            if key != current:
                if current is not None:
                    yield row()
                current, first, n, digest = key, chunk["first"], 0, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(chunk["ids"].encode())
            n += chunk["rows"]
    if current is not None:
        yield row()


def sequences(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per different conversation: ``conv_id`` (the smallest that has it),
    ``n`` (how many have it), ``n_turns``, ``total`` code points and ``ends``
    (the SHA-256 of their ids, ascending, joined by commas)."""
    last = paths.groupBy("conv_id").agg(
        F.max(F.struct("depth", "a", "b", "through", "key")).alias("last")
    )
    whole = convs.join(last, "conv_id", "left").select(
        "conv_id",
        *[
            F.coalesce(f"last.{old}", F.lit(0)).cast("bigint").alias(new)
            for old, new in (("depth", "n_turns"), ("through", "total"), ("a", "a"), ("b", "b"))
        ],
        F.col("last.key").alias("key"),
    )
    same = ["n_turns", "total", "a", "b", "key"]
    chunks = whole.groupBy(*same, F.shiftright("conv_id", ID_BITS).alias("chunk")).agg(
        F.min("conv_id").alias("first"),
        F.count(F.lit(1)).alias("rows"),
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )
    ordered = chunks.repartition(*same).sortWithinPartitions(*same, "chunk")
    return ordered.mapInArrow(
        _ends_of_sequences, "conv_id bigint, n bigint, n_turns bigint, total bigint, ends string"
    )


# --- bursting ---------------------------------------------------------------


def burst(members: DataFrame, max_sequences: int, max_turns: int) -> DataFrame:
    """Rows of ``members`` whose prefix is the head of an oversized container.

    All containers start at the root. A round looks at the children of those that
    burst before, twice as many levels of them as the round before it, and only
    at their conversations; it ends when none reaches below its levels. A
    conversation bursts from the top on, since a container is never larger than
    the one it came from.
    """
    found, active, low, step = [], None, 0, 1
    while True:
        level = members.filter(F.col("depth").between(low + 1, low + step))
        if active is not None:
            level = level.join(active, "conv_id", "left_semi")
        sizes = level.groupBy(*PREFIX).agg(
            F.count(F.lit(1)).alias("conversations"),
            F.sum(F.col("n_turns") - F.col("depth") + 1).alias("turns"),
        )
        heads = sizes.filter(
            (F.col("conversations") > max_sequences)
            | ((F.col("turns") > max_turns) & (F.col("conversations") > 1))
        ).select(*PREFIX)
        burst_rows = stage(level.join(heads, PREFIX, "left_semi"))
        low, step = low + step, 2 * step
        active = burst_rows.filter(F.col("depth") == low).select("conv_id")
        found.append(burst_rows)
        if active.isEmpty():
            break
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows


# --- nodes ------------------------------------------------------------------


def _sweep(table: pa.Table) -> pa.Table:
    """The nodes of one container.

    Its conversations are sorted by their turns; those next to each other share
    their longest common prefix, so one pass with a stack of open nodes meets
    every node once.
    """
    rows = sorted(table.to_pylist(), key=lambda row: (row["conv_id"], row["depth"]))
    by_conv: dict[int, list[dict]] = {}
    for row in rows:
        by_conv.setdefault(row["conv_id"], []).append(row)
    suffixes = sorted(by_conv.values(), key=lambda suffix: [row["key"] for row in suffix])
    top = rows[0]["depth"]
    if len({(s[0]["depth"], s[0]["key"], s[0]["above_a"], s[0]["above_b"]) for s in suffixes}) > 1:
        raise ValueError("two prefixes share their hashes")

    nodes: list[dict] = []
    stack: list[int] = []

    def close() -> None:
        node = nodes[stack.pop()]
        node["saved"] += (node["n"] - 1) * node["chars"]
        node["leaves"] += not node["children"]
        if stack:
            parent = nodes[stack[-1]]
            parent["first"] = min(parent["first"], node["first"])
            parent["n"] += node["n"]
            parent["children"] += 1
            parent["leaves"] += node["leaves"]
            parent["saved"] += node["saved"]

    before: list[dict] = []
    for suffix in suffixes:
        shared = 0
        while shared < min(len(before), len(suffix)) and before[shared]["key"] == suffix[shared]["key"]:
            shared += 1
        while len(stack) > shared:
            close()
        for row in suffix[shared:]:
            nodes.append(
                {"parent": stack[-1] if stack else None, "first": row["conv_id"], "n": 0, "children": 0,
                 "leaves": 0, "saved": 0, "chars": row["n_chars"], "ends": NO_ENDS, "row": row}
            )
            stack.append(len(nodes) - 1)
        end = nodes[stack[-1]]
        end["n"] += suffix[-1]["n"]
        end["first"] = min(end["first"], suffix[-1]["conv_id"])
        end["ends"] = suffix[-1]["ends"]
        before = suffix
    while stack:
        close()
    records = [
        (
            node["first"],
            node["row"]["depth"],
            None if node["parent"] is None else nodes[node["parent"]]["first"],
            node["n"],
            node["children"],
            node["leaves"],
            node["saved"],
            node["ends"],
            node["row"]["above_a"] if node["row"]["depth"] == top else None,
            node["row"]["above_b"] if node["row"]["depth"] == top else None,
        )
        for node in nodes
    ]
    types = {"ends_sha256": pa.string()}
    return pa.table(
        {
            name: pa.array(values, types.get(name, pa.int64()))
            for name, values in zip(NODE_COLUMNS, zip(*records))
        }
    )


def _container_nodes(members: DataFrame, heads: DataFrame) -> DataFrame:
    """Nodes below the heads; those right below one have ``above_a, above_b``."""
    deepest = heads.groupBy("conv_id").agg(F.max("depth").alias("head_depth"))
    below = members.join(deepest, "conv_id", "left").withColumn(
        "head_depth", F.coalesce("head_depth", F.lit(0))
    )
    below = stage(below.filter("depth > head_depth"))
    tops = below.filter("depth = head_depth + 1").select(
        "conv_id", F.col("a").alias("top_a"), F.col("b").alias("top_b"), F.col("depth").alias("top_depth")
    )
    container = ["top_depth", "top_a", "top_b"]
    sizes = tops.groupBy(*container).agg(F.count(F.lit(1)).alias("conversations"))
    placed = below.join(tops.join(sizes, container), "conv_id")

    swept = (
        placed.filter("conversations > 1")
        .select(*container, "conv_id", "depth", "key", "n_chars", "n", "ends", "above_a", "above_b")
        .groupBy(*container)
        .applyInArrow(_sweep, NODE)
    )
    # one conversation alone is a chain: nothing to sort
    at_top, at_end = F.col("depth") == F.col("top_depth"), F.col("depth") == F.col("n_turns")
    chain = placed.filter("conversations = 1").select(
        "conv_id",
        "depth",
        F.when(~at_top, F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(at_end, 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        ((F.col("n") - 1) * (F.col("total") - F.col("through") + F.col("n_chars"))).alias("saved_tokens"),
        F.when(at_end, F.col("ends")).otherwise(NO_ENDS).alias("ends_sha256"),
        F.when(at_top, F.col("above_a")).alias("above_a"),
        F.when(at_top, F.col("above_b")).alias("above_b"),
    )
    return stage(swept.unionByName(chain))


def _checked(column: str) -> Column:
    """A value that all rows of a prefix share."""
    return F.when(
        F.min(column).eqNullSafe(F.max(column)), F.min(column)
    ).otherwise(F.raise_error(F.lit("two prefixes share their hashes")).cast("bigint"))


def _head_nodes(heads: DataFrame, tops: DataFrame) -> DataFrame:
    """Nodes of oversized containers, the root among them."""
    found = tops.groupBy("conv_id").agg(
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    heads = stage(heads.join(found, "conv_id", "left"))
    nodes = stage(
        heads.groupBy(*PREFIX).agg(
            F.min("conv_id").alias("first"),
            F.sum("n").alias("n_convs"),
            F.max("n_chars").alias("chars"),
            F.coalesce(F.sum("leaves"), F.lit(0)).alias("leaves"),
            F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"),
            F.max(F.when(F.col("depth") == F.col("n_turns"), F.col("ends"))).alias("ends"),
            _checked("above_a").alias("above_a"),
            _checked("above_b").alias("above_b"),
            F.when(F.min("key").eqNullSafe(F.max("key")), 0)
            .otherwise(F.raise_error(F.lit("two prefixes share their hashes")).cast("int"))
            .alias("agreed"),
        )
    )
    # what a head saves itself is counted for its smallest member; along that
    # conversation it belongs to every head from the top down to it
    owned = heads.select("conv_id", *PREFIX).join(
        nodes.select(
            *PREFIX, "first", ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved")
        ),
        PREFIX,
    )
    upwards = owned.select(
        "conv_id",
        *PREFIX,
        (-F.col("depth")).alias("upwards"),
        F.when(F.col("conv_id") == F.col("first"), F.col("own_saved")).otherwise(0).alias("own_saved"),
    )
    saved = (
        running(upwards, ["conv_id"], "upwards", {"below": ("sum", F.col("own_saved"))})
        .groupBy(*PREFIX)
        .agg(F.sum("below").alias("heads_saved"))
    )
    above = [(F.col("depth") - 1).alias("depth"), F.col("above_a").alias("a"), F.col("above_b").alias("b")]
    children = (
        tops.select(*above)
        .unionByName(nodes.filter("depth > 0").select(*above))
        .groupBy(*PREFIX)
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("a").alias("above_a"),
        F.col("b").alias("above_b"),
        F.col("first").alias("parent_conv_id"),
    )
    n_children = F.coalesce("n_children", F.lit(0)).cast("bigint")
    return (
        nodes.join(saved, PREFIX)
        .join(children, PREFIX, "left")
        .join(parents, ["depth", "above_a", "above_b"], "left")
        .select(
            F.col("first").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            n_children.alias("n_children"),
            F.when(n_children == 0, 1).otherwise(F.col("leaves")).cast("bigint").alias("n_leaves"),
            (F.col("saved") + F.col("heads_saved")).cast("bigint").alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
            "a",
            "b",
        )
    )


def prefix_trie(
    turns: DataFrame,
    convs: DataFrame,
    max_sequences: int = MAX_SEQUENCES,
    max_turns: int = MAX_TURNS,
) -> DataFrame:
    """A row per node of the prefix trie of conversations.

    ``turns`` has ``conv_id, depth (1, 2, ... without gaps), key (binary),
    n_chars``; ``convs`` has every ``conv_id`` once, also of conversations without
    turns. Returns per node ``conv_id`` (its smallest member), ``depth``,
    ``parent_conv_id`` (NULL for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over its subtree: members but one times the
    code points of the last turn) and ``ends_sha256`` (of the members that end
    there). No conversations give no rows, conversations without turns the root.

    The limits on containers say how the work is dealt, not what comes out: a
    container over them bursts. Equal conversations are one member of a container,
    and the SHA-256 over their ids is fed chunk by chunk, so copies cost one row
    per 1024 ids in the task that makes their digest.
    """
    paths = stage(prefixes(turns))
    different = stage(sequences(paths, convs))
    members = stage(paths.join(different, "conv_id"))
    zero = F.lit(0).cast("bigint")
    root = different.select(
        "conv_id",
        zero.alias("depth"),
        F.lit(None).cast("binary").alias("key"),
        *[zero.alias(c) for c in ("n_chars", "a", "b", "through")],
        *[F.lit(None).cast("bigint").alias(c) for c in ("above_a", "above_b")],
        "n",
        "n_turns",
        "total",
        "ends",
    )
    heads = stage(root.unionByName(burst(members, max_sequences, max_turns)))
    contained = _container_nodes(members, heads)
    tops = contained.filter("above_a IS NOT NULL")
    above = _head_nodes(heads, tops)
    nodes = stage(above)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("a").alias("above_a"),
        F.col("b").alias("above_b"),
        F.col("conv_id").alias("above_conv_id"),
    )
    result = [c for c in NODE_COLUMNS if c not in ("above_a", "above_b")]
    placed = tops.join(parents, ["depth", "above_a", "above_b"]).withColumn(
        "parent_conv_id", F.col("above_conv_id")
    )
    return (
        nodes.select(*result)
        .unionByName(placed.select(*result))
        .unionByName(contained.filter("above_a IS NULL").select(*result))
    )


def conversation_trie(
    conversations: DataFrame, family: int = 100, heads: int = 6
) -> DataFrame:
    """The prefix trie of a table of turns, rebuilt with the heads of families.

    ``conversations`` has ``conv_id, turn, role, text``; other columns are not
    read. Turns are ordered by ``turn`` (NULL first), then by the SHA-256 of role
    and text; repeated rows are turns of their own. NULL role or text is empty. A
    row without ``conv_id`` belongs to no conversation. See ``with_family_heads``
    and ``prefix_trie``.
    """
    ordered = stage(order_turns(conversations))
    turns, convs = with_family_heads(ordered, family, heads)
    return prefix_trie(turns, convs)
