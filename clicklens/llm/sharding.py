"""Shards of equal row counts that keep equal texts together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.ranks import bucket_count, gapless
from clicklens.llm.store import discard, stage

# A group's rows are moved in pieces, so that a group larger than a shard can
# fill several; each shard starts with this many pieces of a large group.
PIECES = 16
ROW_ORDER = ["doc_id", "text_crc32", "size"]


def _rows(docs: DataFrame, shards: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group"),
    ).withColumn(
        "piece",
        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(shards * PIECES)).cast("int"),
    )


def _quotas(
    flow: dict[tuple[int, int], int], load: dict[int, int], caps: list[int]
) -> dict[tuple[int, int], int]:
    """How many rows may go from one shard to another in a round: as many as
    come back, and a share of the room that the target has left."""
    wanted: dict[int, int] = {}
    for (_, to), n in flow.items():
        wanted[to] = wanted.get(to, 0) + n
    quota = {}
    for (at, to), n in flow.items():
        back = min(n, flow.get((to, at), 0))
        room = max(0, caps[to] - load.get(to, 0))
        quota[at, to] = back + room * n // wanted[to]
    return quota


def propagate(cells: DataFrame, caps: list[int], rounds: int) -> DataFrame:
    """Moves pieces of groups to the shard where most of their group is.

    ``cells`` has ``group, piece, n, shard``. Each round joins every piece with
    the fullest shard of its group, of those with room if there are any; a piece
    stays where more of its group is. A group larger than a shard has as many
    such shards as it fills. What wants to go from shard to shard is
    added up (at most shards squared numbers, which the driver turns into
    quotas), and the pieces with the most neighbours at their target move as far
    as the quota goes. It ends when nothing moves.
    """
    spark = cells.sparkSession
    for round_ in range(rounds):
        counts = cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()
        load = {row["shard"]: row["n"] for row in counts}
        room = [s for s, n in load.items() if n < caps[s]]
        held = cells.groupBy("group", "shard").agg(F.sum("n").alias("own"))
        # a group that fills several shards gathers in as many of its fullest
        fills = F.greatest(F.lit(1), F.ceil(F.sum("own") / max(1, caps[0])))
        order = F.transform(
            "all",
            lambda at: F.struct(
                (at["shard"].isin(room) | (F.col("m") > 1)).alias("first"),
                at["own"].alias("own"),
                at["tie"],
                at["shard"].alias("shard"),
            ),
        )
        tie = F.xxhash64("group", "shard").alias("tie")
        best = stage(
            held.groupBy("group")
            .agg(
                F.collect_list(F.struct("own", tie, "shard")).alias("all"),
                fills.cast("int").alias("m"),
            )
            .select("group", F.slice(F.sort_array(order, asc=False), 1, F.col("m")).alias("best"))
        )
        goal = F.element_at(
            "best",
            (F.pmod(F.xxhash64("piece", F.lit(round_)), F.size("best")) + 1).cast("int"),
        )
        stays = F.exists("best", lambda b: b["shard"] == F.col("shard")) | (
            F.col("own") > F.col("goal.own")
        )
        wanting = stage(
            cells.join(held, ["group", "shard"])
            .join(best, "group")
            .withColumn("goal", goal)
            .select(
                *cells.columns,
                F.col("goal.own").alias("pull"),
                F.when(stays, F.col("shard")).otherwise(F.col("goal.shard")).alias("want"),
            )
        )
        sums = wanting.groupBy("shard", "want").agg(F.sum("n").alias("n")).collect()
        discard(best)
        flow = {(r["shard"], r["want"]): r["n"] for r in sums if r["shard"] != r["want"]}
        quota = [(a, b, q) for (a, b), q in _quotas(flow, load, caps).items() if q > 0]
        if not quota:
            discard(wanting)
            break
        # at most one row for each pair of shards
        quotas = F.broadcast(
            spark.createDataFrame(quota, "shard int, want int, quota bigint")
        )
        first = (
            Window.partitionBy("shard", "want")
            .orderBy(F.desc("pull"), "group", "piece")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        movers = (
            wanting.filter("shard <> want")
            .withColumn("so_far", F.sum("n").over(first))
            .join(quotas, ["shard", "want"], "left")
            .select(
                "group",
                "piece",
                "n",
                F.expr("if(so_far <= quota, want, shard)").alias("shard"),
            )
        )
        stayers = wanting.filter("shard = want").select("group", "piece", "n", "shard")
        moved = stage(stayers.union(movers))
        discard(cells)
        discard(wanting)
        cells = moved
    return cells


def shard_documents(docs: DataFrame, shards: int = 40, rounds: int = 6) -> DataFrame:
    """All rows of ``docs`` in shards whose row counts differ by one at most.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; ``law``
    is ``rows`` and ``grown_shard`` NULL. Rows with equal texts are linked.
    Linked rows start in a shard by hash and move by balanced label propagation;
    what exceeds a shard's share, and all rows without a link, fills what room
    is left. Groups too large for a shard are spread over several.

    NULL text counts as empty. Repeated rows and NULL ids are rows like others.
    Fewer rows than shards leave shards empty; no rows give no rows. Columns
    besides ``doc_id`` and ``text`` are not read.
    """
    rows = stage(_rows(docs, shards))
    total = rows.count()
    caps = [total // shards + (i < total % shards) for i in range(shards)]

    pieces = rows.groupBy("group", "piece").agg(F.count(F.lit(1)).alias("n"))
    linked = stage(
        pieces.groupBy("group")
        .agg(F.sum("n").alias("rows"))
        .filter("rows > 1")
        .select("group")
    )
    cells = stage(
        pieces.join(linked, "group").select(
            "group", "piece", "n", (F.col("piece") % shards).cast("int").alias("shard")
        )
    )
    cells = propagate(cells, caps, rounds)

    placed = rows.join(cells.drop("n"), ["group", "piece"], "left").drop("piece")
    placed = stage(placed.select(*ROW_ORDER, "shard"))
    ranked = stage(
        gapless(
            placed.filter("shard is not null"),
            ["shard"],
            ROW_ORDER,
            "slot",
            bucket_count(total // shards),
        )
    )
    cap = F.array(*[F.lit(c).cast("bigint") for c in caps])[F.col("shard")]
    settled = ranked.filter(F.col("slot") < cap)
    rest = placed.filter("shard is null").unionByName(
        ranked.filter(F.col("slot") >= cap).drop("slot")
    )

    load = {r["shard"]: r["count"] for r in settled.groupBy("shard").count().collect()}
    taken = [load.get(i, 0) for i in range(shards)]
    starts = [sum(caps[:i]) - sum(taken[:i]) for i in range(shards)]
    numbers = {
        name: F.array(*[F.lit(v).cast("bigint") for v in values])
        for name, values in {"start": starts, "taken": taken}.items()
    }
    # the last shard whose room starts at or before the row's number
    filled = (
        gapless(rest.drop("shard"), [], ROW_ORDER, "number", bucket_count(total))
        .withColumn(
            "shard",
            F.size(F.filter(numbers["start"], lambda s: s <= F.col("number"))) - 1,
        )
        .withColumn(
            "slot",
            F.col("number")
            - numbers["start"][F.col("shard")]
            + numbers["taken"][F.col("shard")],
        )
        .drop("number")
    )
    return settled.unionByName(filled).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
