"""Near-duplicate lines by deletion neighbourhoods of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.store import stage

# One word of five is the edit bound: lines with fewer words must be equal.
MIN_WORDS = 5
SAME, SHORTER, WHOLE = 0, 1, 2
# A line's place as one number: document, row among those of one id, position.
PLACE = 10**9
ROWS = 10**10
LAST_ID = 2**63 - 1


def _place(row: Column) -> Column:
    """Where a line stands, as one number that no two different lines share.

    Ids may be repeated or NULL, so a row is told apart by id and hash of its
    text: by 33 bits of it beside an id, by all 64 where the id is NULL.
    """
    digits = "decimal(38,0)"
    pos = F.col("pos").cast("decimal(9,0)")
    tag = F.pmod(row, F.lit(ROWS)).cast("decimal(10,0)")
    beside = F.lit(str(ROWS * PLACE)).cast("decimal(20,0)")
    known = F.col("doc_id").cast("decimal(19,0)") * beside + tag * F.lit(PLACE) + pos
    unsigned = row.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    unknown = F.lit(str(LAST_ID + 1)).cast("decimal(19,0)") * beside + unsigned * F.lit(PLACE) + pos
    return F.when(F.col("doc_id").isNull(), unknown.cast(digits)).otherwise(known.cast(digits))


def split_lines(docs: DataFrame) -> DataFrame:
    """A row per line: ``doc_id, row, pos, line, place, words``.

    ``row`` is a hash of the whole text; words are what single spaces separate.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    line = F.col("line")
    return docs.select(
        "doc_id",
        F.xxhash64("text").alias("row"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"),
    ).select(
        "doc_id",
        "row",
        "pos",
        "line",
        _place(F.col("row")).alias("place"),
        (
            F.octet_length(line)
            - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
            + 1
        ).alias("words"),
    )


def _halves() -> Column:
    """Four hashes of a line of which lines within one word edit share one.

    Take the longer of the two to have L words: an edit in its first half leaves
    the last (L-1)/2 words alone, one in its second half the first (L-1)/2. A
    line is the longer or the shorter by one, so it has halves for L and L+1.
    """
    hashes = []
    for longest in (F.col("words"), F.col("words") + 1):
        half = F.floor((longest - 1) / 2).cast("int")
        for side in (1, -1):
            part = F.call_function(
                "substring_index", F.col("line"), F.lit(" "), half * side
            )
            hashes.append(F.xxhash64(longest, F.lit(side), part))
    return F.array(*hashes)


def _candidates(distinct: DataFrame) -> DataFrame:
    """Places of distinct lines that share a half with another; no pair within
    one edit is lost by it, and few others are left."""
    halves = distinct.filter(F.col("words") >= MIN_WORDS).select(
        "place", F.explode("halves").alias("half")
    )
    shared = (
        halves.groupBy("half")
        .agg(F.min("place").alias("low"), F.max("place").alias("high"))
        .filter("low < high")
        .select("half")
    )
    return halves.join(stage(shared).hint("merge"), "half").select("place").distinct()


def _neighbourhood(lines: DataFrame) -> DataFrame:
    """Hashed keys of each line within one deletion: ``place, kind, key``.

    The hash of a word sequence is the XOR of hashes of (position, word), so one
    pass over a line gives the hash without each of its words: running XORs of
    the words before it at their own positions and those after it one earlier.
    Words are sorted by ``number``, a line's own, which compares without making
    two objects of each pair as the decimal ``place`` does.
    ``SAME``: equal keys differ in the word at one position. ``SHORTER`` and
    ``WHOLE``: equal keys are a line without a word and the line that is left.
    """
    words = lines.select(
        "number", "place", "words", F.posexplode(F.split("line", " ")).alias("i", "word")
    )
    own, moved = F.xxhash64("i", "word"), F.xxhash64(F.col("i") - 1, F.col("word"))
    # one order for both frames: the words of a line are sorted and held once
    line = Window.partitionBy("number").orderBy("i")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    hashed = words.withColumns({"own": own, "moved": moved})
    both = F.col("own").bitwiseXOR(F.col("moved"))
    without = (
        F.bit_xor("moved")
        .over(whole)
        .bitwiseXOR(F.coalesce(F.bit_xor(both).over(before), F.lit(0)))
        .bitwiseXOR(F.col("moved"))
    )
    fewer = F.col("words") - 1
    emitted = F.array(
        F.struct(
            F.lit(SAME).alias("kind"),
            F.xxhash64(F.lit(0), "words", "i", "without").alias("key"),
        ),
        F.when(
            fewer >= MIN_WORDS,
            F.struct(
                F.lit(SHORTER).alias("kind"),
                F.xxhash64(F.lit(1), fewer, "without").alias("key"),
            ),
        ),
        F.when(
            F.col("i") == 0,
            F.struct(
                F.lit(WHOLE).alias("kind"),
                F.xxhash64(F.lit(1), "words", "all").alias("key"),
            ),
        ),
    )
    return (
        hashed.withColumns(
            {"without": without, "all": F.bit_xor("own").over(whole)}
        )
        .select("place", F.explode(emitted).alias("at"))
        .filter("at is not null")
        .select("place", "at.kind", "at.key")
    )


def _within_one_word(a: Column, b: Column) -> Column:
    """Whether two lines differ by one word replaced, put in or left out."""
    a, b = F.split(a, " "), F.split(b, " ")
    swap = F.size(a) >= F.size(b)
    longer, shorter = F.when(swap, a).otherwise(b), F.when(swap, b).otherwise(a)
    # words of the shorter before the first difference
    first = F.array_position(
        F.zip_with(shorter, F.slice(longer, 1, F.size(shorter)), lambda x, y: x == y),
        F.lit(False),
    ).cast("int")
    first = F.when(first == 0, F.size(shorter)).otherwise(first - 1)
    rest = F.slice(longer, first + 2, F.size(longer))
    kept = F.slice(shorter, first + 1, F.size(shorter))
    replaced = F.slice(shorter, first + 2, F.size(shorter))
    return F.when(F.size(a) == F.size(b), rest == replaced).otherwise(
        (F.size(longer) == F.size(shorter) + 1) & (rest == kept)
    )


def _near_earlier(keys: DataFrame, texts: DataFrame) -> DataFrame:
    """Lines that have an earlier line within one edit: ``place, earlier``.

    Per key only its earliest lines count: all others meet those, not each other.
    """
    earliest = keys.groupBy("key").agg(
        F.min(F.when(F.col("kind") == SAME, F.col("place"))).alias("same"),
        F.min(F.when(F.col("kind") == SHORTER, F.col("place"))).alias("shorter"),
        F.min(F.when(F.col("kind") == WHOLE, F.col("place"))).alias("whole"),
        F.count(F.lit(1)).alias("lines"),
    )
    partner = (
        F.when(F.col("kind") == SAME, F.col("same"))
        .when(F.col("kind") == SHORTER, F.col("whole"))
        .otherwise(F.col("shorter"))
    )
    met = (
        keys.join(
            stage(earliest.filter("lines > 1").drop("lines")).hint("merge"), "key"
        )
        .select("place", partner.alias("earlier"))
        .filter("earlier < place")
        .distinct()
    )
    later, first = (
        texts.select(F.col("place").alias(name), F.col("line").alias(f"{name}_line"))
        for name in ("place", "earlier")
    )
    return (
        met.join(later.hint("merge"), "place")
        .join(first.hint("merge"), "earlier")
        .filter(_within_one_word(F.col("place_line"), F.col("earlier_line")))
        .groupBy("place")
        .agg(F.min("earlier").alias("earlier"))
    )


def mark_lines(docs: DataFrame) -> DataFrame:
    """Each line of ``docs`` and whether it stays: ``doc_id, row, pos, kept``.

    A line goes when an equal line comes earlier, or when a line within one word
    edit (a word replaced, put in or left out) does and both have at least
    ``MIN_WORDS`` words. Earlier is: smaller ``doc_id`` (NULL last), of rows with
    one id smaller hash of the text, then smaller position. Only a direct link counts, also one to a line that goes itself.
    Blank lines always stay.

    Tables of candidates grow with the lines, so no join is left to a broadcast
    that only small data would get: the plan is the same at every size.

    NULL text is one blank line. Rows with equal id and text are one row several
    times: their lines stay or go together. No rows give no rows; columns besides ``doc_id``
    and ``text`` are not read.
    """
    blank = F.trim("line") == ""
    lines = split_lines(docs).select(
        "doc_id",
        "row",
        "pos",
        "place",
        "words",
        F.when(~blank, F.unhex(F.md5("line"))).alias("digest"),
        _halves().alias("halves"),
    )
    rows = stage(lines)
    halves = [F.col("halves")[i] for i in range(4)]
    distinct = stage(
        rows.filter("digest is not null")
        .select("digest", "place", "words", *[h.alias(f"h{i}") for i, h in enumerate(halves)])
        .groupBy("digest", "words", "h0", "h1", "h2", "h3")
        .agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("copies"))
        .select("digest", "place", "words", "copies", F.array("h0", "h1", "h2", "h3").alias("halves"))
    )
    texts = stage(
        split_lines(docs)
        .filter(F.col("words") >= MIN_WORDS)
        .join(stage(_candidates(distinct)).hint("merge"), "place")
        .select("place", "words", "line")
        .distinct()
        .withColumn("number", F.monotonically_increasing_id())
    )
    near = stage(_near_earlier(stage(_neighbourhood(texts)), texts))
    # what decides on a line: where its text came first, and if that goes
    going = stage(
        distinct.join(near, "place", "left")
        .filter("copies > 1 or earlier is not null")
        .select(
            "digest",
            F.when(F.col("earlier").isNull(), F.col("place")).alias("stays_at"),
        )
    )
    found = rows.join(
        going.withColumn("known", F.lit(True)).hint("merge"), "digest", "left"
    ).withColumn(
        "kept",
        F.col("known").isNull() | F.coalesce(F.col("place") == F.col("stays_at"), F.lit(False)),
    )
    return found.select("doc_id", "row", "pos", "kept")


def document_lines(marked: DataFrame) -> DataFrame:
    """Per row of the documents: ``doc_id``, its lines, how many go, the positions
    of those, and ``row``, the hash of its text."""
    gone = F.when(~F.col("kept"), F.col("pos"))
    per_row = marked.groupBy("doc_id", "row").agg(
        F.count(F.when(F.col("pos") == 0, 1)).alias("copies"),
        (F.max("pos") + 1).cast("bigint").alias("n_lines"),
        F.array_sort(F.collect_set(gone)).alias("removed"),
    )
    return per_row.select(
        "doc_id",
        "n_lines",
        F.size("removed").cast("bigint").alias("n_removed"),
        "removed",
        "row",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"),
    ).drop("copy")


def without_lines(docs: DataFrame, per_document: DataFrame) -> DataFrame:
    """``docs`` with the removed lines taken out of ``text``."""
    removed = (
        per_document.filter("n_removed > 0")
        .select(
            F.col("doc_id").alias("removed_of"),
            F.col("row").alias("removed_row"),
            F.col("removed").alias("removed_lines"),
        )
        .distinct()
    )
    kept = F.filter(
        F.split(docs["text"], "\n"),
        lambda line, i: ~F.array_contains(removed["removed_lines"], i),
    )
    text = F.when(removed["removed_lines"].isNull(), docs["text"]).otherwise(
        F.array_join(kept, "\n")
    )
    same = docs["doc_id"].eqNullSafe(removed["removed_of"]) & (
        F.xxhash64(docs["text"]) == removed["removed_row"]
    )
    joined = docs.join(removed, same, "left")
    return joined.select(
        *[text.alias(c) if c == "text" else docs[c] for c in docs.columns]
    )
