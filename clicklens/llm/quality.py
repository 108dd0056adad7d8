"""Document quality by Bradley-Terry ranking of labelled documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.store import discard, stage

CUTOFF = 0.7
# Labelled documents that are compared with each other, all good ones with all
# bad ones; and how many of a rare label such a block has about, by copies.
BLOCK_ROWS = 2048
LEAST_IN_BLOCK = 64
SYMBOLS = b"#$%&*+<=>@\\^_`{}~"
FEATURES = (
    ["log_bytes", "log_words", "log_lines", "word_length", "line_words"]
    + ["lower", "upper", "digits", "spaces", "wide", "bars", "marks", "symbols"]
    + ["stops", "shouted_words", "marked_words", "barred_words", "no_letters"]
    + ["distinct_words", "top_word", "repeated_next", "distinct_lines"]
)

_CLASS = np.zeros(256, np.int64)  # 0: other
for _number, _bytes in enumerate(
    [
        b"abcdefghijklmnopqrstuvwxyz",
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b" \t\n\r\x0b\x0c",
        bytes(range(128, 256)),
        b"|",
        b"!?",
        SYMBOLS,
        b".,;:",
    ],
    start=1,
):
    _CLASS[list(_bytes)] = _number


def features(text: bytes) -> np.ndarray:
    """What a whole text looks like, as numbers of similar scale."""
    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    classes = np.bincount(_CLASS, weights=counts, minlength=10)[1:]
    words, lines = text.split(), text.split(b"\n")
    total = len(words)
    tally = Counter(words)
    marks = tuple(bytes([c]) for c in SYMBOLS + b"!")
    shouted = marked = barred = bare = 0
    for word, times in tally.items():
        if word.endswith(marks):
            marked += times
        if len(word) > 1 and word.isupper():
            shouted += times
        if word == b"|":
            barred += times
        if word.lower() == word.upper() and word.isascii():
            bare += times
    again = sum(map(bytes.__eq__, words, words[1:]))
    share = lambda x: np.sqrt(x / max(total, 1))
    return np.array(
        [
            np.log1p(n) / 5,
            np.log1p(total) / 5,
            np.log1p(len(lines)) / 3,
            np.log1p(n / max(total, 1)) / 2,
            np.log1p(total / len(lines)) / 3,
            *np.sqrt(classes / max(n, 1)),
            *map(share, (shouted, marked, barred, bare)),
            # a text of n words has about n ** 0.8 different ones
            len(tally) / max(total, 1) ** 0.8,
            share(max(tally.values(), default=0)),
            share(again),
            len(set(lines)) / len(lines),
        ]
    )


FEATURES_FIELD = T.StructField("features", T.ArrayType(T.FloatType()))


def document_features(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep`` as they are, and ``features`` for each row;
    features come from the text and nothing else."""
    carried = ["doc_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows = [features(t.as_py() or b"") for t in texts]
            flat = np.concatenate(rows) if rows else np.empty(0)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in carried],
                    pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.float32))),
                ],
                [*carried, "features"],
            )

    rows = docs.select(*carried, F.col("text").cast("string"))
    kept = rows.select(*carried).schema
    return rows.mapInArrow(run, T.StructType([*kept, FEATURES_FIELD]))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Ranking:
    """``score = sigmoid(scale * (weights . features - threshold) + logit(CUTOFF))``."""

    weights: tuple[float, ...]
    threshold: float
    scale: float

    def score(self, vector: Column) -> Column:
        worth = worth_of(self.weights, vector)
        level = float(np.log(CUTOFF / (1 - CUTOFF)))
        z = F.lit(self.scale) * (worth - F.lit(self.threshold)) + F.lit(level)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), z))))


NO_RANKING = Ranking((0.0,) * len(FEATURES), 0.0, 1.0)


def worth_of(weights: Sequence[float], vector: Column) -> Column:
    products = F.zip_with(
        vector.cast("array<double>"), F.array(*map(F.lit, weights)), lambda x, w: x * w
    )
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


Sums = tuple[float, np.ndarray, np.ndarray]


def pair_sums(
    weights: np.ndarray, good: np.ndarray, of_good: np.ndarray, bad: np.ndarray, of_bad: np.ndarray
) -> Sums:
    """Over all pairs of a good and a bad row: how much they count, slope and curve
    of their log-likelihood. ``of_good`` and ``of_bad`` are what a row counts."""
    ahead = (good @ weights)[:, None] - (bad @ weights)[None, :]
    p = 1 / (1 + np.exp(-np.clip(ahead, -500, 500)))
    counts = of_good[:, None] * of_bad[None, :]
    missed = counts * (1 - p)
    slope = missed.sum(axis=1) @ good - missed.sum(axis=0) @ bad
    bent = missed * p
    cross = good.T @ bent @ bad
    curve = (good.T * bent.sum(axis=1)) @ good + (bad.T * bent.sum(axis=0)) @ bad
    return counts.sum(), slope, curve - cross - cross.T


def _added(sums: Iterator[Sums]) -> Sums:
    width = len(FEATURES)
    total, slope, curve = 0.0, np.zeros(width), np.zeros((width, width))
    for a, b, c in sums:
        total, slope, curve = total + a, slope + b, curve + c
    return total, slope, curve


def _newton(
    sums: Callable[[np.ndarray], Sums], ridge: float, spread: np.ndarray, steps: int = 40
) -> tuple[float, ...]:
    """Newton steps on the logistic loss of the pairs; ``sums`` is given weights of
    features in units of ``spread``. Digits that hang on the order in which
    sums are added are cut off."""
    weights = np.zeros(len(FEATURES))
    for _ in range(steps):
        total, slope, curve = sums(weights)
        step = np.linalg.solve(
            curve / total + ridge * np.eye(len(weights)), slope / total - ridge * weights
        )
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple((np.round(weights, 6) / spread).tolist())


def _spread(deviation: np.ndarray) -> np.ndarray:
    return np.array([float(f"{x:.6g}") for x in deviation]) + 1e-3


def _ranking(weights: tuple[float, ...], threshold: float, median: float) -> Ranking:
    return Ranking(weights, threshold, 4 / max(median - threshold, 1e-9))


def fit_ranking(
    rows: list[tuple[int, list[float]]], pairs: int, seed: int, ridge: float = 1e-4
) -> Ranking:
    """``fit_labelled`` for a list of (label, features): every row of it counts, in
    as many blocks as make about ``pairs`` pairs."""
    labels = np.array([label for label, _ in rows], int)
    vectors = np.array([v for _, v in rows], float).reshape(-1, len(FEATURES))
    good, bad = vectors[labels == 1], vectors[labels == 0]
    if not len(good) or not len(bad):
        return NO_RANKING
    rng = np.random.default_rng(seed)
    blocks = min(max(1, len(good) * len(bad) // pairs), len(good), len(bad))
    spread, middle = _spread(vectors.std(axis=0)), vectors.mean(axis=0)
    dealt = [
        [(x - middle) / spread for x in np.array_split(side[rng.permutation(len(side))], blocks)]
        for side in (good, bad)
    ]

    def sums(weights: np.ndarray) -> Sums:
        return _added(
            pair_sums(weights, a, np.ones(len(a)), b, np.ones(len(b))) for a, b in zip(*dealt)
        )

    weights = _newton(sums, ridge, spread)
    worth = np.unique(vectors @ weights)
    high, low = np.sort(good @ weights), np.sort(bad @ weights)
    # threshold between two neighbouring worths, or with nothing below it
    between = np.concatenate([worth[:1], (worth[1:] + worth[:-1]) / 2])
    gaps = np.concatenate([[0.0], worth[1:] - worth[:-1]])
    kept = 1 - np.searchsorted(high, between) / len(high)
    caught = np.searchsorted(low, between) / len(low)
    balance = np.round(kept + caught, 9)
    best = np.flatnonzero(balance == balance.max())
    # in the widest gap of the best levels
    at = best[np.argmax(gaps[best])]
    return _ranking(weights, float(between[at]), float(np.median(high)))


def _blocks(vectors: DataFrame, rows: dict[int, int], block_rows: int, seed: int) -> DataFrame:
    """A row per block, with the features and what they count of each label.

    Copies of a vector are dealt over as many blocks, or over all of them, in
    equal shares; those of a rare label over more, so that no block lacks one.
    """
    blocks = -(-sum(rows.values()) // block_rows)
    spread = F.when(F.col("quality") == 1, F.lit(-(-LEAST_IN_BLOCK * blocks // rows[1])))
    places = F.least(
        F.lit(blocks).cast("bigint"),
        F.col("copies") * spread.otherwise(-(-LEAST_IN_BLOCK * blocks // rows[0])),
    )
    place = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("places") - 1))
    block = F.pmod(F.xxhash64(F.lit(seed), "features") + F.col("place"), F.lit(blocks))
    row = F.struct((F.col("copies") / F.col("places")).alias("counts"), "features")
    sides = {"good": 1, "bad": 0}
    gathered = (
        vectors.withColumn("places", places)
        .select("*", place.alias("place"))
        .withColumn("block", block)
        .groupBy("block")
        .agg(
            *[
                F.collect_list(F.when(F.col("quality") == label, row)).alias(side)
                for side, label in sides.items()
            ]
        )
    )
    return gathered.select(
        *[F.flatten(f"{side}.features").alias(side) for side in sides],
        *[F.col(f"{side}.counts").alias(f"of_{side}") for side in sides],
    )


def _step(blocks: DataFrame, middle: np.ndarray, spread: np.ndarray, weights: np.ndarray) -> Sums:
    """``pair_sums`` added up over all blocks; a task gives one row."""

    def scaled(flat: pa.ListScalar) -> np.ndarray:
        rows = flat.values.to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
        return (rows - middle) / spread

    def of_batch(batch: pa.RecordBatch) -> Iterator[Sums]:
        good, of_good, bad, of_bad = map(batch.column, ("good", "of_good", "bad", "of_bad"))
        for i in range(batch.num_rows):
            counts = [c[i].values.to_numpy(zero_copy_only=False) for c in (of_good, of_bad)]
            if all(map(len, counts)):
                yield pair_sums(weights, scaled(good[i]), counts[0], scaled(bad[i]), counts[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, slope, curve = _added(sums for batch in batches for sums in of_batch(batch))
        flat = [[total], [slope.tolist()], [curve.ravel().tolist()]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(flat[0]), *[pa.array(x, pa.list_(pa.float64())) for x in flat[1:]]],
            ["total", "slope", "curve"],
        )

    schema = "total double, slope array<double>, curve array<double>"
    found = blocks.mapInArrow(run, schema).collect()
    width = len(FEATURES)
    return _added(
        (r["total"], np.array(r["slope"]), np.array(r["curve"]).reshape(width, width)) for r in found
    )


def _level(vectors: DataFrame, weights: tuple[float, ...], rows: dict[int, int]) -> tuple[float, float]:
    """The threshold, and the median worth of good rows.

    Equal worths are counted before they are dealt by range; what lies below a
    range comes from the counts of the ranges before it.
    """
    worth = worth_of(weights, F.col("features"))
    copies = {"good": 1, "bad": 0}
    counted = stage(
        vectors.groupBy(worth.alias("worth"))
        .agg(
            *[
                F.sum(F.when(F.col("quality") == label, F.col("copies")).otherwise(0)).alias(side)
                for side, label in copies.items()
            ]
        )
        .repartitionByRange("worth")
        .withColumn("range", F.spark_partition_id())
    )
    ranges = Window.orderBy("range")
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.groupBy("range")
        .agg(F.min("worth").alias("first"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        .select(
            "range",
            F.lead("first").over(ranges).alias("next_first"),
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in copies],
        )
    )
    inside = Window.partitionBy("range").orderBy("worth")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        counted.select(
            "range",
            "worth",
            "good",
            F.lead("worth").over(inside).alias("next_worth"),
            *[F.sum(c).over(so_far).alias(f"{c}_inside") for c in copies],
        )
        .join(starts, "range")
        .select(
            "worth",
            F.coalesce("next_worth", "next_first").alias("next"),
            "good",
            *[(F.col(f"{c}_before") + F.col(f"{c}_inside")).alias(f"{c}_below") for c in copies],
        )
    )
    balance = 1 - F.col("good_below") / rows[1] + F.col("bad_below") / rows[0]
    gap = F.col("next") - F.col("worth")
    # the best level, in the widest gap of several
    cut = F.struct(
        F.round(balance, 9).alias("balance"),
        gap.alias("gap"),
        (-F.col("worth")).alias("lowest"),
        ((F.col("next") + F.col("worth")) / 2).alias("threshold"),
    )

    def ranked(rank: int) -> Column:
        held = (F.col("good_below") > rank) & (F.col("good_below") - F.col("good") <= rank)
        return F.max(F.when(held, F.col("worth")))

    found = placed.agg(
        F.max(F.when(F.col("next").isNotNull(), cut)).alias("cut"),
        F.min("worth").alias("lowest"),
        ranked((rows[1] - 1) // 2).alias("lower"),
        ranked(rows[1] // 2).alias("upper"),
    ).first()
    discard(counted)
    # with nothing below the threshold the balance is 1
    below = found["cut"] and found["cut"]["balance"] >= 1
    threshold = found["cut"]["threshold"] if below else found["lowest"]
    return threshold, (found["lower"] + found["upper"]) / 2


def fit_labelled(
    labelled: DataFrame, seed: int = 3, ridge: float = 1e-4, block_rows: int = BLOCK_ROWS
) -> Ranking:
    """Learns from all rows of (quality, features). Without both labels every
    score is CUTOFF.

    Bradley-Terry: the chance that one document is preferred to another is the
    sigmoid of the difference of their worths. Rows are dealt into blocks, and
    in each block every good row is compared with every bad one: each row is
    in about as many pairs as any other of its label, and up to ``block_rows``
    rows in all pairs there are. A Newton step is one pass over the blocks.
    The threshold is a quantile of the learned worths of all rows: of all levels
    the one that tells the labels apart best, in the middle where several do.
    """
    vectors = stage(
        labelled.groupBy("quality", "features").agg(F.count(F.lit(1)).alias("copies"))
    )
    x = [F.col("features")[i].cast("double") for i in range(len(FEATURES))]
    sums = vectors.agg(
        *[F.sum(F.when(F.col("quality") == q, F.col("copies"))).alias(f"rows_{q}") for q in (0, 1)],
        F.array(*[F.sum(F.col("copies") * v) for v in x]).alias("first"),
        F.array(*[F.sum(F.col("copies") * v * v) for v in x]).alias("second"),
    ).first()
    rows = {q: sums[f"rows_{q}"] or 0 for q in (0, 1)}
    if not all(rows.values()):
        discard(vectors)
        return NO_RANKING
    middle, squares = (np.array(sums[n]) / sum(rows.values()) for n in ("first", "second"))
    spread = _spread(np.sqrt(np.maximum(squares - middle**2, 0)))
    blocks = stage(_blocks(vectors, rows, block_rows, seed))
    weights = _newton(lambda w: _step(blocks, middle, spread, w), ridge, spread)
    threshold, median = _level(vectors, weights, rows)
    discard(blocks)
    discard(vectors)
    return _ranking(weights, threshold, median)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    seed: int = 3,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``, and the
    columns named by ``keep`` behind them.

    Reads ``doc_id`` and ``text``; of ``labels``, ``doc_id`` and ``quality``.
    Learns from every labelled document that is not held out. Of several labels
    of one document the lowest counts; NULL labels and labels without a document
    are passed over.

    NULL text counts as empty and is scored like any other. Equal texts get
    equal scores. A NULL ``doc_id`` is scored and not held out. Without labels
    of both kinds every score is 0.7. No rows give no rows.
    """
    rows = stage(document_features(docs, keep))
    known = (
        labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    ranking = fit_labelled(rows.join(known, "doc_id").select("quality", "features"), seed)
    score = ranking.score(F.col("features"))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), *keep
    ).select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
        *keep,
    )
