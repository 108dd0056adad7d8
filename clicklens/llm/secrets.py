"""Secrets in texts: candidates by pattern, false positives out by a forest."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log, log2

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm.labelled import Marked, marked_texts
from clicklens.llm.store import shared_folder, stage

MARK = "[SECRET]"
MIN_LENGTH = 6

FEATURES = (
    ["log_length", "digits", "upper", "lower", "other"]
    + ["class_changes", "vowel_changes", "entropy", "distinct", "hex"]
    + ["in_dictionary", "slashes", "dots", "test_path"]
    + ["key_word", "doubt_word", "assigned", "quoted", "issuer"]
)

# Prefixes that issuers give to their keys.
ISSUER = re.compile(
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_\w{20,}|xox[abprs]-[\w-]{10,}"
    r"|sk[-_](?:live[-_])?\w{16,}|AIza[\w-]{30,}|glpat-[\w-]{15,}|eyJ[\w-]{10,}\.[\w.-]+"
)
KEY_WORDS = frozenset(
    "token secret password passwd pwd pass key apikey api_key access_key secret_key"
    " private auth authorization bearer credential credentials".split()
)
DOUBT_WORDS = frozenset(
    "example sample dummy placeholder fake test changeme your xxxx redacted".split()
)
TEST_PATH = re.compile(r"(?:^|[/_.-])(?:tests?|examples?|samples?|docs?|fixtures?)(?![A-Za-z])")

ANCHOR = re.compile(r"[0-9=:]|-----BEGIN ")
KEY_BLOCK = re.compile(
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?(?:-----END [A-Z ]*PRIVATE KEY-----|\Z)",
    re.DOTALL,
)
VALUE = re.compile(r"[=:>]?[ \t]{0,3}[\"'`]?([\w+/.~@%$!#*=-]+)")
RUN = re.compile(r"[\w+/.~-]+={0,2}")
NAME = re.compile(r"([A-Za-z][\w.-]*)[\"'`]?[ \t]{0,3}$")
SPACE = re.compile(r"\s")
LETTERS = re.compile(r"[A-Za-z]{3,}")
WORDS = re.compile(r"[^\W\d_]{3,}")
VOWELS = frozenset("aeiouyAEIOUY")


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without the punctuation that ends a sentence or a cell; signs that
    fill a value up to a multiple of four belong to it."""
    while end > start and text[end - 1] in ".,;:!?#*$%&|~-":
        end -= 1
    filled = end
    while end > start and text[end - 1] in ".,;:!?#*$%&|=~-":
        end -= 1
    if 16 <= filled - start and (filled - start) % 4 == 0 and filled - end <= 2:
        end = filled
    while end > start and text[start] in ".,;:|=~":
        start += 1
    return start, end


def candidates(text: str, min_length: int = MIN_LENGTH) -> Iterator[tuple[int, int, str]]:
    """Spans that may be a secret, with the name they are assigned to or ''.

    Looked for are values after ``=`` or ``:``, and words of ``min_length``
    characters or more with a digit; private key blocks come as a whole under the
    name ``BEGIN``.
    """
    done = 0
    for anchor in ANCHOR.finditer(text):
        at = anchor.start()
        if at < done:
            continue
        name = ""
        if len(anchor[0]) > 1:
            block = KEY_BLOCK.match(text, at)
            if block:
                done = block.end()
                yield at, done, "BEGIN"
            continue
        if anchor[0] in "=:":
            value = VALUE.match(text, at + 1)
            named = NAME.search(text, max(0, at - 48), at)
            if not value or not named:
                continue
            name = named[1]
            start, end = value.span(1)
        else:
            start = at
            while start > done and RUN.match(text[start - 1]):
                start -= 1
            end = RUN.match(text, start).end()
            # a name and its value in one word are met at the sign between them
            if text[end - 1 : end + 1].strip("=") != text[end - 1 : end + 1]:
                before = text.rfind("=", start, end)
                if 0 <= before < end - 1:
                    continue
        start, end = _trimmed(text, start, end)
        done = max(done, end)
        if end - start >= (1 if name else min_length):
            yield start, end, name


def describe(
    text: str, start: int, end: int, name: str, words: set[str], source: str
) -> list[float]:
    """The features of one candidate; ``words`` are those of its text."""
    value = text[start:end]
    n = len(value)
    kinds = [
        0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3
        for c in value
    ]
    counts = [kinds.count(k) / n for k in range(4)]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:])) / n
    vowels = sum((a in VOWELS) != (b in VOWELS) for a, b in zip(value, value[1:])) / n
    tally = Counter(value)
    entropy = -sum(c / n * log2(c / n) for c in tally.values())
    known = sum(len(w) for w in LETTERS.findall(value) if w.lower() in words)
    before = re.split(r"[^\w]+", text[max(0, start - 48) : start].lower())[-4:]
    after = re.split(r"[^\w]+", text[end : end + 32].lower())[:3]
    near = {*before, *re.split(r"[.-]", name.lower()), name.lower()}
    doubt = DOUBT_WORDS & {*near, *after} or any(w in value.lower() for w in DOUBT_WORDS)
    return [
        log(n),
        *counts,
        changes,
        vowels,
        entropy,
        len(tally) / n,
        float(all(c in "0123456789abcdefABCDEF" for c in value)),
        known / n,
        value.count("/") / n,
        (value.count(".") + value.count("@")) / n,
        float(bool(TEST_PATH.search(source))),
        float(bool(KEY_WORDS & near) or any(near_.endswith(("_key", "_token", "_secret")) for near_ in near)),
        float(bool(doubt)),
        float(bool(name)),
        float(start > 0 and text[start - 1] in "\"'`"),
        float(bool(ISSUER.match(value))),
    ]


def text_findings(
    text: str, source: str, min_length: int = MIN_LENGTH
) -> tuple[list[tuple[int, int, str]], np.ndarray]:
    """Candidates of one text and their features."""
    found = list(candidates(text, min_length))
    if not found:
        return found, np.empty((0, len(FEATURES)))
    # the dictionary of a text: its words outside of all candidates
    words, last = set(), 0
    for start, end, _ in found:
        words.update(WORDS.findall(text[last:start].lower()))
        last = end
    words.update(WORDS.findall(text[last:].lower()))
    rows = [describe(text, s, e, name, words, source) for s, e, name in found]
    return found, np.array(rows)


def findings(texts: DataFrame) -> DataFrame:
    """``vector, label`` of every candidate in labelled texts.

    Reads ``text``, ``source`` and ``secret_spans``, the code points of all secrets
    in the text (``start``, ``end``). A candidate that shares a character with one
    has label 1, any other 0. NULL texts have no candidates, NULL spans no secrets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels = [], []
            for text, source, marked in zip(*(c.to_pylist() for c in batch.columns)):
                found, vectors = text_findings(text or "", source or "")
                rows += vectors.tolist()
                spans = [(s["start"], s["end"]) for s in marked or []]
                labels += [
                    int(any(start < e and s < end for s, e in spans)) for start, end, _ in found
                ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.int32())],
                ["vector", "label"],
            )

    rows = texts.select(
        F.col("text").cast("string"),
        F.col("source").cast("string"),
        F.col("secret_spans").cast("array<struct<start:int,end:int>>"),
    )
    return rows.mapInArrow(run, "vector array<double>, label int")


def marked_findings(spark: SparkSession, texts: list[Marked] | None = None) -> DataFrame:
    """``findings`` of the labelled texts that come with the library."""
    rows = [
        (m.text, m.source, [(m.start, m.end)] if m.end > m.start else [])
        for m in texts or marked_texts()
    ]
    schema = "text string, source string, secret_spans array<struct<start:int,end:int>>"
    return findings(spark.createDataFrame(rows, schema))


class Forest:
    """A trained forest as arrays, small enough to go along with a task."""

    def __init__(self, trees: list[np.ndarray], base: float) -> None:
        self.trees, self.base = trees, base

    def chance(self, vectors: np.ndarray) -> np.ndarray:
        """The mean over the trees of the share of secrets in a row's leaf."""
        if not self.trees:
            return np.full(len(vectors), self.base)
        total = np.zeros(len(vectors))
        for tree in self.trees:
            node = np.zeros(len(vectors), int)
            while True:
                feature = tree["feature"][node]
                inner = np.flatnonzero(feature >= 0)
                if not len(inner):
                    break
                at = node[inner]
                low = vectors[inner, feature[inner]] <= tree["threshold"][at]
                node[inner] = np.where(low, tree["left"][at], tree["right"][at])
            total += tree["share"][node]
        return total / len(self.trees)


NODE = np.dtype(
    [
        ("feature", int),
        ("threshold", float),
        ("left", int),
        ("right", int),
        ("share", float),
    ]
)


def train_forest(
    labelled: DataFrame, trees: int = 20, depth: int = 10, max_findings: int = 20_000, seed: int = 5
) -> Forest:
    """A random forest on at most ``max_findings`` different labelled findings
    (``vector``, ``label``) of each label, those whose features hash lowest.

    Without findings of both labels there is no forest and every candidate gets
    the only label there is, or none.
    """
    spark = labelled.sparkSession
    labelled = labelled.select("vector", "label").distinct()
    order = F.xxhash64("vector")
    sample = stage(
        labelled.filter("label = 0").orderBy(order).limit(max_findings)
        .union(labelled.filter("label = 1").orderBy(order).limit(max_findings))
        .select(array_to_vector("vector").alias("features"), F.col("label").cast("double").alias("label"))
    )
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Forest([], max(counts, default=0.0))
    model = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt"
    ).fit(sample)
    path = f"{shared_folder(spark)}/clicklens-llm/forest-{model.uid}"
    model.write().overwrite().save(path)
    # at most trees * 2 ** (depth + 1) rows
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    size = max(node["id"] for node in nodes) + 1
    built = [np.zeros(size, NODE) for _ in range(trees)]
    for node in nodes:
        stats = node["impurityStats"]
        split = node["split"]
        leaf = node["leftChild"] < 0
        built[node["treeID"]][node["id"]] = (
            -1 if leaf else split["featureIndex"],
            0.0 if leaf else split["leftCategoriesOrThreshold"][0],
            node["leftChild"],
            node["rightChild"],
            stats[1] / sum(stats) if sum(stats) else counts[1.0] / sum(counts.values()),
        )
    return Forest(built, 0.0)


def scan_text(
    text: str, source: str, forest: Forest, cutoff: float, min_length: int = MIN_LENGTH
) -> tuple[int, list[tuple[int, int]], str]:
    """Candidates, spans of secrets, and the text with these marked."""
    found, vectors = text_findings(text, source, min_length)
    if not found:
        return 0, [], text
    chances = forest.chance(vectors)
    spans = [
        (start, end)
        for (start, end, name), chance in zip(found, chances)
        if name == "BEGIN" or chance >= cutoff
    ]
    pieces, last = [], 0
    for start, end in spans:
        pieces += [text[last:start], MARK]
        last = end
    return len(found), spans, "".join([*pieces, text[last:]])


def scan_secrets(
    docs: DataFrame,
    forest: Forest | None = None,
    cutoff: float = 0.5,
    min_length: int = MIN_LENGTH,
) -> DataFrame:
    """``docs`` with its secrets marked in ``text``, and ``n_candidates``,
    ``n_secrets`` and ``secret_spans`` (code points of the old text) besides.

    Private key blocks always count; other candidates when the forest gives them
    a chance of ``cutoff``. Values that are assigned to a name are candidates
    whatever their length, other words from ``min_length`` characters on. Without
    a ``forest`` one is trained on the labelled texts of ``labelled.marked_texts``;
    findings labelled elsewhere go through ``findings`` and ``train_forest``.

    Reads ``text`` and ``source``; all columns of ``docs`` are passed on, but
    those named like one of the three are replaced. NULL text stays NULL and has
    no candidates; a NULL source counts as empty. Repeated rows are scanned each.
    No rows give no rows.
    """
    if forest is None:
        forest = train_forest(marked_findings(docs.sparkSession))
    added = ["n_candidates", "n_secrets", "secret_spans"]
    passed = docs.drop(*added)
    kinds = ["int", "int", "array<struct<start:int,end:int>>"]
    schema = passed.withColumns(
        {"text": F.col("text").cast("string")}
        | {name: F.lit(None).cast(kind) for name, kind in zip(added, kinds)}
    ).schema
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, texts = [], [], []
            for text, source in zip(batch.column("text"), batch.column("source")):
                old = text.as_py()
                n, found, new = scan_text(
                    old or "", str(source.as_py() or ""), forest, cutoff, min_length
                )
                counts.append(n)
                spans.append([{"start": s, "end": e} for s, e in found])
                texts.append(None if old is None else new)
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["text"] = pa.array(texts, pa.string())
            columns["n_candidates"] = pa.array(counts, pa.int32())
            columns["n_secrets"] = pa.array(map(len, spans), pa.int32())
            columns["secret_spans"] = pa.array(spans, spans_type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return passed.mapInArrow(run, schema)
