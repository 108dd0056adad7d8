"""SentencePiece segmentations sampled without replacement, and their decoding."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
BATCH_CHARS = 1_000_000
MOST_NODES = 2_000_000


class Vocabulary:
    """The pieces of a model as a trie in sorted arrays."""

    def __init__(self, path: str, alpha: float) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int64)
        self.output = np.empty(n, object)
        self.codes = np.zeros(0x110000, np.int32)  # 0: in no piece
        log_p: dict[int, float] = {}
        codes: dict[int, int] = {}
        # whether texts may be cut before a space mark that follows another
        # character, and on both sides of a line break
        self.in_units = True
        edges: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i, name in enumerate(names):
            if model.is_byte(i):
                value = int(name[1:-1], 16)
                self.byte_ids[value] = i
                self.output[i] = bytes([value])
                continue
            self.output[i] = name.replace(SPACE, " ").encode()
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.output[i] = b""
                continue
            # scores of such models are ranks, and word frequencies go with 1/rank
            log_p[i] = -alpha * np.log1p(max(0.0, -model.get_score(i)))
            self.in_units &= SPACE not in name.lstrip(SPACE) and "\n" not in name
            state = 0
            for c in map(ord, name):
                code = codes.setdefault(c, len(codes) + 1)
                state = edges.setdefault((state, code), len(ends))
                if state == len(ends):
                    ends.append(-1)
            ends[state] = i
        self.codes[list(codes)] = list(codes.values())
        self.width = len(codes) + 1
        keys = np.array([s * self.width + c for s, c in edges], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.next = np.fromiter(edges.values(), np.int64, len(edges))[order]
        self.ends = np.array(ends)
        self.bytes_of = pa.array(self.output, pa.large_binary())
        self.n_bytes = np.array([len(o) for o in self.output])
        # the first character of a piece, which most steps look up
        self.first = np.full(self.width, -1)
        top = self.keys < self.width
        self.first[self.keys[top]] = self.next[top]
        self.log_p = np.full(n, -np.inf)
        self.log_p[list(log_p)] = list(log_p.values())
        self.byte_log_p = -alpha * np.log1p(n)

    def ids(self, pieces: np.ndarray) -> np.ndarray:
        """Piece ids; a negative entry is a character that falls back to bytes."""
        if (pieces >= 0).all():
            return pieces
        parts = [
            [p] if p >= 0 else self.byte_ids[list(chr(-p - 1).encode())].tolist()
            for p in pieces.tolist()
        ]
        return np.array([i for part in parts for i in part], np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space that encoding puts in front."""
        text = b"".join(self.output[ids].tolist()).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class Lattices:
    """Lattices of units: a node per character, an edge per piece that starts there.

    ``p`` is the chance of an edge among those of its node, given that pieces
    are drawn by their probabilities and have to end with the unit.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.start: dict[str, int] = {}
        self.nodes = self.edges = 0  # used of the arrays, which have room for more
        self.first = np.zeros(1, np.int32)  # first edge of each node, and the end
        self.target = np.empty(0, np.int32)
        self.piece = np.empty(0, np.int32)
        self.p = np.empty(0)
        self.so_far = np.empty(0)  # p of the edge and those of its node before it

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        held, end = getattr(self, name), at + len(values)
        if end > len(held):
            wider = np.empty(max(end, 2 * len(held)), held.dtype)
            wider[:at] = held[:at]
            setattr(self, name, wider)
            held = wider
        held[at:end] = values

    def add(self, units: list[str]) -> list[int]:
        """Builds the lattices of new units, all at once; the first node of each."""
        v = self.vocabulary
        base = self.nodes
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(lengths)
        starts = (base + ends - lengths).tolist()
        self.start.update(zip(units, starts))
        points = np.frombuffer("".join(units).encode("utf-32-le", "replace"), "<u4")
        points = points.astype(np.int64)
        n = len(points)
        codes = v.codes[points]
        left = np.repeat(ends, lengths) - np.arange(n)

        state = v.first[codes]
        at, length = np.flatnonzero(state >= 0), 1
        state = state[at]
        found = []  # (where a piece starts, its length, the piece), shortest first
        counts = np.zeros(n, np.int64)
        while len(at):
            piece = v.ends[state]
            whole = piece >= 0
            found.append((at[whole], length, piece[whole]))
            counts[at[whole]] += 1
            if length == 1:
                unknown = np.flatnonzero(counts == 0)
            more = left[at] > length
            at, state = at[more], state[more]
            key = state * v.width + codes[at + length]
            place = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
            hit = v.keys[place] == key
            at, state, length = at[hit], v.next[place[hit]], length + 1
        if not found:
            unknown = np.arange(n)
        counts[unknown] += 1

        # edges in the order of what is left from their nodes on, then by length
        by_left = np.argsort(left * n + np.arange(n))
        begin = np.empty(n, np.int64)
        begin[by_left] = np.cumsum(counts[by_left]) - counts[by_left]
        size = int(counts.sum())
        source, span = np.repeat(by_left, counts[by_left]), np.ones(size, np.int64)
        pieces, score = np.empty(size, np.int64), np.empty(size)
        free = begin.copy()
        plain = points[unknown] < 0x80
        one_byte = v.byte_ids[np.where(plain, points[unknown], 0)]
        pieces[free[unknown]] = np.where(plain, one_byte, -points[unknown] - 1)
        bytes_of = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        score[free[unknown]] = v.byte_log_p * bytes_of[unknown]
        free[unknown] += 1
        for at, length, piece in found:
            to = free[at]
            span[to], pieces[to], score[to] = length, piece, v.log_p[piece]
            free[at] += 1

        # total weight from each node to the end of its unit, shortest way first
        total = np.zeros(n + 1)
        last = span == left[source]
        goal = source + span
        nodes_to = np.flatnonzero(np.diff(left[by_left], prepend=0, append=-1))
        edges_to = np.append(begin[by_left], size)[nodes_to]
        for one, other, low, high in zip(
            nodes_to[:-1], nodes_to[1:], edges_to[:-1], edges_to[1:]
        ):
            own = by_left[one:other]
            onward = np.where(last[low:high], 0.0, total[goal[low:high]])
            total[own] = np.logaddexp.reduceat(score[low:high] + onward, begin[own] - low)
        p = np.exp(score + np.where(last, 0.0, total[goal]) - total[source])

        # the likeliest edge of a node first: most draws end there
        order, so_far = np.empty(size, np.int64), np.empty(size)
        first = np.cumsum(counts) - counts
        for many in np.flatnonzero(np.bincount(counts)):
            own, steps = np.flatnonzero(counts == many), np.arange(many)
            held = begin[own][:, None] + steps
            if many > 1:
                likeliest = np.argsort(-p[held], axis=1, kind="stable")
                held = np.take_along_axis(held, likeliest, 1)
            to = first[own][:, None] + steps
            order[to] = held
            # summed edge by edge, so that it does not depend on the other nodes
            so_far[to] = np.cumsum(p[held], axis=1)
        so_far[first + counts - 1] = 1.0
        self._put("first", base, np.append(first, size) + self.edges)
        self._put("target", self.edges, np.where(last, -1, goal + base)[order])
        self._put("piece", self.edges, pieces[order])
        self._put("p", self.edges, p[order])
        self._put("so_far", self.edges, so_far)
        self.nodes += n
        self.edges += size
        return starts

    def drawn(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node, by numbers ``u`` from 0 to 1."""
        edge = self.first[nodes].astype(np.int64)
        left = np.flatnonzero(u >= self.so_far[edge])
        while len(left):
            edge[left] += 1
            left = left[u[left] >= self.so_far[edge[left]]]
        return edge

    def starts(self, units: pa.DictionaryArray) -> np.ndarray:
        """The first node of each unit."""
        if self.nodes > MOST_NODES:
            self.clear()
        different = units.dictionary.to_numpy(zero_copy_only=False).tolist()
        nodes = list(map(self.start.get, different))
        new = [i for i, node in enumerate(nodes) if node is None]
        if new:
            for i, node in zip(new, self.add([different[i] for i in new])):
                nodes[i] = node
        return np.array(nodes, np.int64)[units.indices.to_numpy()]

    def units(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The units of all texts, and how many each text has.

        Where no piece has a space mark behind another character nor a line
        break in it, the lattice of a text is the chain of the lattices of its
        words and line breaks; else its only unit is the text.
        """
        whole = "".join(texts)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        points = np.frombuffer(whole.encode("utf-32-le", "replace"), "<u4")
        begins = np.zeros(len(points) + 1, bool)
        begins[np.append(0, ends)] = True
        if self.vocabulary.in_units:
            mark, line = points == ord(SPACE), points == ord("\n")
            begins[:-1] |= line
            begins[1:] |= line
            begins[1:-1] |= mark[1:] & ~mark[:-1]
        at = np.flatnonzero(begins)
        bytes_to = np.zeros(len(points) + 1, np.int64)
        np.cumsum(
            1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=bytes_to[1:]
        )
        cut = pa.LargeStringArray.from_buffers(
            len(at) - 1,
            pa.py_buffer(bytes_to[at]),
            pa.py_buffer(whole.encode("utf-8", "replace")),
        )
        counts = np.diff(np.searchsorted(at, ends), prepend=0)
        return cut.dictionary_encode(), counts


@lru_cache(maxsize=2)
def lattices(path: str, alpha: float) -> Lattices:
    """One cache of lattices per Python worker."""
    return Lattices(Vocabulary(path, alpha))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers (SplitMix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _uniform(seed: np.ndarray, number: int) -> np.ndarray:
    """Numbers above 0 and below 1 that depend on the seeds and nothing else."""
    drawn = _mixed(seed ^ np.uint64(number)) >> np.uint64(11)
    return (drawn.astype(float) + 0.5) * 2.0**-53


@dataclass
class Path:
    """What a round drew for each text: tokens from where it left an older path.

    ``bound`` is the perturbed value of the best segmentation that shares the
    path up to a token and takes another edge there.
    """

    edge: np.ndarray
    unit: np.ndarray
    before: np.ndarray  # log probability of what precedes the token
    bound: np.ndarray
    offsets: np.ndarray  # of each text's tokens


def _draw(net: Lattices, nodes: np.ndarray, seeds: np.ndarray) -> tuple:
    """Edges from each node to the end of its unit, and which node they are of."""
    owner = np.arange(len(nodes))
    edges, owners, step = [], [], 0
    while len(owner):
        edge = net.drawn(nodes, _uniform(seeds[owner], step))
        edges.append(edge)
        owners.append(owner)
        nodes = net.target[edge]
        going = nodes >= 0
        nodes, owner, step = nodes[going], owner[going], step + 1
    if not edges:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge, owner = np.concatenate(edges), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return edge[order], owner[order]


def _bounds(rest: np.ndarray, limit: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Gumbel values at the log weights ``rest``, given they are below ``limit``."""
    wait = -np.log(_uniform(seeds, 1 << 40))
    with np.errstate(over="ignore"):
        return rest - np.log(np.exp(rest - limit) + wait)


@dataclass
class Sample:
    pieces: np.ndarray
    log_prob: float
    value: float
    inclusion: float = 1.0


def sample_batch(
    net: Lattices, texts: list[str], keys: np.ndarray, k: int
) -> list[list[Sample]]:
    """Up to ``k`` distinct segmentations of each text, likeliest to be drawn first.

    Gumbel top-k: all segmentations of a text have a perturbed log probability,
    and the k largest are a sample without replacement. A* search over the tree
    of prefixes finds them in falling order. The largest value of a subtree is a
    Gumbel variable at the log weight of the subtree and bounds what is in it;
    the first path is one draw per node, and of all subtrees left aside the one
    with the largest bound holds the next segmentation, so it is opened next. A
    text with fewer segmentations than ``k`` gives all it has.
    """
    marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
    units, counts = net.units(marked)
    nodes = net.starts(units)
    unit_end = np.cumsum(counts)
    unit_start = unit_end - counts
    keys = _mixed(keys)
    samples: list[list[Sample]] = [[] for _ in texts]
    paths: list[Path] = []
    tokens: list[dict[int, np.ndarray]] = []  # all edges of each text's path
    lead: list[dict[int, int]] = []  # tokens before those of the Path
    used: dict[tuple[int, int], list[int]] = {}  # edges taken at a token

    def extend(
        round_: int, texts_: np.ndarray, first: list, from_unit: np.ndarray,
        before: np.ndarray, limit: np.ndarray,
    ) -> None:
        """Draws the rest of each text's path; ``first`` has the token where it
        leaves another one: (edge, unit, weight left there, node behind it)."""
        heads, owners_text, own_units = [], [], []
        for text, start, token in zip(texts_.tolist(), from_unit.tolist(), first):
            rest = np.arange(start, unit_end[text])
            own, at = nodes[rest], rest
            if token and token[3] >= 0:
                own, at = np.append(token[3], own), np.append(token[1], rest)
            heads.append(own)
            own_units.append(at)
            owners_text.append(np.full(len(own), text))
        empty = [np.empty(0, np.int64)]
        own_units = np.concatenate(own_units or empty)
        text_of = np.concatenate(owners_text or empty)
        place = (own_units - unit_start[text_of]).astype(np.uint64)
        seeds = _mixed(keys[text_of] ^ (place << np.uint64(8)) ^ np.uint64(round_))
        edge, owner = _draw(net, np.concatenate(heads or empty), seeds)
        text, unit = text_of[owner], own_units[owner]
        p = net.p[edge]
        with np.errstate(divide="ignore"):
            rest = np.log1p(-np.minimum(p, 1.0))  # of the other edges of its node
        heads_at = [i for i, token in enumerate(first) if token]
        if heads_at:
            edge = np.append([first[i][0] for i in heads_at], edge)
            unit = np.append([first[i][1] for i in heads_at], unit)
            rest = np.append([first[i][2] for i in heads_at], rest)
            text = np.append(texts_[heads_at], text)
            order = np.argsort(text, kind="stable")
            edge, unit, rest, text = (x[order] for x in (edge, unit, rest, text))
        offsets = np.searchsorted(text, np.arange(len(texts) + 1))
        level = np.zeros(len(texts))
        level[texts_] = before
        top = np.zeros(len(texts))
        top[texts_] = limit
        ahead, final = np.log(net.p[edge]), level.copy()
        for t in texts_.tolist():  # a sum must not depend on other texts
            own = slice(offsets[t], offsets[t + 1])
            summed = np.cumsum(ahead[own]) + level[t]
            if len(summed):
                final[t] = summed[-1]
            ahead[own] = np.append(level[t], summed[:-1])[: len(summed)]
        number = np.arange(len(edge)) - offsets[:-1][text]
        seeds = _mixed(
            keys[text] ^ (number.astype(np.uint64) << np.uint64(8)) ^ np.uint64(round_)
        )
        bound = _bounds(ahead + rest, top[text], seeds)
        paths.append(Path(edge, unit, ahead, bound, offsets))
        for i, t in enumerate(texts_.tolist()):
            own = edge[offsets[t] : offsets[t + 1]]
            full = np.append(tokens[first[i][4]][t][: first[i][5]], own) if first[i] else own
            tokens_now[t] = full
            samples[t].append(Sample(net.piece[full], float(final[t]), float(limit[i])))

    everyone = np.arange(len(texts))
    value = -np.log(-np.log(_uniform(keys, 1 << 41)))
    tokens_now: dict[int, np.ndarray] = {}
    extend(0, everyone, [None] * len(texts), unit_start, np.zeros(len(texts)), value)
    tokens.append(tokens_now)
    lead.append(dict.fromkeys(range(len(texts)), 0))

    for round_ in range(1, k + 1):
        # the largest bound of each text over all its paths
        best = np.full((len(paths), len(texts)), -np.inf)
        for i, path in enumerate(paths):
            filled = np.flatnonzero(np.diff(path.offsets))
            if len(filled):
                best[i, filled] = np.maximum.reduceat(
                    path.bound, path.offsets[:-1][filled]
                )
        source, value = best.argmax(axis=0), best.max(axis=0)
        if round_ == k:
            for text, level in zip(samples, value.tolist()):
                for sample in text:
                    sample.inclusion = -np.expm1(-np.exp(min(sample.log_prob - level, 700.0)))
            break
        open_ = np.flatnonzero(value > -np.inf)
        first, from_unit, before, taken_at = [], [], [], []
        lead_now = {}
        chosen = _uniform(keys, (1 << 42) + round_)
        for t in open_.tolist():
            i = int(source[t])
            path = paths[i]
            low, high = path.offsets[t], path.offsets[t + 1]
            at = int(low + path.bound[low:high].argmax())
            # of the type of net.first, else numpy converts all of that first
            own_edge = net.first.dtype.type(path.edge[at])
            node = int(np.searchsorted(net.first[: net.nodes + 1], own_edge, "right")) - 1
            taken = used.pop((i, at), [int(path.edge[at])])
            others = [e for e in range(net.first[node], net.first[node + 1]) if e not in taken]
            weights = np.cumsum(net.p[others])
            pick = min(int(np.searchsorted(weights, chosen[t] * weights[-1])), len(others) - 1)
            edge = others[pick]
            rest = weights[-1] - net.p[edge] if len(others) > 1 else 0.0
            path.bound[at] = -np.inf
            position = lead[i][t] + at - int(low)
            unit = int(path.unit[at])
            first.append(
                (edge, unit, np.log(rest) if rest > 0 else -np.inf,
                 int(net.target[edge]), i, position)
            )
            taken_at.append([*taken, edge])
            lead_now[t] = position
            from_unit.append(unit + 1)
            before.append(path.before[at])
        tokens_now = {}
        extend(
            round_, open_, first, np.array(from_unit, np.int64),
            np.array(before), value[open_],
        )
        for t, taken in zip(open_.tolist(), taken_at):
            used[len(paths) - 1, int(paths[-1].offsets[t])] = taken
        tokens.append(tokens_now)
        lead.append(lead_now)
    return samples


def sample_pieces(
    docs: DataFrame,
    k: int = 2,
    alpha: float = 1.0,
    model: str = MODEL,
    with_ids: bool = True,
) -> DataFrame:
    """Sampled segmentations of each row of ``docs``.

    Returns ``doc_id``, ``n_pieces``, ``log_probs``, ``inclusion`` (the chance of
    each to be in the sample, given the next largest value), ``ids_crc32`` and
    ``round_trip`` (all decode to the text), with an array entry per distinct
    segmentation, ``k`` or as many as there are; ``with_ids`` adds ``ids``.

    Pieces are drawn with probability 1 / (1 + rank) to the power ``alpha``;
    characters in no piece fall back to bytes. Draws depend on ``doc_id``, the
    text and ``k`` alone. ``model`` is a path on every executor.

    NULL and empty texts have one segmentation without pieces. A NULL ``doc_id``
    has a seed of its own; repeated rows get equal results. No rows give no
    rows; columns besides ``doc_id`` and ``text`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = lattices(model, alpha)
        for batch in batches:
            sizes = np.cumsum(pc.utf8_length(batch.column("text")).fill_null(0).to_numpy())
            cut = 0
            while cut < batch.num_rows:
                done = sizes[cut - 1] if cut else 0
                end = max(cut + 1, int(np.searchsorted(sizes, done + BATCH_CHARS)))
                yield _sampled(net, batch.slice(cut, end - cut), k, with_ids)
                cut = end

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")
    )
    schema = (
        "doc_id bigint, n_pieces array<int>, log_probs array<double>,"
        " inclusion array<double>, ids_crc32 array<bigint>, round_trip boolean"
    )
    return rows.mapInArrow(run, schema + ", ids array<array<int>>" * with_ids)


def _sampled(
    net: Lattices, batch: pa.RecordBatch, k: int, with_ids: bool
) -> pa.RecordBatch:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    keys = np.array(
        [0 if i is None else i + (1 << 63) for i in batch.column("doc_id").to_pylist()],
        np.uint64,
    )
    v = net.vocabulary
    rows = sample_batch(net, texts, keys, k)
    ids = [[v.ids(s.pieces).astype(np.int32) for s in row] for row in rows]
    sizes = [len(i) for own in ids for i in own]
    token_ends = np.cumsum([0, *sizes])
    row_ends = np.cumsum([0, *map(len, ids)])
    flat = np.concatenate([i for own in ids for i in own] or [np.empty(0, np.int32)])
    same = _decodes_to(v, texts, flat, token_ends, row_ends)
    columns = {
        "doc_id": batch.column("doc_id"),
        "n_pieces": pa.array([[len(i) for i in own] for own in ids], pa.list_(pa.int32())),
        "log_probs": pa.array([[s.log_prob for s in row] for row in rows], pa.list_(pa.float64())),
        "inclusion": pa.array([[s.inclusion for s in row] for row in rows], pa.list_(pa.float64())),
        "ids_crc32": pa.array([[crc32(i.tobytes()) for i in own] for own in ids], pa.list_(pa.int64())),
        "round_trip": pa.array(same, pa.bool_()),
    }
    if with_ids:
        inner = pa.ListArray.from_arrays(pa.array(token_ends, pa.int32()), pa.array(flat, pa.int32()))
        columns["ids"] = pa.ListArray.from_arrays(pa.array(row_ends, pa.int32()), inner)
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _decodes_to(
    v: Vocabulary, texts: list[str], flat: np.ndarray, token_ends: np.ndarray, row_ends: np.ndarray
) -> list[bool]:
    """Whether all segmentations of each text, one after the other in ``flat``,
    are the bytes of the text with the space that encoding puts in front."""
    pieces = v.bytes_of.take(pa.array(flat))
    data = pieces.buffers()[2].to_pybytes() if len(flat) else b""
    ends = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(v.n_bytes[flat], out=ends[1:])
    ends = ends[token_ends].tolist()
    same = []
    for row, text in enumerate(texts):
        wanted = (" " + text.replace(SPACE, " ")).encode() if text else b""
        own = range(row_ends[row], row_ends[row + 1])
        same.append(all(data[ends[i] : ends[i + 1]] == wanted for i in own))
    return same


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id`` and ``texts``: each entry of ``ids`` as text; NULL stays NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = lattices(model, 1.0).vocabulary
        for batch in batches:
            texts = [
                None if own is None else [v.decode(np.array(i, np.int64)) for i in own]
                for own in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.list_(pa.string()))],
                ["doc_id", "texts"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id bigint, texts array<string>"
    )
