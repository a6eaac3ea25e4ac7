"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

A byte is eight binary decisions, one per node of the binary tree of its
leading bits. For each such node there is a tree of contexts: the last 0, 1,
..., ``depth`` bytes. Every context node holds a Krichevsky-Trofimov
estimate of its decisions in the training texts, and its weighted
probability mixes that estimate with the product of its children's. A
decision's probability then mixes the estimates of all depths along the
context path, each with the weight that the training texts leave it.

The counts of all (context, byte) grams are gathered by one aggregation. The
trees are built where grams meet: grams with the same last two bytes of
context meet in one part, which holds all their nodes of depth two and more;
the depths above are small and built from the parts' sums. A context of two
bytes that holds more than a small share of all bytes (there are few such) is
dealt by its third byte too, and its own nodes are built from sums as well, so
that no part holds a hot one whole. Grams that occur
only in texts not learned from are gathered too, with count zero, so the
model is a table of the log-probability of every gram there is and scoring a
text adds up lookups. The most frequent grams are looked up where the text is;
a document's other grams are sent, counted, to the parts that hold their
log-probabilities, and come back as one sum per row and part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .repeats import keyed, mixed, parts_for, slices, tasks_for
from .substring import Words

#: Most frequent grams whose log-probabilities are shipped to the tasks; the other grams' are met in an exchange.
SHARD = 1_500_000
#: Most frequent words whose counts are shipped to the tasks; the other words' counts are met in an exchange.
HEAD = 1 << 19
#: Distinct keys that a task gathers before it sends them on.
GATHER = 1 << 20
#: Bytes of text that a task looks at together.
SLICE = 1 << 20

#: Contexts of two bytes with at least one in so many of all bytes are dealt by three bytes; there are at most so many.
HOT_SHARE = 1024

WORD, GRAM = 0, 1
COUNT_SCHEMA = "part int, kind int, key binary, n binary"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def learned(id_col: str = "doc_id") -> Column:
    """Whether a document is learned from: crc32(doc_id as text) mod 5 is not 1. A null doc_id is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 1, F.lit(True))


def gram_codes(data: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, ends of the texts in them): per byte of each text and its closing 0 byte, the gram
    (last context byte, the one before, ..., byte), most significant first; before a text stand zeros."""
    n = np.diff(ends) + 1
    to = np.concatenate([[0], np.cumsum(n)])
    seq = np.zeros(to[-1], np.uint8)
    place = np.arange(len(data)) + np.repeat(np.arange(len(n)), n - 1)
    seq[place] = data
    since = np.arange(to[-1]) - np.repeat(to[:-1], n)
    code = np.zeros(to[-1], np.uint64)
    for k in range(1, depth + 1):
        back = np.zeros(to[-1], np.uint8)
        back[k:] = seq[:-k] if k < to[-1] else 0
        back[since < k] = 0
        code |= back.astype(np.uint64) << np.uint64(8 * (depth - k + 1))
    return code | seq.astype(np.uint64), to


def _tally(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal keys; keys come out ascending."""
    key, n = (np.concatenate(x) for x in zip(*pairs))
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    return key[at], np.add.reduceat(n, at) if len(at) else n


def _part(kind: int, key: np.ndarray, parts: int, depth: int, place: np.ndarray) -> np.ndarray:
    """Grams are dealt by their last two context bytes, hot ones by three; words by their hash."""
    of = key
    if kind == GRAM:
        of = key >> np.uint64(8 * (depth - 1))
        if depth > 2:
            of = np.where(place[of.astype(np.int64)] >= 0, (key >> np.uint64(8 * (depth - 2))) + np.uint64(1 << 32), of)
    return (mixed(of + np.uint64(kind)) >> np.uint64(33)) % np.uint64(parts)


def _packed(kind: int, key: np.ndarray, n: np.ndarray, parts: int, depth: int, place: np.ndarray) -> Iterator[tuple]:
    part = _part(kind, key, parts, depth, place).astype(np.int64)
    order = np.argsort(part, kind="stable")
    key, n, part = key[order], n[order], part[order]
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    for lo, hi in zip(at, np.append(at[1:], len(part))):
        yield int(part[lo]), kind, key[lo:hi].tobytes(), n[lo:hi].tobytes()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    part, kind, key, n = zip(*rows) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(key, pa.binary()),
                                       pa.array(n, pa.binary())], names=["part", "kind", "key", "n"])


def _pairs_of_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, v): how many bytes follow each context of two bytes."""
    sums = np.zeros(1 << 16, np.int64)
    for b in batches:
        for part, data, ends in slices(b, size=SLICE):
            code, _ = gram_codes(data, ends, 2)
            sums += np.bincount((code >> np.uint64(8)).astype(np.int64), minlength=1 << 16)
    own = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own])], names=["i", "v"])


def hot_contexts(base: DataFrame, depth: int, share: int = HOT_SHARE) -> np.ndarray:
    """For each context of two bytes (most recent first) its number among the hot ones, else -1."""
    place = np.full(1 << 16, -1, np.int64)
    if depth > 2:
        seen = base.select("row", "doc_id", "text").mapInArrow(_pairs_of_context, "i long, v long").groupBy("i").agg(F.sum("v")).collect()  # at most 2^16 rows
        every = sum(v for _, v in seen)
        hot = sorted(i for i, v in seen if v * share >= every)
        place[hot] = np.arange(len(hot))
    return place


def _count(batches: Iterator[pa.RecordBatch], depth: int, parts: int, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {WORD: [], GRAM: []}

    def flush(kind: int) -> pa.RecordBatch:
        key, n = _tally(held[kind])
        held[kind] = []
        return _batch(list(_packed(kind, key, n, parts, depth, place)))

    for b in batches:
        for part, data, ends in slices(b, size=SLICE):
            own = part.column(3).to_numpy(zero_copy_only=False)
            code, to = gram_codes(data, ends, depth)
            use = np.repeat(own, np.diff(to))
            lower = Words(_LOWER[data], ends)
            word = lower.word[np.repeat(own, np.diff(lower.first))]
            for kind, key, once in ((WORD, word, 1), (GRAM, code[use], 1), (GRAM, code[~use], 0)):
                key, n = np.unique(key, return_counts=True)
                held[kind].append((key, n.astype(np.int64) * once))
            for kind in held:
                if sum(len(k) for k, _ in held[kind]) > GATHER:
                    held[kind] = [_tally(held[kind])]
                    if len(held[kind][0][0]) > GATHER // 2:
                        yield flush(kind)
    for kind in held:
        if held[kind]:
            yield flush(kind)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part and kind -> one row per part and kind: all its keys, ascending, with their
    counts, and a histogram of the counts by powers of two."""
    now, held = None, []

    def batch() -> pa.RecordBatch:
        key, n = _tally(held)
        size = np.bincount(np.frexp(n.astype(np.float64))[1], minlength=64)[:64]  # 2^(e-1) <= n < 2^e; 0 for n = 0
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([key.tobytes()], pa.binary()),
             pa.array([n.tobytes()], pa.binary()), pa.array([int(n.sum())]), pa.array([len(key)]),
             pa.array([size.tolist()], pa.list_(pa.int64()))],
            names=["part", "kind", "key", "n", "total", "distinct", "sizes"])

    for b in batches:
        for part, kind, key, n in zip(*[c.to_pylist() for c in b.columns]):
            if (part, kind) != now and held:
                yield batch()
                held = []
            now = part, kind
            held.append((np.frombuffer(key, np.uint64), np.frombuffer(n, np.int64)))
    if held:
        yield batch()


def gather(base: DataFrame, depth: int, tasks: int, place: np.ndarray) -> DataFrame:
    """Counts of all words and grams: (part, kind, key, n, total, distinct, sizes), one row per part and kind."""
    sent = base.select("row", "doc_id", "text", learned().alias("own")).mapInArrow(
        partial(_count, depth=depth, parts=parts_for(tasks), place=place), COUNT_SCHEMA)
    return stage(sent.repartition(tasks, "part", "kind").sortWithinPartitions("part", "kind").mapInArrow(
        _sum_up, COUNT_SCHEMA + ", total long, distinct long, sizes array<long>"), "ctw-counts")


class Lookup:
    """Hash table from 64-bit keys to doubles, probed for whole arrays at once."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, key: np.ndarray, value: np.ndarray):
        self.bits = max(4, int(2 * len(key)).bit_length())
        self.key, self.value = np.full(1 << self.bits, self.EMPTY), np.zeros(1 << self.bits)
        at, left = self._slot(key), np.arange(len(key))
        while len(left):
            free = self.key[at] == self.EMPTY
            self.key[at[free]] = key[left[free]]
            won = free & (self.key[at] == key[left])
            self.value[at[won]] = value[left[won]]
            at, left = (at[~won] + 1) & ((1 << self.bits) - 1), left[~won]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (mixed(key) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found flags, values; 0 where not found)."""
        at, found, out = self._slot(key), np.zeros(len(key), bool), np.zeros(len(key))
        left = np.arange(len(key))
        while len(left):
            k = self.key[at]
            hit = k == key[left]
            found[left[hit]], out[left[hit]] = True, self.value[at[hit]]
            on = ~hit & (k != self.EMPTY)
            at, left = (at[on] + 1) & ((1 << self.bits) - 1), left[on]
        return found, out


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5, by Stirling's series after eight steps up."""
    low = np.zeros(np.shape(x))
    for k in range(8):
        low += np.log(x + k)
    y = x + 8
    return ((y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3)
            + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7) + 1 / (1188 * y ** 9) - 691 / (360360 * y ** 11) - low)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - np.log(np.pi)


class Level:
    """The context nodes of one depth: for each of the eight decisions, nodes over ascending grams (context, byte)."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        self.code, self.n = code, n
        self.node, self.counts, self.log_kt = [], [], []
        for k in range(8):
            head = code >> np.uint64(8 - k)
            new = np.append(True, head[1:] != head[:-1]) if len(head) else np.empty(0, bool)
            node = np.cumsum(new) - 1
            one = (code >> np.uint64(7 - k)) & np.uint64(1)
            size = int(new.sum())
            b = np.bincount(node, n * one, size)
            a = np.bincount(node, n, size) - b
            self.node.append(node)
            self.counts.append((a, b))
            self.log_kt.append(log_kt(a, b))
        self.log_weighted = list(self.log_kt)
        self.stop = [np.ones(len(x)) for x in self.log_kt]  # weight of the node's own estimate

    def above(self, depth: int) -> tuple[Level, np.ndarray]:
        """The level without the oldest byte of context (of ``depth`` bytes), its weights set from this one; and the map of grams."""
        short = (self.code >> np.uint64(16)) << np.uint64(8) | (self.code & np.uint64(0xFF)) if depth else self.code
        code, at = np.unique(short, return_inverse=True)
        up = Level(code, np.bincount(at, self.n, len(code)))
        for k in range(8):
            first = np.flatnonzero(np.append(True, np.diff(self.node[k]) > 0)) if len(self.node[k]) else np.empty(0, np.int64)
            below = np.bincount(up.node[k][at[first]], self.log_weighted[k], len(up.log_kt[k]))
            up.set_weights(k, below)
        return up, at

    def set_weights(self, k: int, below: np.ndarray) -> None:
        """Mix decision k's own estimates with the product of the children's weighted probabilities, half and half."""
        self.log_weighted[k] = np.logaddexp(self.log_kt[k], below) - np.log(2)
        self.stop[k] = np.exp(self.log_kt[k] - np.log(2) - self.log_weighted[k])

    def mix(self, k: int, deeper: np.ndarray | None) -> np.ndarray:
        """Probability of the gram's own k-th bit given the estimates from here down."""
        a, b = (x[self.node[k]] for x in self.counts[k])
        one = ((self.code >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
        own = (np.where(one, b, a) + 0.5) / (a + b + 1)
        if deeper is None:
            return own
        w = self.stop[k][self.node[k]]
        return w * own + (1 - w) * deeper


def _levels(key: np.ndarray, n: np.ndarray, depth: int, least: int) -> tuple[list[Level], list[np.ndarray]]:
    """Levels of depth ``depth`` down to ``least`` and the gram maps between them."""
    level, levels, maps = Level(key, n), [], []
    levels.append(level)
    for d in range(depth, least, -1):
        level, at = level.above(d)
        levels.append(level)
        maps.append(at)
    return levels, maps


def _node_sums(level: Level, context: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per (context number, byte) the count, and per (context number, decision node) the sum of the
    level's log weighted probabilities; ``context`` is the number of each gram of the level."""
    byte = (level.code & np.uint64(0xFF)).astype(np.int64)
    counts = np.bincount(context << 8 | byte, level.n, contexts << 8)
    below = np.zeros(contexts << 8)
    for k in range(8):
        first = np.flatnonzero(np.append(True, np.diff(level.node[k]) > 0)) if len(level.code) else np.empty(0, np.int64)
        np.add.at(below, (context[first] << 8) + ((1 << k) | (byte[first] >> (8 - k))), level.log_weighted[k])
    return counts, below


def _tops(batches: Iterator[pa.RecordBatch], depth: int, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What the depths above need of a part, as sums by number: for each last byte (and, after those, each hot
    context of two bytes) the counts of the bytes after it, then the sums of its children's log weighted probabilities."""
    hot = int(place.max()) + 1
    for b in batches:
        for key, n in zip(*[c.to_pylist() for c in b.columns]):
            key, n = np.frombuffer(key, np.uint64), np.frombuffer(n, np.int64)
            deep = place[(key >> np.uint64(8 * (depth - 1))).astype(np.int64)] >= 0
            two = _levels(key[~deep], n[~deep], depth, 2)[0][-1]  # gram codes: (c1, c2, byte)
            sums = list(_node_sums(two, (two.code >> np.uint64(16)).astype(np.int64), 256))
            if hot:
                three = _levels(key[deep], n[deep], depth, 3)[0][-1]
                sums += _node_sums(three, place[(three.code >> np.uint64(16)).astype(np.int64)], hot)
            sums = np.concatenate(sums)
            own = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own])], names=["i", "v"])


class Middle:
    """Depth two of the hot contexts: for each (context number, decision node) weight and estimate."""

    def __init__(self, counts: np.ndarray, below: np.ndarray):
        self.one = decisions(counts)
        kt = log_kt(self.one[..., 0], self.one[..., 1])
        self.weighted = np.logaddexp(kt, below) - np.log(2)
        self.stop = np.exp(kt - np.log(2) - self.weighted)
        self.p = (self.one + 0.5) / (self.one.sum(axis=-1, keepdims=True) + 1)

    def mix(self, context: np.ndarray, node: np.ndarray, bit: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        w = self.stop[context, node]
        return w * self.p[context, node, bit] + (1 - w) * deeper


def decisions(counts: np.ndarray) -> np.ndarray:
    """(contexts, node, bit) counts of the eight decisions from (contexts, byte) counts."""
    one = np.zeros((len(counts), 256, 2))
    for k in range(8):
        for bit in (0, 1):
            one[:, (1 << k):(2 << k), bit] = counts.reshape(len(counts), 1 << k, 2, 128 >> k)[:, :, bit].sum(axis=-1)
    return one


class Top:
    """Depths zero and one: for each (last byte, decision node), weights and estimates of both depths."""

    def __init__(self, counts: np.ndarray, below: np.ndarray):
        """counts: (256, 256) of (last byte, byte); below: (256, 256) log weighted sums per (last byte, node)."""
        one = decisions(counts)
        zero = one.sum(axis=0)
        kt1, kt0 = log_kt(one[..., 0], one[..., 1]), log_kt(zero[:, 0], zero[:, 1])
        weighted1 = np.logaddexp(kt1, below) - np.log(2)
        weighted0 = np.logaddexp(kt0, weighted1.sum(axis=0)) - np.log(2)
        self.stop1, self.stop0 = np.exp(kt1 - np.log(2) - weighted1), np.exp(kt0 - np.log(2) - weighted0)
        self.p1, self.p0 = (one + 0.5) / (one.sum(axis=-1, keepdims=True) + 1), (zero + 0.5) / (zero.sum(axis=-1, keepdims=True) + 1)

    def mix(self, last: np.ndarray, node: np.ndarray, bit: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        w = self.stop1[last, node]
        deeper = w * self.p1[last, node, bit] + (1 - w) * deeper
        w = self.stop0[node]
        return w * self.p0[node, bit] + (1 - w) * deeper


def log10_grams(key: np.ndarray, n: np.ndarray, depth: int, top: Top, middle: Middle | None = None, place: np.ndarray | None = None) -> np.ndarray:
    """log10 probability of each gram's byte after its context. Grams with the same last two context bytes
    come together; those of hot contexts (with ``place`` and ``middle``) with the same last three."""
    if place is not None:
        context = place[(key >> np.uint64(8 * (depth - 1))).astype(np.int64)]
        deep = context >= 0
        out = np.zeros(len(key))
        out[~deep] = log10_grams(key[~deep], n[~deep], depth, top)
        out[deep] = _log10(key[deep], n[deep], depth, 3, top, lambda node, bit, p: middle.mix(context[deep], node, bit, p))
        return out
    return _log10(key, n, depth, 2, top, lambda node, bit, p: p)


def _log10(key: np.ndarray, n: np.ndarray, depth: int, least: int, top: Top, above) -> np.ndarray:
    levels, maps = _levels(key, n, depth, least)
    out = np.zeros(len(key))
    last = (key >> np.uint64(8 * depth)).astype(np.int64)
    byte = (key & np.uint64(0xFF)).astype(np.int64)
    path = [np.arange(len(key))]  # gram's place at each level
    for at in maps:
        path.append(at[path[-1]])
    for k in range(8):
        p = levels[0].mix(k, None)
        for level, at in zip(levels[1:], path[1:]):
            # the level's own estimates at each gram's place, mixed with the gram's deeper probability
            a, b = (x[level.node[k]][at] for x in level.counts[k])
            w = level.stop[k][level.node[k]][at]
            own = (np.where((byte >> (7 - k)) & 1, b, a) + 0.5) / (a + b + 1)
            p = w * own + (1 - w) * p
        node, bit = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1
        out += np.log10(top.mix(last, node, bit, above(node, bit, p)))
    return out


def _model(batches: Iterator[pa.RecordBatch], depth: int, top: Top, middle: Middle, place: np.ndarray, often: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, key, n in zip(*[c.to_pylist() for c in b.columns]):
            key, n = np.frombuffer(key, np.uint64), np.frombuffer(n, np.int64)
            p, head = log10_grams(key, n, depth, top, middle, place), n >= often
            cells = [x.tobytes() for x in (key[~head], p[~head], key[head], p[head])]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]],
                                             names=["part", "key", "p", "head_key", "head_p"])


def model(counts: DataFrame, depth: int, often: int, place: np.ndarray) -> DataFrame:
    """The model as one row (part, key, p, head_key, head_p) per part: packed grams, ascending, with the log10
    probability of their byte; those counted ``often`` times and more stand apart."""
    own = counts.where(f"kind = {GRAM}").select("part", "key", "n")
    grams = own.select("key", "n")
    hot = int(place.max()) + 1
    sums = np.zeros((256 + hot) << 9)
    for i, v in grams.mapInArrow(partial(_tops, depth=depth, place=place), "i long, v double").groupBy("i").agg(F.sum("v")).collect():
        sums[i] = v  # at most 2^9 rows for each last byte and each of the HOT_SHARE hot contexts
    one, two = sums[: 1 << 17].reshape(2, 256, 256), sums[1 << 17:].reshape(2, hot, 256)
    middle = Middle(two[0], two[1])
    last = np.flatnonzero(place >= 0) >> 8  # the hot contexts are children of their last byte
    np.add.at(one[0], last, two[0])
    np.add.at(one[1], last, middle.weighted)
    top = Top(one[0], one[1])
    return stage(own.mapInArrow(partial(_model, depth=depth, top=top, middle=middle, place=place, often=often),
                                "part int, key binary, p binary, head_key binary, head_p binary"), "ctw-model")


def _table(rows: DataFrame) -> Lookup:
    """Lookup over all of (key, value), rows of packed columns; what the caller selects bounds it."""
    held = [(np.frombuffer(key, np.uint64), np.frombuffer(value, np.float64)) for key, value in rows.toLocalIterator()]
    return Lookup(*(np.concatenate(x) for x in zip(*held))) if held else Lookup(np.empty(0, np.uint64), np.empty(0))


def _often(counts: DataFrame, kind: int, most: int) -> tuple[int, int, int]:
    """(sum of the counts, number of keys, the least power of two such that at most ``most`` keys are counted that often)."""
    seen = counts.where(f"kind = {kind}").agg(F.sum("total"), F.sum("distinct"),
                                              *[F.sum(F.element_at("sizes", i + 1)) for i in range(64)]).first()
    sizes, least = [int(x or 0) for x in seen[2:]], 64
    while least > 1 and sum(sizes[least - 1:]) <= most:
        least -= 1  # keys counted 2^(least - 1) times and more are at most ``most``
    return int(seen[0] or 0), int(seen[1] or 0), 1 << (least - 1)


def _sums(value: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(value)])
    return total[ends[1:]] - total[ends[:-1]]


def _planes(x: np.ndarray) -> bytes:
    """64-bit values byte by byte, all lowest bytes first: what is the same in most of them compresses away."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(planes: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(8, -1).T.copy().view(kind).ravel()


def _asked(kind: int, h: np.ndarray, doc: np.ndarray, rows: np.ndarray, parts: int, depth: int, place: np.ndarray) -> Iterator[tuple]:
    """Questions of a slice by part: (part, keys, row deltas, times); a row's keys come together, each once."""
    to = _part(kind, h, parts, depth, place).astype(np.int64)
    order = np.lexsort((h, doc, to))
    h, doc, to = h[order], doc[order], to[order]
    at = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (to[1:] != to[:-1]))) if len(h) else np.empty(0, np.int64)
    times = np.diff(np.append(at, len(h))).astype(np.int64)
    h, row, to = h[at], rows[doc[at]], to[at]
    edge = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else []
    for lo, hi in zip(edge, np.append(edge[1:], len(to))):
        yield int(to[lo]), h[lo:hi], np.diff(row[lo:hi], prepend=0), times[lo:hi]


def _score(batches: Iterator[pa.RecordBatch], depth: int, table, parts: int, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per slice, the frequent grams' part of each row's sum (kind 2: rows, sums) and the
    other grams of each row, packed by part (kind 1: grams, then row deltas and times)."""
    lookup = _restore(table)
    for b in batches:
        for part, data, ends in slices(b, size=SLICE):
            code, to = gram_codes(data, ends, depth)
            found, p = lookup.get(code)
            rows = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(rows)), np.diff(to))[~found]
            yield _batch([(int(rows[0] % parts), 2, rows.tobytes(), _sums(p, to).tobytes()),
                          *[(at, 1, _planes(h), _planes(np.concatenate([step, times])))
                            for at, h, step, times in _asked(GRAM, code[~found], doc, rows, parts, depth, place)]])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, score): partial sums of the rows. Each part's share of the model (kind 0) comes before its questions."""
    own, key, p = None, np.empty(0, np.uint64), np.empty(0)
    for b in batches:
        rows, sums = [], []
        for part, kind, k, v in zip(*[c.to_pylist() for c in b.columns]):
            if kind == 0:
                own, key, p = part, np.frombuffer(k, np.uint64), np.frombuffer(v, np.float64)
            elif kind == 2:
                rows.append(np.frombuffer(k, np.int64))
                sums.append(np.frombuffer(v, np.float64))
            else:
                code, packed = _values(k, np.uint64), _values(v, np.int64)
                at = np.searchsorted(key, code) if own == part else np.full(len(code), len(key))
                if (at == len(key)).any() or (key[at] != code).any():
                    raise ValueError(f"part {part} was asked for a gram outside the model")
                row, times = np.cumsum(packed[:len(code)]), packed[len(code):]
                edge = np.flatnonzero(np.append(True, row[1:] != row[:-1]))  # a row's grams come together
                rows.append(row[edge])
                sums.append(np.add.reduceat(times * p[at], edge))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), pa.array(np.concatenate(sums))], names=["row", "score"])


def _restore(table) -> Lookup:
    lookup = Lookup.__new__(Lookup)
    lookup.bits, lookup.key, lookup.value = table.value
    return lookup


def _base(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    """Per row: tokens, and the frequent words' part of the sum and of the known tokens."""
    lookup = _restore(table)
    for b in batches:
        for part, data, ends in slices(b, size=SLICE):
            words = Words(_LOWER[data], ends)
            found, c = lookup.get(words.word)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(words.first).astype(np.int64) + 1),
                 pa.array(_sums(np.where(found, np.log10(c + 0.5), 0.0), words.first)),
                 pa.array(np.rint(_sums(found.astype(np.float64), words.first)).astype(np.int64))],
                names=["row", "n_tokens", "head_sum", "head_known"])


def _ask(batches: Iterator[pa.RecordBatch], table, parts: int) -> Iterator[pa.RecordBatch]:
    """The other words of each row, packed by part: key (hash), n (row deltas, then times)."""
    lookup = _restore(table)
    for b in batches:
        for part, data, ends in slices(b, size=SLICE):
            words = Words(_LOWER[data], ends)
            h = words.word
            doc = np.repeat(np.arange(part.num_rows), np.diff(words.first))
            rare = ~lookup.get(h)[0]
            rows = part.column(0).to_numpy(zero_copy_only=False)
            yield _batch([(to, 1, key.tobytes(), np.concatenate([step, times]).tobytes())
                          for to, key, step, times in _asked(WORD, h[rare], doc[rare], rows, parts, 1, np.empty(0))])


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settle the questions of each part against its counts; one row per document asked here."""
    counts: dict[int, tuple] = {}
    asked: dict[int, list] = {}
    for b in batches:
        for part, kind, key, n in zip(*[c.to_pylist() for c in b.columns]):
            pair = np.frombuffer(key, np.uint64), np.frombuffer(n, np.int64)
            if kind == 0:
                counts[part] = pair
            else:
                asked.setdefault(part, []).append(pair)
    rows, sums, known = [], [], []
    while asked:
        part, blobs = asked.popitem()
        key, n = counts.pop(part, (np.empty(0, np.uint64), np.empty(0, np.int64)))
        for h, packed in blobs:
            row, times = np.cumsum(packed[:len(h)]), packed[len(h):]
            at = np.minimum(np.searchsorted(key, h), max(len(key) - 1, 0))
            c = np.where(key[at] == h, n[at], 0) if len(key) else np.zeros(len(h), np.int64)
            edge = np.flatnonzero(np.append(True, row[1:] != row[:-1]))  # a row's words come together
            rows.append(row[edge])
            sums.append(np.add.reduceat(times * np.log10(c + 0.5), edge))
            known.append(np.add.reduceat(times * (c > 0), edge))
    if rows:
        row, at = np.unique(np.concatenate(rows), return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array(np.bincount(at, np.concatenate(sums), len(row))),
             pa.array(np.rint(np.bincount(at, np.concatenate(known), len(row))).astype(np.int64))], names=["row", "s", "k"])


def _ship(df: DataFrame, lookup: Lookup):
    return df.sparkSession.sparkContext.broadcast((lookup.bits, lookup.key, lookup.value))


def score_texts(docs: DataFrame, depth: int = 5, shard: int = SHARD, head: int = HEAD, hot_share: int = HOT_SHARE,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    Learns from the rows whose crc32(doc_id as text) mod 5 is not 1. ``score``
    is the log10 probability of the whole text's bytes and its end under the
    context-tree weighting of ``depth`` bytes of context. ``base_score`` is
    that of the tokens (ASCII-lower-cased words and one end) under smoothed
    word counts. Very long texts are taken whole. Null and empty texts have one token, the end. Repeated rows
    are learned and scored each; a null doc_id is learned from. An empty
    table gives an empty result; other columns are not read.

    Besides tables in the shared folder, the driver and the tasks get the
    counts of at most ``head`` words and the log-probabilities of at most
    ``shard`` grams, the most frequent ones. The other words and grams are
    settled where they are counted.
    """
    if depth < 2 or depth > 6:
        raise ValueError("2 <= depth <= 6")
    base = keyed(docs, id_col, text_col)
    tasks, place = tasks_for(base), hot_contexts(base, depth, hot_share)
    parts = parts_for(tasks)
    counts = gather(base, depth, tasks, place)
    words = counts.where(f"kind = {WORD}")
    total, distinct, often = _often(counts, WORD, head)
    ends = base.where(learned()).count()
    n, v = total + ends, distinct + (ends > 0)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, c in zip(*[x.to_pylist() for x in b.columns]):
                key, c = np.frombuffer(key, np.uint64), np.frombuffer(c, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([key[c >= often].tobytes()], pa.binary()), pa.array([c[c >= often].astype(np.float64).tobytes()], pa.binary())],
                                                 names=["key", "n"])

    known = _ship(base, _table(words.select("key", "n").mapInArrow(frequent, "key binary, n binary")))
    narrow = base.select("row", "doc_id", "text")
    asked = narrow.mapInArrow(partial(_ask, table=known, parts=parts), COUNT_SCHEMA)
    told = (words.select("part", F.lit(0).alias("kind"), "key", "n").unionByName(asked).repartition(tasks, "part")
            .mapInArrow(_tell, "row long, s double, k long").groupBy("row").agg(F.sum("s").alias("s"), F.sum("k").alias("k")))
    basic = narrow.mapInArrow(partial(_base, table=known), "row long, n_tokens long, head_sum double, head_known long")
    grams = model(counts, depth, _often(counts, GRAM, shard)[2], place)
    likely = _ship(base, _table(grams.select("head_key", "head_p")))
    sent = narrow.mapInArrow(partial(_score, depth=depth, table=likely, parts=parts, place=place), COUNT_SCHEMA)
    scored = (grams.select("part", F.lit(0).alias("kind"), "key", F.col("p").alias("n")).unionByName(sent).repartition(tasks, "part")
              .sortWithinPartitions("part", "kind").mapInArrow(_settle, "row long, score double")
              .groupBy("row").agg(F.sum("score").alias("score")))
    end = float(np.log10(ends + 0.5))
    share = float(np.log10(n + 0.5 * (v + 1)))
    return (base.select("row", "doc_id").join(basic, "row").join(told, "row", "left").join(scored, "row")
            .select("doc_id", (~learned()).alias("held_out"), "n_tokens",
                    (F.col("head_known") + F.coalesce("k", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
                    F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("head_sum") + F.coalesce("s", F.lit(0.0)) + F.lit(end) - F.col("n_tokens") * F.lit(share)).alias("base_score"),
                    "score"))
