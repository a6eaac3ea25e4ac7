"""Substring dedup on bytes by a distributed merge sort of suffixes.

Not every suffix can matter: any two equal stretches of ``length`` bytes
share the position of their smallest gram hash, so only suffixes that start
at such anchors are sorted, and of these only the ones whose gram occurs in
another document. Each task sorts its suffixes (with the bytes to their left
that a stretch may reach) into runs, one per part of the gram space, and
front-codes them: a suffix is stored as the length of the prefix it shares
with the one before and the rest. Each part's runs are merged by a loser
tree that keeps, for every head, the length of the prefix it shares with the
last suffix put out, and compares only what lies beyond. The merged order
with its common prefix lengths then shows which stretches start in an
earlier document: equal to the right of the anchor are neighbours whose
common prefix is long enough, equal to the left the same bytes before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import ASK_SCHEMA, Rolling, answers, ask, gathered, keyed, lists, mixed, slices, tasks_for

#: Bytes of the gram whose smallest hash marks an anchor.
GRAM = 16
#: Bytes of an anchor's hash that are exchanged, within its part; anchors only choose candidates.
ANCHOR_BYTES = 5
#: Suffixes that a task sorts into runs together.
RUN = 300_000
#: Anchors whose stretches are looked at together.
STEP = 50_000

RUN_SCHEMA = ("part int, n int, shared binary, right binary, rest binary, left binary, before binary, "
              "ord binary, row binary, pos binary")
_FIELDS = RUN_SCHEMA.replace(" int", "").replace(" binary", "").split(", ")


def _slide(x: np.ndarray, n: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every n consecutive entries, by doubling."""
    have = 1
    while 2 * have <= n:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[: len(x) - (n - have)], x[n - have:]) if n > have else x


def gram_hashes(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the gram at each byte, smallest gram hash of the stretch that starts at each byte; 0: none inside its text)."""
    n = len(data)
    if n < length:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    at = np.arange(n - gram + 1)
    h = Rolling(data.astype(np.uint64) + np.uint64(1)).hash(at, at + gram)
    least = _slide(h, length - gram + 1, np.minimum)
    valid = np.zeros(n + 1, np.int64)  # starts of stretches that stay inside their text
    long = np.flatnonzero(np.diff(ends) >= length)
    np.add.at(valid, ends[long], 1)
    np.add.at(valid, ends[long + 1] - length + 1, -1)
    return h, np.where(np.cumsum(valid)[: len(least)] > 0, least, np.uint64(0))


def anchor_positions(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) of all anchors: smallest gram hash of some stretch inside one text."""
    h, least = gram_hashes(data, ends, length, gram)
    if not len(h):
        return np.empty(0, np.int64), h
    edge = np.zeros(length - gram, np.uint64)
    anchor = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), length - gram + 1, np.maximum) == h)
    return anchor, h[anchor]


def anchored(h: np.ndarray, least: np.ndarray, at: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) start of the stretches whose smallest gram hash is the one at each anchor; they are consecutive."""
    start = at[:, None] - np.arange(reach, -1, -1)
    inside = (start >= 0) & (start < len(least))
    own = inside & (least[np.where(inside, start, 0)] == h[at, None])
    return at - reach + own.argmax(axis=1), at - own[:, ::-1].argmax(axis=1)


def _anchors(batches: Iterator[pa.RecordBatch], length: int, gram: int, parts: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, data, ends in slices(b):
            at, h = anchor_positions(data, ends, length, gram)
            doc = np.searchsorted(ends, at, "right") - 1
            row = part.column(0).to_numpy(zero_copy_only=False)[doc]
            yield ask(h, np.zeros(len(at), np.int32), row, at - ends[doc], True, parts, ANCHOR_BYTES)


def _words(m: np.ndarray) -> list[np.ndarray]:
    """Columns of a byte matrix as big-endian 8-byte words, most significant first."""
    pad = np.zeros((len(m), -m.shape[1] % 8), np.uint8)
    wide = np.ascontiguousarray(np.concatenate([m, pad], axis=1)).view(">u8").astype(np.uint64)
    return [wide[:, i] for i in range(wide.shape[1])]


class Suffixes:
    """Candidate suffixes with the bytes before them, as padded matrices.

    ``right``: up to ``length`` bytes from the anchor; ``left``: up to
    ``length - gram`` bytes before it, nearest first. ``n_right`` and
    ``n_left`` are the bytes that belong to stretches with this anchor.
    """

    def __init__(self, right, n_right, left, n_left, order, row, pos):
        self.right, self.n_right, self.left, self.n_left = right, n_right, left, n_left
        self.order, self.row, self.pos = order, row, pos

    def take(self, at: np.ndarray) -> Suffixes:
        return Suffixes(*[x[at] for x in self._columns()])

    def _columns(self):
        return self.right, self.n_right, self.left, self.n_left, self.order, self.row, self.pos

    @staticmethod
    def join(parts: list[Suffixes]) -> Suffixes:
        return Suffixes(*[np.concatenate(c) for c in zip(*[p._columns() for p in parts])])

    @staticmethod
    def read(data: np.ndarray, ends: np.ndarray, at: np.ndarray, doc: np.ndarray, order, row, length: int, gram: int,
             first: np.ndarray, last: np.ndarray) -> Suffixes:
        reach = length - gram
        n_right, n_left = last + length - at, at - first
        wide = np.concatenate([np.zeros(reach, np.uint8), data, np.zeros(length, np.uint8)])
        right = wide[(at + reach)[:, None] + np.arange(length)]
        left = wide[(at + reach - 1)[:, None] - np.arange(reach)]
        right[np.arange(length) >= n_right[:, None]] = 0
        left[np.arange(reach) >= n_left[:, None]] = 0
        return Suffixes(right, n_right, left, n_left, order[doc], row[doc], at - ends[doc])


def _shared(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Common prefix length of matrix rows, at most ``most``."""
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(first, most)


def make_runs(s: Suffixes, parts: int, gram: int) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """Front-coded sorted runs, one per part; and the (row, start, end) that are settled here.

    Of suffixes equal with all the bytes around them, those of the earliest
    document here go on; the others repeat it and are removed in full.
    """
    keys, left = [*_words(s.right), s.n_right], [*_words(s.left), s.n_left]
    order = np.lexsort((s.row, s.order, *left[::-1], *keys[::-1]))
    s = s.take(order)
    new = np.ones(len(s.row), bool)
    if len(new):
        same = np.ones(len(new) - 1, bool)
        for k in (*keys, *left):
            k = k[order]
            same &= k[1:] == k[:-1]
        new[1:] = ~same
    first = s.order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(new) else s.order
    later = np.flatnonzero(s.order > first)
    start = s.pos[later] - s.n_left[later]
    settled = s.row[later], start, s.pos[later] + s.n_right[later]
    s = s.take(np.flatnonzero(s.order == first))
    h = mixed(_words(s.right[:, :gram])[0] ^ (mixed(_words(s.right[:, :gram])[-1]) >> np.uint64(1)))
    part = ((h >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    s, part = s.take(order), part[order]
    edge = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, np.int64)
    shared = np.zeros(len(part), np.int64)
    shared[1:] = _shared(s.right[1:], s.right[:-1], np.minimum(s.n_right[1:], s.n_right[:-1]))
    shared[edge] = 0
    column = np.arange(s.right.shape[1])
    runs = []
    for lo, hi in zip(edge, np.append(edge[1:], len(part))):
        own = slice(lo, hi)
        rest = s.right[own][(column >= shared[own, None]) & (column < s.n_right[own, None])]
        before = s.left[own][np.arange(s.left.shape[1]) < s.n_left[own, None]]
        runs.append((int(part[lo]), int(hi - lo), *[x[own].astype(np.uint8).tobytes() for x in (shared, s.n_right)], rest.tobytes(),
                     s.n_left[own].astype(np.uint8).tobytes(), before.tobytes(), s.order[own].astype(np.int64).tobytes(),
                     s.row[own].astype(np.int64).tobytes(), s.pos[own].astype(np.int32).tobytes()))
    return runs, *settled


def pack(part: int, n: int, *cells: bytes) -> tuple:
    """A run as it travels: its columns compressed; the row, mostly the same, as the difference to the order."""
    *some, order, row, pos = cells
    apart = np.frombuffer(row, np.int64) - np.frombuffer(order, np.int64)
    return part, n, *[zstandard.compress(c) for c in (*some, order, apart.tobytes(), pos)]


def unpack(cells: list[bytes]) -> list[bytes]:
    *some, order, apart, pos = [zstandard.decompress(c) for c in cells]
    return [*some, order, (np.frombuffer(order, np.int64) + np.frombuffer(apart, np.int64)).tobytes(), pos]


class Run:
    """A front-coded run, read one suffix at a time."""

    def __init__(self, n: int, shared: bytes, right: bytes, rest: bytes, left: bytes, before: bytes, order: bytes, row: bytes, pos: bytes):
        self.n, self.shared, self.n_right, self.rest = n, shared, right, rest
        self.n_left, self.before = np.frombuffer(left, np.uint8).astype(np.int64), np.frombuffer(before, np.uint8)
        self.order, self.row, self.pos = np.frombuffer(order, np.int64), np.frombuffer(row, np.int64), np.frombuffer(pos, np.int32)

    def suffixes(self) -> Iterator[tuple[bytes, int]]:
        at, now, rest = 0, b"", self.rest
        for k, n in zip(self.shared, self.n_right):
            now = now[:k] + rest[at:at + n - k]
            at += n - k
            yield now, k

    def left(self, reach: int) -> np.ndarray:
        out = np.zeros((self.n, reach), np.uint8)
        out[np.arange(reach) < self.n_left[:, None]] = self.before
        return out


def merge(runs: list[Run]) -> Iterator[tuple[int, bytes, int]]:
    """(run, suffix, shared) in sorted order by a loser tree; ``shared``: common prefix with the suffix before.

    ``known[r]`` is the prefix that run r's head shares with the last suffix
    put out. Of two heads the one that shares more is the smaller, without
    comparing; of equals, comparing starts behind the known prefix.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[Iterator | None] = [r.suffixes() for r in runs] + [None] * (size - len(runs))
    head: list[bytes | None] = [None] * size
    known = [0] * size
    for r, it in enumerate(heads):
        if it is not None:
            head[r] = next(it, (None, 0))[0]

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes the one it shares with the winner."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        i, j = known[a], known[b]
        if i != j:
            return (a, b) if i > j else (b, a)
        most = min(len(x), len(y))
        while i < most and x[i] == y[i]:
            i += 1
        if i < most:
            first = x[i] < y[i]
        else:
            first = (len(x), a) < (len(y), b)
        if first:
            known[b] = i
            return a, b
        known[a] = i
        return b, a

    loser = [0] * size
    winner = list(range(size))
    while len(winner) > 1:
        level = []
        for k in range(0, len(winner), 2):
            w, lost = play(winner[k], winner[k + 1])
            loser[len(winner) // 2 + k // 2] = lost
            level.append(w)
        winner = level
    best = winner[0]
    while head[best] is not None:
        yield best, head[best], known[best]
        head[best], known[best] = next(heads[best], (None, 0))
        node = (best + size) // 2
        while node:
            best, loser[node] = play(loser[node], best)
            node //= 2


#: Base of the hash that sorts the strings left of an anchor; equal hashes are compared byte by byte.
_LEFT_BASE = np.array(0x9E3779B97F4A7C15, np.uint64)


def earlier(right_shared: np.ndarray, n_right: np.ndarray, left: np.ndarray, n_left: np.ndarray, order: np.ndarray,
            length: int, gram: int) -> np.ndarray:
    """Flags (suffix, r): the stretch that starts r bytes before the anchor starts in an earlier document too.

    Suffixes come in sorted order; ``right_shared[i]`` is the prefix that i
    shares with i - 1.
    """
    n, reach = len(order), length - gram
    out = np.zeros((n, reach + 1), bool)
    reversed_hash = np.zeros(n, np.uint64)
    power = np.uint64(1)
    for r in range(reach + 1):
        if r:
            reversed_hash = reversed_hash + (left[:, r - 1].astype(np.uint64) + np.uint64(1)) * power
            power = power * _LEFT_BASE
        own = np.flatnonzero((n_left >= r) & (n_right >= length - r))
        if not len(own):
            continue
        # neighbours in sorted order with a common prefix of length - r bytes are one class
        group = np.cumsum(right_shared < length - r)[own]
        by = np.lexsort((order[own], mixed(reversed_hash[own]), group))
        own, group, h = own[by], group[by], reversed_hash[own[by]]
        new = np.ones(len(own), bool)
        new[1:] = (group[1:] != group[:-1]) | (h[1:] != h[:-1])
        first = own[np.flatnonzero(new)][np.cumsum(new) - 1]
        hit = np.flatnonzero(order[own] > order[first])
        exact = (left[own[hit], :r] == left[first[hit], :r]).all(axis=1)
        out[own[hit[exact]], r] = True
        if not exact.all():  # different strings under one hash: compare them all by their bytes
            odd = np.flatnonzero(np.isin(np.cumsum(new), np.cumsum(new)[hit[~exact]]))
            least: dict[tuple, int] = {}
            named = [(int(g), left[i, :r].tobytes(), i) for g, i in zip(group[odd], own[odd])]
            for g, s, i in named:
                least[g, s] = min(least.get((g, s), order[i]), order[i])
            for g, s, i in named:
                out[i, r] |= order[i] > least[g, s]
    return out


def _merged(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Runs sorted by part -> spans that repeat; one part is held at a time."""
    reach = length - gram

    def settle(own: list[Run]) -> pa.RecordBatch:
        which, shared, n_right = [], [], []
        for r, suffix, k in merge(own):
            which.append(r)
            shared.append(k)
            n_right.append(len(suffix))
        at = np.empty(len(which), np.int64)  # a run's suffixes come in its own order
        at[np.argsort(np.array(which), kind="stable")] = np.arange(len(which))
        left = np.concatenate([r.left(reach) for r in own])[at]
        n_left, order, row, pos = (np.concatenate([getattr(r, f) for r in own])[at] for f in ("n_left", "order", "row", "pos"))
        hit = earlier(np.array(shared), np.array(n_right), left, n_left, order, length, gram)
        edge = np.diff(np.concatenate([np.zeros((len(hit), 1), np.int8), hit.astype(np.int8), np.zeros((len(hit), 1), np.int8)], axis=1), axis=1)
        i, lo = np.nonzero(edge == 1)
        _, hi = np.nonzero(edge == -1)
        return _spans(row[i], pos[i] - (hi - 1), pos[i] - lo + length)

    now, own = None, []
    for b in batches:
        for part, n, *cells in zip(*[c.to_pylist() for c in b.columns]):
            if part != now and own:
                yield settle(own)
                own = []
            now, cells = part, unpack(cells)
            if part < 0:  # settled where the run was made: row, start, end
                yield _spans(np.frombuffer(cells[6], np.int64), np.frombuffer(cells[5], np.int64), np.frombuffer(cells[7], np.int32))
            else:
                own.append(Run(n, *cells))
    if own:
        yield settle(own)


def _spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """(row, found): overlapping spans of a row joined; a span is start * 2^32 + end."""
    by = np.lexsort((start, row))
    row, start, end = row[by].astype(np.int64), start[by].astype(np.int64), end[by].astype(np.int64)
    if len(row):
        new_row = np.append(True, row[1:] != row[:-1])
        base = (np.cumsum(new_row) - 1) << np.int64(33)  # keeps rows apart in the running maximum
        upto = np.maximum.accumulate(end + base)
        new = np.append(True, (start + base)[1:] > upto[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(row)) - 1
        row, start, end = row[at], start[at], (upto - base)[last]
    return lists(row, start << np.int64(32) | end, "found")


def _runs(batches: Iterator[pa.RecordBatch], length: int, gram: int, parts: int) -> Iterator[pa.RecordBatch]:
    waiting: list[Suffixes] = []

    def flush() -> pa.RecordBatch:
        runs, row, start, end = make_runs(Suffixes.join(waiting), parts, gram)
        waiting.clear()
        for k in range(0, len(row), 1 << 12):
            own = slice(k, k + (1 << 12))
            runs.append((-1 - int(row[k]) % parts, 0, b"", b"", b"", b"", b"", start[own].astype(np.int64).tobytes(),
                         row[own].astype(np.int64).tobytes(), end[own].astype(np.int32).tobytes()))
        columns = list(zip(*[pack(*r) for r in runs])) or [[]] * len(_FIELDS)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i < 2 else pa.binary()) for i, c in enumerate(columns)], names=_FIELDS)

    for b in batches:
        for part, data, ends in slices(b.filter(b.column(b.num_columns - 1).is_valid())):
            found = part.column(part.num_columns - 1)
            n = found.value_lengths().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(n)), n)
            at = ends[doc] + found.flatten().to_numpy(zero_copy_only=False)
            row = part.column(0).to_numpy(zero_copy_only=False)
            order = part.column(1).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            h, least = gram_hashes(data, ends, length, gram)
            for k in range(0, len(at), STEP):
                some = at[k:k + STEP]
                waiting.append(Suffixes.read(data, ends, some, doc[k:k + STEP], order, row, length, gram,
                                             *anchored(h, least, some, length - gram)))
                if sum(len(w.row) for w in waiting) >= RUN // 2:
                    yield flush()
    if waiting:
        yield flush()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, data, ends in slices(b):
            found = part.column(part.num_columns - 1)
            n = found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(n)), n)
            span = found.flatten().to_numpy(zero_copy_only=False)
            step = np.zeros(len(data) + 1, np.int64)
            np.add.at(step, ends[doc] + (span >> np.int64(32)), 1)
            np.add.at(step, ends[doc] + (span & np.int64(0xFFFFFFFF)), -1)
            gone = np.cumsum(step[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            opens = gone & ~np.concatenate([[False], gone[:-1]])
            opens[ends[:-1][ends[:-1] < len(data)]] |= gone[ends[:-1][ends[:-1] < len(data)]]  # a run ends with its text
            runs = np.concatenate([[0], np.cumsum(opens)])
            kept = [data[s:e][~gone[s:e]].tobytes() if total[e] > total[s] else data[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column(1), pa.array(np.diff(ends)), pa.array(np.diff(total[ends])), pa.array(np.diff(runs[ends])),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_earlier(docs: DataFrame, length: int = 50, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts in a document with a smaller doc_id.

    Returns, per row of ``docs``: doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs) and ``kept`` (binary: the remaining bytes).
    Strings are judged on the input; they never cross documents, and overlaps
    count. ``length`` is at most 255. Very long texts are taken whole. Null and empty texts have no bytes. Rows
    that share a doc_id are no earlier than one another; a null doc_id comes
    after all others. An empty table gives an empty result; other columns
    are not read.
    """
    if not 8 <= gram < length <= 255:
        raise ValueError("8 <= gram < length <= 255")
    base = keyed(docs, id_col, text_col)
    tasks = parts = tasks_for(base)  # no more parts than tasks: front coding wants long runs
    dealt = base.repartition(tasks, "row")
    anchors = answers(base.mapInArrow(partial(_anchors, length=length, gram=gram, parts=parts), ASK_SCHEMA),
                      tasks, two_rows=True, width=ANCHOR_BYTES)
    runs = dealt.join(anchors, "row", "left").mapInArrow(partial(_runs, length=length, gram=gram, parts=parts), RUN_SCHEMA)
    spans = gathered(runs.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(
        partial(_merged, length=length, gram=gram), "row long, found array<long>"), tasks, "found")
    return dealt.join(spans, "row", "left").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
