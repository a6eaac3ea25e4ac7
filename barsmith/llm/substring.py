"""Substring dedup on words with difference-cover anchors.

A window is ``window`` consecutive words. Modulo a period ``v``, a difference
cover D has for any two positions a common shift below ``v`` that takes both
into D. So of any two equal windows, some equal stretch of
``window - v + 1`` words starts at a cover position in both: only stretches
at cover positions are hashed and exchanged. Where one repeats, the windows
around it that contain it are the only ones that can repeat; they are hashed
whole and exchanged to settle which do.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import ASK_SCHEMA, PrimeRolling, answers, ask, keyed, mixed, parts_for, slices, tasks_for, word_hash

#: Perfect difference sets: period -> cover. Each nonzero residue is a difference exactly once.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}

#: Bytes of an anchor's hash that are exchanged, within its part; anchors only choose candidates.
ANCHOR_BYTES = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def period_for(window: int) -> int:
    """The longest period that leaves anchors of at least a third of the window."""
    return max([p for p in COVERS if 3 * (window - p + 1) >= window] or [1])


class Words:
    """Words of the texts in a slice: byte ranges, first word of each text, hashes of words and of stretches of them.

    ``word`` are 64-bit hashes of the words' bytes. A stretch has two hashes
    of 62 and 31 bits, polynomials modulo a prime over two independent word
    hashes (93 bits in all).
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, hashed: bool = True):
        word = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[ends] = True  # a text's end parts words even without white space
        start = word & (np.concatenate([[True], ~word[:-1]]) | edge[:-1]) if len(data) else word
        end = word & (np.concatenate([~word[1:], [True]]) | edge[1:]) if len(data) else word
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, ends)  # words before each text; the last entry is their number
        self.word = word_hash(data, self.start, self.end, 1) if hashed else None
        self._data, self._rolling = data, None

    def hash(self, at: np.ndarray, n: int, which: int = 0) -> np.ndarray:
        if self._rolling is None:
            other = word_hash(self._data, self.start, self.end, 2)
            self._rolling = [PrimeRolling(x, i) for i, x in enumerate((self.word, other, other))]
        a, b, c = self._rolling
        if which:
            return mixed(c.hash(at, at + n) << np.uint64(33))
        return mixed(a.hash(at, at + n) << np.uint64(31) | b.hash(at, at + n))


def _anchors(batches: Iterator[pa.RecordBatch], window: int, period: int, parts: int) -> Iterator[pa.RecordBatch]:
    length = window - period + 1
    cover = np.isin(np.arange(period), COVERS.get(period, (0,)))
    for b in batches:
        for part, data, ends in slices(b):
            words = Words(data, ends)
            n = np.diff(words.first)
            doc = np.repeat(np.arange(len(n)), n)
            pos = np.arange(len(doc)) - words.first[doc]
            at = np.flatnonzero(cover[pos % period] & (pos + length <= n[doc]) & (n[doc] >= window))
            row = part.column(0).to_numpy(zero_copy_only=False)[doc[at]]
            yield ask(words.hash(at, length), np.zeros(len(at), np.int32), row, pos[at], False, parts, ANCHOR_BYTES)


def covered(length: int, positions: np.ndarray, before: int, after: int) -> np.ndarray:
    """Flags of the places in ``[p - before, p + after)`` of some position p."""
    step = np.zeros(length + 1, np.int64)
    np.add.at(step, np.clip(positions - before, 0, length), 1)
    np.add.at(step, np.clip(positions + after, 0, length), -1)
    return np.cumsum(step[:-1]) > 0


def _found(part: pa.RecordBatch, first: np.ndarray) -> np.ndarray:
    """The positions found per row as positions in the slice."""
    found = part.column(part.num_columns - 1)
    n = found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(first[:-1], n) + found.flatten().to_numpy(zero_copy_only=False)


def _windows(batches: Iterator[pa.RecordBatch], window: int, parts: int, period: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, data, ends in slices(b.filter(b.column(b.num_columns - 1).is_valid())):
            words = Words(data, ends)
            n = np.diff(words.first)
            doc = np.repeat(np.arange(len(n)), n)
            pos = np.arange(len(doc)) - words.first[doc]
            near = covered(len(doc), _found(part, words.first), period - 1, 1)
            at = np.flatnonzero(near & (pos + window <= n[doc]))
            row = part.column(0).to_numpy(zero_copy_only=False)[doc[at]]
            g = (words.hash(at, window, 1) >> np.uint64(33)).astype(np.int32)
            yield ask(words.hash(at, window), g, row, pos[at], False, parts)


def _cut(batches: Iterator[pa.RecordBatch], window: int, carried: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, data, ends in slices(b):
            words = Words(data, ends, False)
            gone = covered(len(words.start), _found(part, words.first), 0, window)
            raw = data.tobytes()
            n_words = np.diff(words.first)
            total = np.concatenate([[0], np.cumsum(gone)])
            n_gone = total[words.first[1:]] - total[words.first[:-1]]
            kept, text = [], []
            for i in range(part.num_rows):
                lo, hi = words.first[i], words.first[i + 1]
                own = np.flatnonzero(~gone[lo:hi]) + lo
                kept.append(b" ".join([raw[s:e] for s, e in zip(words.start[own].tolist(), words.end[own].tolist())])
                            if n_gone[i] else b" ".join(raw[ends[i]:ends[i + 1]].split()))
                text.append(_without(raw, ends[i], ends[i + 1], words, lo, hi, gone) if n_gone[i] else raw[ends[i]:ends[i + 1]])
            yield pa.RecordBatch.from_arrays(
                [part.column(1), pa.array(n_words.astype(np.int64)), pa.array(n_gone.astype(np.int64)),
                 pa.array(kept, pa.binary()).cast(pa.string()), pa.array(text, pa.binary()).cast(pa.string()),
                 *[part.column(3 + i) for i in range(carried)]],
                names=["doc_id", "n_words", "n_removed", "kept", "text", *[f"c_{i}" for i in range(carried)]])


def _without(raw: bytes, start: int, end: int, words: Words, lo: int, hi: int, gone: np.ndarray) -> bytes:
    """A text without its removed words and the white space after each of them."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[lo:hi], [False]])))
    out, at = [], start
    for a, b in edge.reshape(-1, 2) + lo:
        out.append(raw[at:words.start[a]])
        at = words.start[b] if b < hi else end
    return b"".join([*out, raw[at:end]])


def remove_repeats(docs: DataFrame, window: int = 35, period: int | None = None, id_col: str = "doc_id",
                   text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove every word covered by a window of words that also starts anywhere else.

    Returns, per row of ``docs``: doc_id, n_words, n_removed, ``kept`` (the
    kept words joined by one space), ``text`` (the text without the removed
    words, else as it was) and the columns named in ``carry``.

    Words are runs of characters other than ASCII white space. All
    occurrences go, those in the same document included; windows are judged
    on the input; very long texts are taken whole. Null and empty texts have no words and keep empty texts.
    Repeated rows are documents of their own, so their windows repeat; null
    doc_ids are kept as null. An empty table gives an empty result.
    """
    period = period or period_for(window)
    base = keyed(docs, id_col, text_col, tuple(carry))
    kinds = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    narrow = base.select("row", "doc_id", "text")
    tasks = tasks_for(narrow)
    parts = parts_for(tasks)
    dealt = base.repartition(tasks, "row")
    anchors = answers(narrow.mapInArrow(partial(_anchors, window=window, period=period, parts=parts), ASK_SCHEMA),
                      tasks, two_rows=False, width=ANCHOR_BYTES)
    candidates = dealt.join(anchors, "row", "left")
    repeats = answers(candidates.mapInArrow(partial(_windows, window=window, period=period, parts=parts), ASK_SCHEMA),
                      tasks, two_rows=False)
    cut = dealt.join(repeats, "row", "left").mapInArrow(
        partial(_cut, window=window, carried=len(carry)),
        "doc_id long, n_words long, n_removed long, kept string, text string"
        + "".join(f", c_{i} {kinds[f'c_{i}']}" for i in range(len(carry))))
    return cut.select("doc_id", "n_words", "n_removed", "kept", "text", *[F.col(f"c_{i}").alias(c) for i, c in enumerate(carry)])
