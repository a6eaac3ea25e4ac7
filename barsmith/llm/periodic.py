"""Periodic runs of words, by a dictionary of basic factors.

The factors are the stretches of 1, 2, 4, ... words; equal ones of a document
get equal names, the names of one length from the pairs of names of half of
it. For each length L the occurrences of a factor within twice L form
arithmetic progressions: where three follow each other at the same distance p,
at most L and more than half of it, p is a period there. Such places next to
each other with the same p are one run, which starts with the first of them
and ends 2p + L words after the last.

Why that is exact for runs of four periods and more: in a run of smallest
period q, with L the power of two in [q, 2q), each factor of L words occurs
next just q words on (an earlier one would give a smaller period), and
2q + L <= 4q words hold three of them; one word before the run's start, or
after its end, the factors differ. Each run has one L, so none is found twice.

A factor that occurs less than three times in its document is in no
progression, nor is any longer one that holds it; its place is left out of
the longer lengths, so ordinary prose ends after a few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words, and bytes, of the documents that a task looks at together (at least one document).
BLOCK_WORDS, BLOCK_BYTES = 1 << 20, 8 << 20


def find_runs(words: np.ndarray, sizes: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all maximal runs of at least ``min_length`` words and ``min_exponent`` periods.

    ``words`` are the word numbers of documents one after the other, ``sizes``
    their lengths; no run crosses documents. Sorted by start, then period.
    """
    if min_exponent < 4:
        raise ValueError("min_exponent >= 4")
    n = len(words)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    pos = np.arange(n)
    key = doc * (int(words.max(initial=0)) + 1) + words
    span, found = 1, [np.empty((0, 3), np.int64)]
    while len(pos):
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        name = np.cumsum(np.concatenate([[False], sorted_key[1:] != sorted_key[:-1]]))
        often = np.bincount(name)[name] >= 3
        at, name = pos[order[often]], name[often]
        if not len(at):
            break
        near = np.flatnonzero((name[1:] == name[:-1]) & (at[1:] - at[:-1] <= span))
        step = np.zeros(n, np.int64)
        step[at[near]] = at[near + 1] - at[near]
        own = np.flatnonzero(step > span // 2)
        own = own[step[own + step[own]] == step[own]]
        if len(own):
            p = step[own]
            opens = np.concatenate([[True], (own[1:] != own[:-1] + 1) | (p[1:] != p[:-1])])
            first = np.flatnonzero(opens)
            last = np.append(first[1:], len(own)) - 1
            found.append(np.stack([own[first], own[last] + 2 * p[last] + span - own[first], p[first]], axis=1))
        names = np.full(n + span, -1, np.int64)
        names[at] = name
        pos = np.sort(at)
        right = names[pos + span]
        pos, right = pos[right >= 0], right[right >= 0]
        same = doc[pos] == doc[pos + span]
        pos, right = pos[same], right[same]
        key = names[pos] * (int(name[-1]) + 1) + right
        span *= 2
    runs = np.concatenate(found)
    runs = runs[(runs[:, 1] >= min_length) & (runs[:, 1] >= min_exponent * runs[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs[:, 0], runs[:, 1], runs[:, 2]


def _block(ids: list[int | None], texts: list[list[bytes]], min_length: int, min_exponent: int) -> pa.RecordBatch:
    sizes = np.array([len(t) for t in texts], np.int64)
    known: dict[bytes, int] = {}
    number = known.setdefault
    words = np.fromiter((number(w, len(known)) for t in texts for w in t), np.int64, int(sizes.sum()))
    start, length, period = find_runs(words, sizes, min_length, min_exponent)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    cut = np.searchsorted(start, np.append(begins, ends[-1:]))
    over = np.zeros(len(words) + 1, np.int64)
    np.add.at(over, start + period, 1)
    np.add.at(over, start + length, -1)
    kept = np.cumsum(over[:-1]) == 0
    collapsed = []
    for i, t in enumerate(texts):
        if cut[i] < cut[i + 1]:
            t = [t[k] for k in np.flatnonzero(kept[begins[i]:ends[i]])]
        collapsed.append(b" ".join(t))
    of = np.repeat(begins, np.diff(cut))
    runs = pa.StructArray.from_arrays([pa.array(start - of), pa.array(length), pa.array(period)], names=["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), runs),
         pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed) per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch
    with smallest period ``period``, at least ``min_length`` words and
    ``min_exponent`` (4 or more) periods long, that no neighbouring word
    extends. ``runs`` is sorted by start, then period; ``collapsed`` joins by
    one space the words that no run contains after its first ``period`` words.

    A null or blank text has no words, no runs and an empty ``collapsed``.
    Null or repeated doc_ids and repeated rows pass through one by one; other
    columns are not read, whatever their names. Very long texts are taken
    whole: a task needs memory for one text. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[list[bytes]] = []
        words = size = 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                ids.append(i)
                texts.append(raw.split())
                words, size = words + len(texts[-1]), size + len(raw)
                if words >= BLOCK_WORDS or size >= BLOCK_BYTES or len(ids) >= BLOCK_WORDS // 4:
                    yield _block(ids, texts, min_length, min_exponent)
                    ids, texts, words, size = [], [], 0, 0
        if ids:
            yield _block(ids, texts, min_length, min_exponent)

    if min_exponent < 4:
        raise ValueError("min_exponent >= 4")
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) where one text in ten, by the CRC-32 of its doc_id, goes on periodically from some word.

    With h that checksum and g = h div 10: where h mod 10 is 0, the words from
    a = g mod n on repeat the first 1 + (n - a) div (3 + g mod 8) of them. A
    null doc_id or a text without words is left alone.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    planted = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), h.alias("h"))
               .withColumn("words", F.expr(r"CASE WHEN h % 10 = 0 THEN regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) END"))
               .withColumn("n", F.expr("CASE WHEN size(words) > 0 THEN size(words) END"))
               .withColumn("a", F.expr("CAST((h DIV 10) % n AS int)"))
               .withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + (h DIV 10) % 8) AS int)")))
    text = """CASE WHEN n IS NULL THEN text ELSE array_join(concat(slice(words, 1, a),
        slice(flatten(array_repeat(slice(words, a + 1, p), CAST((n - a + p - 1) DIV p AS int))), 1, n - a)), ' ') END"""
    return planted.select("doc_id", F.expr(text).alias("text"))
