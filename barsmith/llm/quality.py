"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into quantile bins. Boosting goes round the
features in cycles; each step fits a shallow tree on one feature's bin
totals of gradients and adds it to that feature's lookup table. The pairs
that explain most of what is left get two-dimensional tables, boosted the
same way. A score is the sum of the bins' table entries.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the model is fitted on at most (those with the smallest hash of the doc_id).
SAMPLE = 20_000

FEATURES = ("log_bytes", "log_words", "word_length", "word_spread", "upper", "letters", "digits", "spaces", "symbols",
            "high", "stops", "distinct_words", "common_word", "short_words", "line_words", "distinct_lines", "symbol_words",
            "marked_words", "shouted_words", "linked_words")

_CLASS = np.zeros(256, np.int64)
_CLASS[[*range(65, 91)]] = 1
_CLASS[[*range(97, 123)]] = 2
_CLASS[[*range(48, 58)]] = 3
_CLASS[[0x20, *range(9, 14)]] = 4
_CLASS[[*b".,;:!?'\"-"]] = 5
_CLASS[128:] = 6
_SYMBOLS = bytes(b for b in range(33, 127) if _CLASS[b] == 0)
_MARKS = _SYMBOLS + b"!?"


def features(text: bytes) -> list[float]:
    """The FEATURES of one whole text; an empty text has all zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    kind = np.bincount(_CLASS, weights=np.bincount(np.frombuffer(text, np.uint8), minlength=256), minlength=7)
    n = len(text)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    k = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    different = Counter(words)
    common = max(different.values(), default=0)
    bare = [w.strip(_MARKS) for w in words]
    return [
        math.log1p(n), math.log1p(len(words)), float(lengths.mean()), float(lengths.std()),
        kind[1] / max(1.0, kind[1] + kind[2]), (kind[1] + kind[2]) / n, kind[3] / n, kind[4] / n, kind[0] / n, kind[6] / n,
        kind[5] / k, len(different) / k, common / k, float((lengths <= 3).mean()), len(words) / max(1, len(lines)),
        len(set(lines)) / max(1, len(lines)), sum(not b for b in bare) / k,
        sum(len(b) != len(w) for b, w in zip(bare, words)) / k, sum(w.isupper() and len(w) > 1 for w in words) / k,
        sum(b"://" in w or b"@" in w or b"www." in w for w in words) / k]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, x array<double>, *carry) per row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t or b"") for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64())), *b.columns[2:]],
                                             names=["doc_id", "x", *b.schema.names[2:]])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         *[F.col(c).alias(f"c_{i}") for i, c in enumerate(carry)])
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields[2:])
    return chosen.mapInArrow(run, "doc_id long, x array<double>" + kinds)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Step values per bin of a tree of at most ``leaves`` leaves on ordered bins, greedily split."""
    parts = [(0, len(g))]
    value = lambda a, b: -g[a:b].sum() / (h[a:b].sum() + ridge)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for p, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gain = left_g ** 2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g ** 2 / (all_h + ridge)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], p, a + at + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = value(a, b)
    return out


class Model:
    """Lookup tables per feature and per pair of features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, pairs: int = 6, pair_bins: int = 8,
                 rate: float = 0.2, leaves: int = 4, ridge: float = 2.0):
        n, d = x.shape if len(x) else (0, len(FEATURES))
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(d)]
        self.coarse = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, pair_bins + 1)[1:-1])) if n else np.zeros(0) for f in range(d)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        positive = float(y.sum())
        self.base = math.log((positive + 1) / (n - positive + 1))
        if not 0 < positive < n:
            return
        cell = self._bins(x, self.edges)
        raw = np.full(n, self.base)
        for _ in range(rounds):
            for f in range(d):
                p = 1 / (1 + np.exp(-raw))
                size = len(self.tables[f])
                if size < 2:
                    continue
                step = rate * _tree(np.bincount(cell[f], p - y, size), np.bincount(cell[f], p * (1 - p), size), leaves, ridge)
                self.tables[f] += step
                raw += step[cell[f]]
        cell = self._bins(x, self.coarse)
        p = 1 / (1 + np.exp(-raw))
        ranked = []
        for a, b in combinations(range(d), 2):
            at, size = self._cross(cell, a, b)
            g, h = np.bincount(at, p - y, size), np.bincount(at, p * (1 - p), size)
            ranked.append((-(g ** 2 / (h + ridge)).sum(), a, b))
        self.pairs = [(a, b) for _, a, b in sorted(ranked)[:pairs]]
        self.pair_tables = [np.zeros(self._cross(cell, a, b)[1]) for a, b in self.pairs]
        for _ in range(rounds // 4):
            for t, (a, b) in zip(self.pair_tables, self.pairs):
                p = 1 / (1 + np.exp(-raw))
                at, size = self._cross(cell, a, b)
                g, h = (np.bincount(at, w, size).reshape(-1, len(self.coarse[b]) + 1) for w in (p - y, p * (1 - p)))
                step = np.concatenate([_tree(g[i], h[i], 2, ridge) for i in range(len(g))]) * rate  # a shallow tree per row of cells
                t += step
                raw += step[at]

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]

    def _cross(self, cell: list[np.ndarray], a: int, b: int) -> tuple[np.ndarray, int]:
        width = len(self.coarse[b]) + 1
        return cell[a] * width + cell[b], (len(self.coarse[a]) + 1) * width

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row: table entries of the row's bins, added."""
        raw = np.full(len(x), self.base)
        for t, at in zip(self.tables, self._bins(x, self.edges)):
            raw += t[at]
        if self.pairs:
            cell = self._bins(x, self.coarse)
            for t, (a, b) in zip(self.pair_tables, self.pairs):
                raw += t[self._cross(cell, a, b)[0]]
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``sample`` labelled rows that are not held out, chosen by a hash of the doc_id.

    Rows of ``labels`` that share a doc_id count once, with the larger label;
    null labels and ids do not count, nor do ids without a document. Without
    both labels among the rows every score is the (smoothed) share of label 1.
    The chosen ids, at most ``sample``, are broadcast; only their texts are
    turned into features here.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id_"))
    known = (labels.select(F.col("doc_id").cast("long").alias("id_"), F.col("quality").cast("int").alias("y_"))
             .where("id_ IS NOT NULL AND y_ IS NOT NULL").groupBy("id_").agg(F.max("y_").alias("y_")).where(~held_out("id_"))
             .join(ids, "id_", "left_semi").orderBy(F.xxhash64("id_"), "id_").limit(sample))
    chosen = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
              .join(F.broadcast(known), F.col("doc_id") == F.col("id_")).select("doc_id", "text", "y_"))
    rows = (feature_table(chosen, carry=("y_",)).select("x", "c_0", F.xxhash64("doc_id").alias("k"))
            .orderBy("k", "x").limit(sample).collect())
    x = np.array([r.x for r in rows], np.float64).reshape(len(rows), len(FEATURES))
    return Model(x, np.array([r.c_0 for r in rows], np.float64))


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = b.column(1).cast(pa.binary()).to_pylist()
        x = np.array([features(t or b"") for t in text], np.float64).reshape(b.num_rows, len(FEATURES))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x)), *b.columns[2:]],
                                         names=["doc_id", "score", *b.schema.names[2:]])


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted, *carry) per row of ``docs``.

    Only the text is an input of a score. Labels are learned from rows whose
    crc32(doc_id as text) mod 3 is not 1. Null texts score as empty ones;
    repeated rows and null doc_ids are scored like others. An empty table
    gives an empty result; columns not named in ``carry`` are not read.
    """
    model = fit(docs, labels, sample, id_col, text_col)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         *[F.col(c).alias(f"c_{i}") for i, c in enumerate(carry)])
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields[2:])
    scored = chosen.mapInArrow(partial(_score, model=model), "doc_id long, score double" + kinds)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         *[F.col(f"c_{i}").alias(c) for i, c in enumerate(carry)])
