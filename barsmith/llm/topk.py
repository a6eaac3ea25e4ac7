"""Exact top-k inner products over a bit-sliced index.

Each component is quantised to ``floor(scale * x)``. The index keeps, per
block of rows and per attribute, one bitmap per bit of the (offset)
quantised value. A query adds the slices of all attributes, weighted by its
own quantised components, with bitmap arithmetic: slices of equal weight are
combined three at a time by a full adder into one slice of that weight and
one of twice the weight, until one slice per weight is left. A negative
query component adds the complement slices, so all terms are positive. The
top rows are then selected from the most significant sum slice downward;
rows tied at the boundary are resolved exactly by vec_id.

Rows whose values are too large for sums of 62 bits are scored in integers of
any length instead, block by block like the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .vectors import deal, usable

#: Largest absolute quantised value that is sliced.
LARGEST = 1 << 60
#: Range of the scores that are returned.
_LONG = (-(1 << 63), (1 << 63) - 1)

#: Tasks that the pairs of blocks are dealt to at most.
MOST_TASKS = 20_000

#: A block of rows: whether its values are too large for slices, vector length, rows, bits of a value (queries: bytes);
#: then vec_ids, row numbers (empty: the vec_ids) and bit slices (queries: quantised values; wide blocks: plain ones).
BLOCK_SCHEMA = "wide boolean, dim int, block int, n int, bits int, ids binary, rows binary, cells binary"


def quantise(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v) as int64 where all are small enough, else as integers of any length."""
    q = np.floor(v * scale)
    if not (np.abs(q) >= LARGEST).any():
        return q.astype(np.int64)
    exact = lambda x: int(np.floor(x * scale)) if abs(x) < 2 ** 52 else int(x) * scale
    return np.array([[exact(x) for x in row] for row in v.tolist()], object).reshape(v.shape)


def _pack(batches: Iterator[pa.RecordBatch], scale: int, sliced: bool) -> Iterator[pa.RecordBatch]:
    """Rows (wide, dim, block, vec_id, row, v), sorted by their block -> one row per block."""

    def packed(key: tuple, ids: list, rows: list, vectors: list) -> tuple:
        order = np.lexsort((rows, ids))
        v = np.array(vectors, np.float64)[order]
        cells, bits = v, 0
        if not key[0] and not sliced:
            q = quantise(v, scale)
            bits = next(w for w in (1, 2, 4, 8) if -(1 << (8 * w - 1)) <= q.min() and q.max() < 1 << (8 * w - 1))
            cells = q.astype(f"<i{bits}")
        elif not key[0]:
            q = quantise(v, scale)
            bits = int(max(int(q.max()) + 1, -int(q.min()), 1) - 1).bit_length() + 1
            up = np.zeros((-(-len(q) // 64) * 64, q.shape[1]), np.int64)
            up[:len(q)] = q + (1 << (bits - 1))
            cells = np.stack([np.packbits(((up >> b) & 1).astype(np.uint8).T, axis=1, bitorder="little") for b in range(bits)], axis=1)
        cells = cells.tobytes()
        return (*key, len(v), bits, np.array(ids, np.int64)[order].tobytes(), b"" if ids == rows else np.array(rows, np.int64)[order].tobytes(), cells)

    def batch(cells: tuple) -> pa.RecordBatch:
        kinds = (pa.bool_(), *[pa.int32()] * 4, *[pa.binary()] * 3)
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=[f.split()[0] for f in BLOCK_SCHEMA.split(", ")])

    now, ids, rows, vectors = None, [], [], []
    for b in batches:
        for wide, dim, block, i, row, v in zip(*[c.to_pylist() for c in b.columns]):
            if (wide, dim, block) != now:
                if ids:
                    yield batch(packed(now, ids, rows, vectors))
                now, ids, rows, vectors = (wide, dim, block), [], [], []
            ids.append(i)
            rows.append(row)
            vectors.append(v)
    if ids:
        yield batch(packed(now, ids, rows, vectors))


def add_slices(slices: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Bit slices, least significant first, of sum(|q_j| * value_j or its complement)."""
    bits = slices.shape[1]
    size = np.abs(query)
    pending: dict[int, list[np.ndarray]] = {}
    for c in range(int(size.max(initial=0)).bit_length()):
        for sign in (1, -1):
            own = np.flatnonzero(((size >> c) & 1).astype(bool) & ((query < 0) == (sign < 0)))
            if len(own):
                part = slices[own] if sign > 0 else ~slices[own]
                for b in range(bits):
                    pending.setdefault(b + c, []).append(part[:, b])
    out, w = [], 0
    while pending:
        x = pending.pop(w, [])
        x = np.concatenate(x) if x else np.zeros((1, slices.shape[2]), np.uint64)
        while len(x) > 1:
            if len(x) == 2:
                carry, x = x[:1] & x[1:], x[:1] ^ x[1:]
            else:
                k = len(x) // 3
                a, b, c = x[:k], x[k:2 * k], x[2 * k:3 * k]
                half = a ^ b
                carry, x = (a & b) | (half & c), np.concatenate([half ^ c, x[3 * k:]])
            pending.setdefault(w + 1, []).append(carry)
        out.append(x[0])
        w += 1
    return out


def select(total: list[np.ndarray], rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sure, tied): bitmaps of the top rows and of the rows tied at the boundary, among ``rows``."""
    sure, tied = np.zeros_like(rows), rows
    n = 0
    for s in reversed(total):
        if n + int(np.bitwise_count(tied).sum()) <= k:
            break
        high = tied & s
        m = n + int(np.bitwise_count(high).sum())
        if m > k:
            tied = high
        else:
            sure, tied, n = sure | high, tied & ~s, m
            if m == k:
                return sure, np.zeros_like(rows)
    return sure, tied


def _positions(bitmap: np.ndarray) -> np.ndarray:
    word = np.flatnonzero(bitmap)
    at, bit = np.nonzero(np.unpackbits(bitmap[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return word[at] * 64 + bit


def _best_of_slices(cells: bytes, dim: int, n: int, bits: int, q: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    """(places, scores) of the top ``k`` of a sliced block but the places ``own``."""
    words = -(-n // 64)
    slices = np.frombuffer(cells, np.uint64).reshape(dim, bits, words)
    total = add_slices(slices, q)
    rows = np.frombuffer(np.packbits(np.arange(words * 64) < n, bitorder="little").tobytes(), np.uint64).copy()
    for p in own:
        rows[p // 64] &= ~np.uint64(1 << (int(p) % 64))
    sure, tied = select(total, rows, k)
    at = _positions(sure)
    at = np.concatenate([at, _positions(tied)[: k - len(at)]])  # ids ascend with the position
    low = 1 << (bits - 1)
    score = np.full(len(at), -int(q[q > 0].sum()) * low + int(q[q < 0].sum()) * (low - 1), np.int64)
    for w, s in enumerate(total):
        score += ((s[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << w
    return at, score.tolist()


def _best_of_all(values: np.ndarray, q: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    """The same with integers of any length, brought into the range of a long."""
    score = [min(max(sum(int(a) * int(b) for a, b in zip(row, q)), _LONG[0]), _LONG[1]) for row in values]
    left = set(own.tolist())
    at = sorted((p for p in range(len(score)) if p not in left), key=lambda p: (-score[p], p))[:k]
    return np.array(at, np.int64), [score[p] for p in at]


def _search(batches: Iterator[pa.RecordBatch], k: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Rows (dim, block, part, role, wide, n, bits, ids, rows, cells) sorted by the first four: the blocks of the
    index (role 0), then the queries they meet -> the best of each block for each query."""
    now, held = None, []
    for b in batches:
        for dim, block, part, role, wide, n, bits, ids, rows, cells in zip(*[c.to_pylist() for c in b.columns]):
            if (dim, block, part) != now:
                now, held = (dim, block, part), []
            ids = np.frombuffer(ids, np.int64)
            rows = np.frombuffer(rows, np.int64) if rows else ids
            if role == 0:
                held.append((wide, n, bits, ids, rows, cells))
                continue
            queries = np.frombuffer(cells, np.float64 if wide else f"<i{bits}").reshape(n, dim)
            queries = quantise(queries, scale) if wide else queries.astype(np.int64)
            for mine in held:
                out = _best(dim, *mine, ids, rows, queries, k, scale)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                     names=["query_id", "query_row", "vec_id", "row", "score"])


def _best(dim: int, wide: bool, n: int, bits: int, ids: np.ndarray, rows: np.ndarray, cells: bytes,
          q_ids: np.ndarray, q_rows: np.ndarray, queries: np.ndarray, k: int, scale: int) -> list[tuple]:
    """The best of one block of the index for each query."""
    values, out = None, []
    # sums that may leave 62 bits are not sliced
    large = wide or queries.dtype == object or float(np.abs(queries.astype(np.float64)).sum(axis=1).max()) * 2.0 ** bits >= 2.0 ** 61
    if large:
        values = quantise(np.frombuffer(cells, np.float64).reshape(n, dim), scale) if wide else _restored(cells, dim, n, bits)
    for query_id, query_row, q in zip(q_ids.tolist(), q_rows.tolist(), queries):
        lo, hi = np.searchsorted(ids, query_id), np.searchsorted(ids, query_id, "right")
        own = lo + np.flatnonzero(rows[lo:hi] == query_row)
        at, score = _best_of_all(values, q, own, k) if large else _best_of_slices(cells, dim, n, bits, q, own, k)
        out += [(query_id, query_row, int(ids[p]), int(rows[p]), s) for p, s in zip(at, score)]
    return out


def _restored(cells: bytes, dim: int, n: int, bits: int) -> np.ndarray:
    """The quantised values of a sliced block."""
    slices = np.frombuffer(cells, np.uint8).reshape(dim, bits, -1)
    out = np.zeros((n, dim), np.int64)
    for b in range(bits):
        out += np.unpackbits(slices[:, b], axis=1, bitorder="little")[:, :n].T.astype(np.int64) << b
    return out - (1 << (bits - 1))


def numbered(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(wide, dim, vec_id, row, v) of the vectors that take part; ``row`` tells rows apart that share a vec_id."""
    chosen = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
              .where(f"vec_id IS NOT NULL AND {usable('v')}"))
    if chosen.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        chosen = stage(chosen.select("*", F.monotonically_increasing_id().alias("row")), "topk-rows")
    else:
        chosen = chosen.select("*", F.col("vec_id").alias("row"))
    return chosen.selectExpr(f"exists(v, x -> abs(x) >= {LARGEST // scale}D) AS wide", "size(v) AS dim", "vec_id", "row", "v")


def blocks_of(rows: DataFrame, size: int, scale: int, sliced: bool) -> tuple[DataFrame, int]:
    """Packed blocks of about ``size`` rows, staged; and their number. ``sliced``: the bit-sliced index, else plain values."""
    dealt, n = deal(rows, "row", size)
    key = ["wide", "dim", "block"]
    packed = (dealt.select(*key, "vec_id", "row", "v").repartition(*key).sortWithinPartitions(*key)
              .mapInArrow(partial(_pack, scale=scale, sliced=sliced), BLOCK_SCHEMA))
    return stage(packed, "topk-index" if sliced else "topk-queries"), n


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64, rows: int = 16384, asked: int = 2048,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of each query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates
    all rows but the query's own; ties go to the smaller vec_id. Vectors that
    are null, empty, or hold a null or non-finite component take no part, nor
    do rows without a vec_id. Rows that share a vec_id are candidates each,
    and queries each, with ranks of their own. Components may be of any size;
    a score outside the range of a long is returned as its nearest end, and
    such scores rank by it. Vectors of different lengths are not compared. An
    empty table gives an empty result; other columns are not read.

    The index and the queries are packed into blocks of about ``rows`` and
    ``asked`` rows, which lie in the shared folder; each block of the index
    meets each block of queries in one task, which returns ``k`` rows a
    query; the blocks' winners are merged.
    """
    every_row = numbered(vectors, scale, id_col, vector_col)
    index, blocks = blocks_of(every_row, rows, scale, True)
    queries, parts = blocks_of(every_row.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0), asked, scale, False)
    to = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key, cells = ["dim", "block", "part", "role"], ["wide", "n", "bits", "ids", "rows", "cells"]
    meet = (index.withColumn("part", to(parts)).withColumn("role", F.lit(0)).select(*key, *cells)
            .unionByName(queries.withColumnRenamed("block", "part").withColumn("block", to(blocks)).withColumn("role", F.lit(1)).select(*key, *cells)))
    found = (meet.repartition(min(blocks * parts, MOST_TASKS), "dim", "block", "part").sortWithinPartitions(*key)
             .mapInArrow(partial(_search, k=k, scale=scale), "query_id long, query_row long, vec_id long, row long, score long"))
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
