"""Which hashed positions repeat: the exchange shared by the substring operators.

Each task first looks at its own positions. A hash that already repeats
within the task is settled there: its positions are known to repeat and only
one witness of it is sent on, so a passage that a third of all documents
hold reaches the exchange once a task, not once a document. The others are
sent as open questions and settled where all equal hashes meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Bytes of text that a task looks at together.
SLICE_BYTES = 1 << 20

OPEN, WITNESS, KNOWN = 0, 1, 2
#: One row per slice and part: the part's questions, packed column by column, in ascending row.
ASK_SCHEMA = "part int, h binary, g binary, row binary, pos binary, kind binary"

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@lru_cache(6)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Rolling:
    """64-bit hashes of any ranges of a sequence, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = max(len(values) + 1, 1 << 10)
        self.up, self.down = _powers(_BASES[which], 1 << (n - 1).bit_length())
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:len(values)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


#: Modulus and bases of :class:`PrimeRolling`.
_PRIME, _PRIME_BASES = (1 << 31) - 1, (0x2545F491, 0x5851F42D, 0x14057B7E)


@lru_cache(6)
def _prime_powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo the prime, by doubling."""
    out = []
    for base in (_PRIME_BASES[which], pow(_PRIME_BASES[which], -1, _PRIME)):
        x = np.ones(1, np.uint64)
        while len(x) < n:
            x = np.concatenate([x, x * np.uint64(pow(base, len(x), _PRIME)) % np.uint64(_PRIME)])
        out.append(x)
    return out[0], out[1]


class PrimeRolling:
    """31-bit hashes of any ranges of a sequence, from prefix sums of a polynomial modulo a prime: unlike
    modulo a power of two, no pattern of two values collides whatever the base."""

    def __init__(self, values: np.ndarray, which: int):
        self.up, self.down = _prime_powers(which, 1 << max(10, len(values).bit_length()))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values % np.uint64(_PRIME) * self.up[:len(values)] % np.uint64(_PRIME), out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) % np.uint64(_PRIME) * self.down[start] % np.uint64(_PRIME)


#: Bytes of a word up to which words are hashed together, eight bytes at a time.
_SHORT_WORD = 64


def word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of the bytes of each range, mixed anew after every eight bytes; long ranges by XXH64."""
    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    h = mixed(size.astype(np.uint64) * np.uint64(_BASES[0]) + np.uint64(seed))
    left = np.flatnonzero(size <= _SHORT_WORD)
    done = 0
    while len(left):
        left = left[size[left] > done]
        value = eight[start[left] + done].view("<u8").ravel()
        spare = np.maximum(8 - (size[left] - done), 0).astype(np.uint64)
        value = value << np.uint64(8) * spare  # the bytes past the end go
        h[left] = mixed(mixed((h[left] ^ value) * np.uint64(_BASES[1])) * np.uint64(_BASES[2]))
        done += 8
    long = np.flatnonzero(size > _SHORT_WORD)
    if len(long):
        raw = data.tobytes()
        h[long] = [xxhash.xxh64_intdigest(raw[i:j], seed) for i, j in zip(start[long].tolist(), end[long].tolist())]
    return h


def keyed(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(row, doc_id, text, *carry): ``row`` is unique and not null. It is the doc_id where
    that serves; else the rows are numbered and written once so the numbers stay."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         *[F.col(c).alias(f"c_{i}") for i, c in enumerate(carry)])
    ids = chosen.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if ids.limit(1).count():
        return stage(chosen.select(F.monotonically_increasing_id().alias("row"), "*"), "numbered-docs")
    return chosen.select(F.col("doc_id").alias("row"), "*")


def slices(batch: pa.RecordBatch, text: int = 2, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with about ``size`` bytes of text: (rows, bytes, offsets of the rows' texts in them)."""
    column = batch.column(text).cast(pa.binary()).fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield batch.slice(at, to - at), data[ends[at]:ends[to]], ends[at:to + 1] - ends[at]
        at = to


def _groups(h: np.ndarray, g: np.ndarray, row: np.ndarray, two_rows: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first-of-group flags, repeats flags), both in order: equal (h, g) stand together, rows ascending."""
    order = np.lexsort((row, g, h))
    h, g, row = h[order], g[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(h)))
    if two_rows and len(start):
        again = row[start] != row[start + size - 1]
    else:
        again = size > 1
    return order, new, np.repeat(again, size)


def ask(h: np.ndarray, g: np.ndarray, row: np.ndarray, pos: np.ndarray, two_rows: bool, parts: int, width: int = 8) -> pa.RecordBatch:
    """Questions of a slice: what repeats within it is known, with one witness for the others.

    ``width`` is the number of bytes of ``h`` that are sent besides the part,
    which other bits of ``h`` determine. Where an answer only selects
    candidates, fewer bytes will do: chance matches then cost work, not results.
    """
    order, new, again = _groups(h, g, row, two_rows)
    h, g, row, pos = h[order], g[order], row[order], pos[order]
    known, witness, own = np.flatnonzero(again), np.flatnonzero(again & new), np.flatnonzero(~again)
    at = np.concatenate([own, witness, known])
    kind = np.repeat(np.array([OPEN, WITNESS, KNOWN], np.int8), [len(own), len(witness), len(known)])
    spread = np.where(kind == KNOWN, mixed(row[at].astype(np.uint64) * np.uint64(_BASES[1])), h[at])
    part = ((spread >> np.uint64(40)) % np.uint64(parts)).astype(np.int32)
    order = np.lexsort((pos[at], row[at], kind == KNOWN, part))
    at, part, kind = at[order], part[order], kind[order]
    edge = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, np.int64)
    low = h[at].view(np.uint8).reshape(-1, 8)[:, :width]
    out: list[list] = [[] for _ in range(6)]
    for lo, hi in zip(edge, np.append(edge[1:], len(part))):
        asked = lo + int((kind[lo:hi] != KNOWN).sum())  # known positions come last and need no hash
        rows = row[at[lo:hi]].astype(np.int64)
        cells = (int(part[lo]), low[lo:asked].tobytes(), g[at[lo:asked]].astype(np.int32).tobytes() if width == 8 else b"",
                 np.diff(rows, prepend=0).tobytes(), pos[at[lo:hi]].astype(np.int32).tobytes(), kind[lo:hi].tobytes())
        for o, c in zip(out, cells):
            o.append(c)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *[pa.array(o, pa.binary()) for o in out[1:]]],
                                      names=["part", "h", "g", "row", "pos", "kind"])


def lists(row: np.ndarray, value: np.ndarray, name: str) -> pa.RecordBatch:
    """(row, list of its values): one row per distinct ``row``."""
    order = np.argsort(row, kind="stable")
    row, value = row[order], value[order]
    at = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.empty(0, np.int64)
    ends = pa.array(np.append(at, len(row)).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(row[at].astype(np.int64)), pa.ListArray.from_arrays(ends, pa.array(value))], names=["row", name])


def _answer(batches: Iterator[pa.RecordBatch], two_rows: bool, width: int) -> Iterator[pa.RecordBatch]:
    """Questions sorted by part -> the positions that repeat; one part is held at a time."""
    now, held = None, []

    def settle() -> pa.RecordBatch:
        h, g, row, pos, kind = (np.concatenate(c) for c in zip(*held))
        order, _, again = _groups(h, g, row, two_rows)
        own = order[again & (kind[order] == OPEN)]
        return lists(row[own], pos[own], "found")

    for b in batches:
        for part, h, g, row, pos, kind in zip(*[c.to_pylist() for c in b.columns]):
            if part != now and held:
                yield settle()
                held = []
            now = part
            rows, at, kinds = np.cumsum(np.frombuffer(row, np.int64)), np.frombuffer(pos, np.int32), np.frombuffer(kind, np.int8)
            known = kinds == KNOWN
            if known.any():
                yield lists(rows[known], at[known], "found")
            n = int((~known).sum())
            hashes = np.zeros((n, 8), np.uint8)
            hashes[:, :width] = np.frombuffer(h, np.uint8).reshape(n, width)
            second = np.frombuffer(g, np.int32) if width == 8 else np.zeros(n, np.int32)
            held.append((hashes.view(np.uint64).ravel(), second, rows[~known], at[~known], kinds[~known]))
    if held:
        yield settle()


#: Bytes of text for which an exchange has a task.
TASK_BYTES = 4 << 20


def tasks_for(base: DataFrame, text_col: str = "text") -> int:
    """Tasks of an exchange: one for every TASK_BYTES of text, at least the session's shuffle partitions,
    so that what a task holds does not grow with the table."""
    size = base.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))


def parts_for(tasks: int) -> int:
    """Parts that the questions are dealt into: twice the tasks, so they fall evenly."""
    return 2 * tasks


def answers(questions: DataFrame, tasks: int, two_rows: bool, width: int = 8) -> DataFrame:
    """(row, found): the positions asked whose hash repeats (``two_rows``: in two different rows)."""
    found = questions.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(
        partial(_answer, two_rows=two_rows, width=width), "row long, found array<int>")
    return gathered(found, tasks, "found")


def gathered(lists_: DataFrame, tasks: int, name: str) -> DataFrame:
    """One row per ``row``, its lists joined; dealt by ``row`` to ``tasks`` tasks, as what it is joined with."""
    return lists_.repartition(tasks, "row").groupBy("row").agg(F.flatten(F.collect_list(name)).alias(name))
