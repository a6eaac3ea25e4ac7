"""Alignment of two tokenizers over a corpus, with corpus-wide pair counts by external spill counting.

Tokens of both encodings that overlap in bytes are linked. A link's weight is
the number of documents that hold its pair of ids linked; a link is best if no
other partner of its A id has a higher one.

1. Tasks encode blocks of documents and radix-partition their distinct
   (A id, B id, document) records by the A id. Each part of a block is a run
   of zstd pages sorted by A id, then B id; a page has the pairs with their
   number of documents apart from the documents. The runs lie in the shared
   folder.
2. A task per part merges the runs' pair pages with a heap, one decoded page a
   run. The order is A id first: when the heap has gone past an A id, all its
   pairs are counted and their maximum is known, and the counts stream back
   into reply pages, one per page read. Runs bring one entry per pair and
   block, so a pair that every document holds is no hot key.
3. Replies meet the documents of their pages, block by block, and are summed
   per document.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import Encoder, token_bytes
from .common import stage

#: Characters of text, and documents, of a block (at least one document), whose runs are sorted together.
BLOCK_BYTES, BLOCK_DOCS = 6 << 20, 1 << 16
#: Characters of text, and documents, that a task encodes together (at least one document).
SLICE_BYTES, SLICE_DOCS = 1 << 19, 1 << 13
#: Pairs of a page.
PAGE = 1 << 13
#: Reply rows that the merge holds before it passes them on.
FLUSH = 256

_SPILL = ("block long, doc int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
          "part int, page int, pairs binary, members binary")


def _pack(*columns: np.ndarray) -> bytes:
    """zstd of columns of unsigned numbers, each stored as differences modulo 2^32 or 2^64 in the width it needs."""
    parts = []
    for c in columns:
        wide = np.dtype("<u8") if len(c) and int(c.max()) >= 1 << 32 else np.dtype("<u4")
        c = c.astype(wide)
        c[1:] = c[1:] - c[:-1]
        parts.append(len(c).to_bytes(4, "little") + bytes([wide.itemsize]) + c.view("u1").reshape(-1, wide.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        n, width = int.from_bytes(raw[at:at + 4], "little"), raw[at + 4]
        cell = np.frombuffer(raw, "u1", n * width, at + 5).reshape(width, n).T
        out.append(np.cumsum(np.ascontiguousarray(cell).view(f"<u{width}").ravel(), dtype=f"<u{width}").astype(np.int64))
        at += 5 + n * width
    return out


class Side:
    """One tokenizer: ids of texts, the bytes of each id."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.raw = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(model.get_piece_size())]
            self.encode = model.encode  # puts the space before the text itself
        else:
            import tiktoken

            self.raw = token_bytes(path)
            special = set(Encoder.special_ids(path))
            codec = tiktoken.Encoding("a", pat_str=Encoder.PATTERN, special_tokens={},
                                      mergeable_ranks={b: i for i, b in enumerate(self.raw) if i not in special})
            self.encode = lambda text: codec.encode_to_numpy(" " + text, disallowed_special=())
        self.size = np.array([len(b) for b in self.raw], np.int64)


@lru_cache(2)
def side(path: str) -> Side:
    """One per Python worker and file."""
    return Side(path)


@lru_cache(1)
def _labels(n_a: int, n_b: int) -> np.ndarray:
    """The string of each id with what follows it: A ids and ',' or '|', then B ids and ',' or ';' or nothing."""
    return np.array([f"{i}{c}" for n, ends in ((n_a, ",|"), (n_b, (",", ";", ""))) for c in ends for i in range(n)], object)


class Slice:
    """Documents aligned together; ``key`` holds their links as one number each: (part, A id, B id, document)."""

    def __init__(self, texts: list[str], a: Side, b: Side, rank: np.ndarray, first: int):
        n = len(texts)
        want = [(" " + t).encode() if t else b"" for t in texts]
        ids_a, ids_b = [], []
        for i, t in enumerate(texts):
            x, y = (a.encode(t), b.encode(t)) if t else ((), ())
            if t and (b"".join(map(a.raw.__getitem__, x.tolist())) != want[i] or b"".join(map(b.raw.__getitem__, y)) != want[i]):
                x, y, want[i] = (), (), b""
            ids_a.append(x)
            ids_b.append(np.array(y, np.int32))
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.concatenate([np.asarray(x, np.int64) for x in ids] + [np.empty(0, np.int64)]) for ids in (ids_a, ids_b))
        ends = np.cumsum([len(w) for w in want], dtype=np.int64)
        size = int(ends[-1]) if n else 0
        end_a, end_b = np.cumsum(a.size[flat_a]), np.cumsum(b.size[flat_b])
        mark_a, mark_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        mark_a[end_a] = mark_b[end_b] = True
        cuts = np.flatnonzero(mark_a | mark_b)  # each piece between two ends is one link
        groups = np.flatnonzero(mark_a & mark_b)
        self.n_links = np.diff(np.searchsorted(cuts, ends, "right"), prepend=0)
        group_upto = np.searchsorted(groups, ends, "right")
        self.n_groups = np.diff(group_upto, prepend=0)
        self.groups = self._texts(a, b, flat_a, flat_b, np.searchsorted(groups, end_a), np.searchsorted(groups, end_b), group_upto)
        pair = rank[flat_a[np.searchsorted(end_a, cuts)]] * len(b.raw) + flat_b[np.searchsorted(end_b, cuts)]
        self.key = pair * BLOCK_DOCS + np.repeat(np.arange(first, first + n), self.n_links)

    def _texts(self, a: Side, b: Side, flat_a, flat_b, group_a, group_b, group_upto) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per document."""
        na, nb = len(a.raw), len(b.raw)
        last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.empty(0, bool) for g in (group_a, group_b))
        labels = _labels(na, nb)
        # ',' inside a side, '|' after its last A id, ';' after the last B id of a group but the document's last
        final = np.isin(group_b, group_upto - 1) & last_b
        code_a = flat_a + na * last_a
        code_b = 2 * na + flat_b + nb * np.where(final, 2, last_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        words = labels[np.concatenate([code_a, code_b])[order]].tolist()
        upto = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(words[i:j]) for i, j in zip([0, *upto], upto)]


def part_rank(n_a: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(A ids in part-major order, place of each A id in it); an A id's part is its remainder."""
    by_part = np.lexsort((np.arange(n_a), np.arange(n_a) % parts))
    rank = np.empty(n_a, np.int64)
    rank[by_part] = np.arange(n_a)
    return by_part, rank


def _opens(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)


def runs_of(key: np.ndarray, by_part: np.ndarray, n_b: int, parts: int, size: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(part, page, pairs, members) of a block's runs; a page ends with an A id, at ``size`` pairs or soon after."""
    key.sort()
    first = _opens(key)
    times = np.diff(np.append(first, len(key)))
    pair, doc = np.divmod(key[first], BLOCK_DOCS)
    first = _opens(pair)
    member = np.append(first, len(pair))
    docs = np.diff(member)
    a, b = np.divmod(pair[first], n_b)
    a = by_part[a]
    ends = np.append(_opens(a)[1:], len(a)).tolist() if len(a) else []
    part = (a % parts).tolist()
    at, page = 0, 0
    for end in ends:
        done = end == len(part) or part[end] != part[at]
        if end - at >= size or done:
            lo, hi = member[at], member[end]
            yield part[at], page, _pack(a[at:end], b[at:end], docs[at:end]), _pack(docs[at:end], doc[lo:hi], times[lo:hi])
            at, page = end, 0 if done else page + 1


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[str], bool]]:
    """(ids, texts, whether they are the last) of at most ``most`` documents and about SLICE_BYTES."""
    ids: list[int | None] = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            if size >= SLICE_BYTES or len(ids) >= most:
                yield ids, texts, False
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t.as_py() or "")
            size += len(texts[-1])
    if ids:
        yield ids, texts, True


def spill(docs: DataFrame, path_a: str, path_b: str, parts: int, id_col: str = "doc_id", text_col: str = "text",
          block_docs: int = BLOCK_DOCS, page: int = PAGE) -> DataFrame:
    """Rows of two kinds: one per document (``doc`` is set) and one per page of a run (``part`` is set).

    ``block`` and ``doc`` name a row of ``docs`` within one staged result,
    whatever its doc_id. The groups of a text are ``a1,a2|b1;a3|b2,b3``.
    """

    names = [f.split()[0] for f in _SPILL.split(", ")]

    def rows(n: int, block: int, cells: list, at: int) -> pa.RecordBatch:
        """Columns from ``at`` on; the others are null."""
        kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        arrays = [pa.array(np.full(n, block)), *[pa.nulls(n, k) for k in kinds[1:]]]
        for k, c in enumerate(cells, at):
            arrays[k] = pa.array(c, kinds[k])
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = side(path_a), side(path_b)
        by_part, rank = part_rank(len(a.raw), parts)
        block, n, size = TaskContext.get().partitionId() << 32, 0, 0
        keys: list[np.ndarray] = []
        for ids, texts, last in _slices(batches, min(block_docs, SLICE_DOCS)):
            x = Slice(texts, a, b, rank, n)
            yield rows(len(ids), block, [np.arange(n, n + len(ids)), ids, x.n_a, x.n_b, x.n_groups, x.n_links, x.groups], 1)
            keys.append(x.key)
            n, size = n + len(ids), size + sum(map(len, texts))
            if last or n + min(block_docs, SLICE_DOCS) > BLOCK_DOCS or n >= block_docs or size >= BLOCK_BYTES:
                found = list(runs_of(np.concatenate(keys), by_part, len(b.raw), parts, page))
                keys = []
                for k in range(0, len(found), FLUSH):
                    yield rows(len(found[k:k + FLUSH]), block, list(zip(*found[k:k + FLUSH])), 8)
                block, n, size = block + 1, 0, 0

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, _SPILL)


class _Run:
    """One block's pages of a part: the pairs of the A id at its head, and the reply to the page in hand."""

    def __init__(self, block: int):
        self.block, self.pages, self.page, self.at, self.end = block, [], 0, 0, 0

    def turn(self, decoded: list[np.ndarray] | None = None) -> None:
        self.a, self.b, self.n = decoded or _unpack(self.pages[self.page])
        self.pages[self.page] = None
        self.ends = np.append(np.flatnonzero(self.a[1:] != self.a[:-1]) + 1, len(self.a)).tolist()
        self.heads = self.a[np.array([0, *self.ends[:-1]])].tolist()
        self.at, self.group = 0, 0
        self.count, self.best = np.empty(len(self.a), np.int64), np.empty(len(self.a), np.int64)


def merge_runs(runs: list[_Run]) -> Iterator[tuple[int, int, bytes]]:
    """(block, page, reply) of all pages of one part's runs, by a k-way merge in A order."""
    heap = []
    for k, r in enumerate(runs):
        r.turn()
        heap.append((r.heads[0], k))
    heapq.heapify(heap)
    while heap:
        a, held = heap[0][0], []
        while heap and heap[0][0] == a:
            held.append(heapq.heappop(heap)[1])
        spans = [(r, r.at, r.ends[r.group]) for r in (runs[k] for k in held)]
        if len(spans) == 1:
            r, lo, hi = spans[0]
            r.count[lo:hi] = r.n[lo:hi]
            r.best[lo:hi] = r.n[lo:hi] == r.n[lo:hi].max()
        else:
            _, of = np.unique(np.concatenate([r.b[lo:hi] for r, lo, hi in spans]), return_inverse=True)
            total = np.bincount(of, np.concatenate([r.n[lo:hi] for r, lo, hi in spans])).astype(np.int64)
            most, at = total == total.max(), 0
            for r, lo, hi in spans:
                mine = of[at:at + hi - lo]
                r.count[lo:hi], r.best[lo:hi] = total[mine], most[mine]
                at += hi - lo
        for k, (r, _, hi) in zip(held, spans):
            r.at, r.group = hi, r.group + 1
            if r.group == len(r.ends):
                yield r.block, r.page, _pack(r.count, r.best)
                r.page += 1
                if r.page == len(r.pages):
                    runs[k] = None
                    continue
                r.turn()
            heapq.heappush(heap, (r.heads[r.group], k))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages sorted by (part, block, page) -> (block, part, page, reply)."""

    def replies() -> Iterator[tuple[int, int, int, bytes]]:
        part, runs = None, []
        for batch in batches:
            for p, block, pairs in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if p != part:
                    yield from ((b, part, g, x) for b, g, x in merge_runs(runs))
                    part, runs = p, []
                if not runs or runs[-1].block != block:
                    runs.append(_Run(block))
                runs[-1].pages.append(pairs)
        yield from ((b, part, g, x) for b, g, x in merge_runs(runs))

    def batch(rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["block", "part", "page", "reply"])

    held = []
    for r in replies():
        held.append(r)
        if len(held) == FLUSH:
            yield batch(held)
            held = []
    if held:
        yield batch(held)


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, members, reply) sorted by block -> (block, doc, n_best, count_sum)."""

    def batch(block: int, best: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        doc = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), block)), pa.array(doc.astype(np.int32)), pa.array(best[doc]), pa.array(total[doc])],
                                          names=["block", "doc", "n_best", "count_sum"])

    now, best, total = None, None, None
    for b in batches:
        for block, members, reply in zip(*(b.column(k).to_pylist() for k in range(3))):
            if block != now:
                if now is not None:
                    yield batch(now, best, total)
                now, best, total = block, np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
            docs, doc, times = _unpack(members)
            count, top = _unpack(reply)
            np.add.at(best, doc, np.repeat(top, docs) * times)
            np.add.at(total, doc, np.repeat(count, docs) * times)
    if now is not None:
        yield batch(now, best, total)


def align(docs: DataFrame, path_a: str, path_b: str, parts: int | None = None, groups: Column | None = None,
          id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS, page: int = PAGE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per row of ``docs``.

    A encodes a space and the text with a byte-level ``.json`` vocabulary, B
    the text with a ``.model`` that adds the space itself; special strings are
    plain text. Byte offsets where tokens of both end cut them into groups
    (``a1,a2|b1;a3|b2,b3``); tokens that overlap are linked. ``n_best`` counts
    the links whose pair is in as many documents as any pair of their A id,
    ``count_sum`` sums the documents of the links' pairs.

    ``groups`` is what to keep of the groups' text (an expression over the
    column ``groups``; default: the text). ``parts`` (default: the session's
    shuffle partitions) is the number of merges; ``block_docs`` and ``page``
    bound the documents of a block and the pairs of a page.

    A null or empty text, or one that the tokens do not spell byte by byte (B
    may change white space), has no tokens: zeros and an empty string. Ties
    are best together. Repeated rows and doc_ids count as documents of their
    own and pass through one by one, as do null doc_ids; other columns are not
    read, whatever their names. A very long text is a block of its own, taken
    whole.
    """
    if block_docs > BLOCK_DOCS:
        raise ValueError(f"block_docs <= {BLOCK_DOCS}")
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spilled = stage(spill(docs, path_a, path_b, parts, id_col, text_col, block_docs, page).withColumn(
        "groups", F.when(F.col("doc").isNotNull(), groups if groups is not None else F.col("groups"))), "alignment")
    runs = spilled.where("part IS NOT NULL")
    replies = (runs.select("part", "block", "page", "pairs").repartition(parts, "part").sortWithinPartitions("part", "block", "page")
               .mapInArrow(_count, "block long, part int, page int, reply binary"))
    sums = (runs.select("block", "part", "page", "members").join(replies, ["block", "part", "page"])
            .select("block", "members", "reply").repartition("block").sortWithinPartitions("block")
            .mapInArrow(_sum, "block long, doc int, n_best long, count_sum long"))
    rows = spilled.where("doc IS NOT NULL").select("block", "doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    return rows.join(sums, ["block", "doc"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups")
