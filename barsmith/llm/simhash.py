"""SimHash near-duplicates by a generalised pigeonhole.

The 64 fingerprint bits are grouped into partitions of correlated bits. For
a distance of ``tau`` over ``m`` partitions, thresholds ``T`` with
``sum(T) = tau - m + 1`` (``-1`` skips a partition) lose no pair: two
fingerprints at distance ``tau`` or less agree to within ``T[i]`` bits in at
least one partition ``i``. Each fingerprint gets its own ``T`` from a dynamic
program over estimated candidate counts, so values that very many
fingerprints share are skipped in favour of rare ones. It then probes the
index of partition values with every value within ``T[i]`` and verifies the
full distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK, components, min_links, roots, stage

SEED = 42
#: Estimated cost of one probe row in units of one verified candidate.
PROBE_COST = 30.0
#: Estimated fingerprints under one index key beyond which the key is split.
KEY_ROWS = 200_000
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles of ``text`` (UTF-8), repeats included.

    A-Z are lower-cased; words are separated by ASCII white space. With fewer
    words than ``shingle`` the whole sequence is the one shingle; without
    words the fingerprint is zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    start = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
    n = len(words) - width + 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        to = min(n, at + CHUNK)
        begin, end = start[at:to].tolist(), (start[at + width:to + width] - 1).tolist()
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(begin, end)), np.uint64, to - at)
        cells = h.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256, dtype=np.int64)
        counts += (np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS).ravel()
    return int(np.packbits((2 * counts > n).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp bigint: the fingerprint's bits) per row of ``docs``; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(1).cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(t or b"", shingle) for t in text], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fp long")


def _arrays(batches: Iterator[pa.RecordBatch], n: int) -> list[np.ndarray]:
    parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
    return [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(n)]


def _sums(df: DataFrame, count, size: int) -> np.ndarray:
    """Sum over all rows of the length-``size`` vectors that ``count`` makes of each batch of fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), CHUNK):
                total += count(fp[at:at + CHUNK])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "n"])

    # at most ``size`` rows, in one job: an iterator would run one per shuffle partition
    found = df.select("fp").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[found["i"].to_numpy()] = found["n"].to_numpy()
    return out


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together(fp: np.ndarray) -> np.ndarray:
    b = _bits(fp).astype(np.float32)
    return np.rint(b.T @ b).astype(np.int64).ravel()


def group_bits(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Group the 64 bits into ``m`` partitions of near-equal size, correlated bits together."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    left, groups = set(range(64)), []
    for g in range(m):
        size = (64 - sum(map(len, groups))) // (m - g)
        own = [max(left, key=lambda i: (sum(corr[i, j] for j in left if j != i), -i))]
        left.discard(own[0])
        while len(own) < size:
            own.append(max(left, key=lambda i: (corr[i, own].sum(), -i)))
            left.discard(own[-1])
        groups.append(sorted(own))
    return groups


def pick(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.int64)
    for k, bit in enumerate(bits):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


def _masks(width: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for e in range(radius + 1) for c in combinations(range(width), e)], np.int64)


class Allocation:
    """Bit groups, candidate estimates and the threshold program; small, shipped to the tasks.

    Counts are estimated from two half-partition histograms per group,
    taken over all fingerprints, as if the halves were independent.
    """

    def __init__(self, groups: list[list[int]], histograms: list[np.ndarray], n: int, tau: int):
        self.groups, self.n, self.tau = groups, n, tau
        self.halves = [(g[: len(g) // 2], g[len(g) // 2:]) for g in groups]
        self.near = [self._near(h, tau) for h in histograms]
        self.masks = [[_masks(len(g), e) for e in range(min(tau, self._most()) + 1)] for g in groups]

    def _most(self) -> int:
        return self.tau - len(self.groups) + 1 + (len(self.groups) - 1)  # all others at -1

    @staticmethod
    def _near(hist: np.ndarray, tau: int) -> np.ndarray:
        """Share of fingerprints at exactly e flips from each value, e = 0..tau."""
        f = np.zeros((tau + 1, len(hist)))
        f[0] = hist / max(hist.sum(), 1)
        at = np.arange(len(hist))
        for bit in range(len(hist).bit_length() - 1):
            for e in range(tau, 0, -1):
                f[e] = f[e] + f[e - 1][at ^ (1 << bit)]
        return f

    def estimate(self, fp: np.ndarray, i: int, e: int) -> np.ndarray:
        """Estimated fingerprints within ``e`` bits of ``fp`` in partition ``i``."""
        if e < 0:
            return np.zeros(len(fp))
        a, b = (self.near[2 * i + k][:, pick(fp, half)] for k, half in enumerate(self.halves[i]))
        return self.n * sum(a[x] * b[y] for x in range(e + 1) for y in range(e + 1 - x))

    def thresholds(self, fp: np.ndarray) -> np.ndarray:
        """Cheapest threshold per partition and fingerprint, by dynamic programming over their sum."""
        m, want = len(self.groups), self.tau - len(self.groups) + 1
        top = self._most()
        best = np.full((len(fp), top + m + 2), np.inf)  # column s: thresholds so far sum to s - m
        best[:, m] = 0
        choice = []
        for i in range(m):
            new, took = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
            for e in range(-1, top + 1):
                cost = self.estimate(fp, i, e) + (PROBE_COST * len(self.masks[i][e]) if e >= 0 else 0)
                lo, hi = max(0, -e), best.shape[1] - max(0, e)
                moved = best[:, lo:hi] + cost[:, None]
                at = slice(lo + e, hi + e)
                less = moved < new[:, at]
                new[:, at] = np.where(less, moved, new[:, at])
                took[:, at] = np.where(less, np.int8(e), took[:, at])
            best = new
            choice.append(took)
        out, s = np.zeros((len(fp), m), np.int64), np.full(len(fp), want + m)
        for i in range(m - 1, -1, -1):
            out[:, i] = choice[i][np.arange(len(fp)), s]
            s = s - out[:, i]
        return out

    def splits(self, i: int, value: np.ndarray) -> np.ndarray:
        """Into how many parts the rows under a key are dealt: 1 but for values that very many share."""
        half = len(self.halves[i][0])
        a, b = self.near[2 * i][0][value & ((1 << half) - 1)], self.near[2 * i + 1][0][value >> half]
        return 1 + (self.n * a * b // KEY_ROWS).astype(np.int64)


def partitions_for(n: int, tau: int) -> int:
    """Number of partitions with the least expected work per fingerprint, evenly spread values assumed."""

    def cost(m: int) -> float:
        extra, total = divmod(max(tau - m + 1, 0), m), 0.0
        for i in range(m):
            e, w = extra[0] + (i < extra[1]), 64 // m
            ball = len(_masks(w, min(e, 2))) if e <= 2 else float("inf")
            total += ball * (PROBE_COST + n / 2.0 ** w)
        return total

    return min(range(2, tau + 2), key=cost) if tau else 1


def allocate(fps: DataFrame, tau: int, m: int | None = None) -> Allocation:
    """Fit bit groups and candidate estimates on all fingerprints; only 64 x 64 and histogram counts reach the driver."""
    n = fps.count()
    m = m or partitions_for(n, tau)
    groups = group_bits(_sums(fps, _together, 4096).reshape(64, 64), n, m)
    halves = [h for g in groups for h in (g[: len(g) // 2], g[len(g) // 2:])]
    sizes = [1 << len(h) for h in halves]

    def count(fp: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(pick(fp, h), minlength=s) for h, s in zip(halves, sizes)])

    hist = _sums(fps, count, sum(sizes))
    return Allocation(groups, np.split(hist, np.cumsum(sizes)[:-1]), n, tau)


def _deal(batches: Iterator[pa.RecordBatch], plan: Allocation) -> Iterator[pa.RecordBatch]:
    """Index rows (role 0) and probe rows (role 1): (key, part, fp, rep, role)."""
    for b in batches:
        rep_all, fp_all = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for lo in range(0, len(fp_all), 1 << 15):
            rep, signed = rep_all[lo:lo + (1 << 15)], fp_all[lo:lo + (1 << 15)]
            fp = signed.view(np.uint64)
            limits = plan.thresholds(fp)
            for i, g in enumerate(plan.groups):
                value, base = pick(fp, g), np.int64(i) << np.int64(40)
                parts = plan.splits(i, value)
                yield _rows(base + value, (signed.view(np.uint64) % parts.astype(np.uint64)).astype(np.int64), signed, rep, 0)
                for e in np.unique(limits[:, i]):
                    if e < 0:
                        continue
                    own = np.flatnonzero(limits[:, i] == e)
                    mask = plan.masks[i][e]
                    step = max(1, CHUNK // len(mask))
                    for at in range(0, len(own), step):
                        some = own[at:at + step]
                        probe = (value[some, None] ^ mask).ravel()
                        who = np.repeat(some, len(mask))
                        copies = plan.splits(i, probe)
                        part = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                        probe, who = np.repeat(probe, copies), np.repeat(who, copies)
                        yield _rows(base + probe, part, signed[who], rep[who], 1)


def _rows(key, part, fp, rep, role) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(part), pa.array(fp), pa.array(rep), pa.array(np.full(len(key), role, np.int8))],
        names=["key", "part", "fp", "rep", "role"])


def _verify(batches: Iterator[pa.RecordBatch], tau: int) -> Iterator[pa.RecordBatch]:
    """Check the candidates of every key in a partition; yield a spanning forest of the links found."""
    key, part, fp, rep, role = _arrays(batches, 5)
    node, own = np.unique(rep, return_inverse=True)
    parent = np.arange(len(node))
    order = np.lexsort((role, part, key))
    key, part, fp, own, role = key[order], part[order], fp[order].view(np.uint64), own[order], role[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    group = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    n_index = np.bincount(group, weights=role == 0, minlength=len(begin)).astype(np.int64)
    probes = np.flatnonzero(role == 1)
    first, many = begin[group[probes]], n_index[group[probes]]
    keep = many > 0
    probes, first, many = probes[keep], first[keep], many[keep]
    while len(probes):
        # as many probes as expand to a chunk; one probe with more candidates than that goes in slices
        upto = max(1, int(np.searchsorted(np.cumsum(many), CHUNK)))
        p, f, k = probes[:upto], first[:upto], np.minimum(many[:upto], CHUNK)
        rest = many[:upto] - k
        a = np.repeat(p, k)
        b = np.repeat(f, k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        near = (np.bitwise_count(fp[a] ^ fp[b]) <= tau) & (own[a] != own[b])
        min_links(own[a[near]], own[b[near]], parent)
        more = rest > 0
        probes = np.concatenate([p[more], probes[upto:]])
        first, many = np.concatenate([(f + k)[more], first[upto:]]), np.concatenate([rest[more], many[upto:]])
    parent = roots(parent)
    linked = np.flatnonzero(parent != np.arange(len(parent)))
    yield pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[parent[linked]])], names=["a", "b"])


def links(fps: DataFrame, tau: int, m: int | None = None) -> DataFrame:
    """Edges (a, b) between class representatives that connect all fingerprints within ``tau`` bits.

    ``fps``: (rep, fp), one row per distinct fingerprint. The edges span the
    same components as all links do; they are not the list of all links.
    """
    plan = allocate(fps, tau, m)
    dealt = (fps.select("rep", "fp").mapInArrow(partial(_deal, plan=plan), "key long, part long, fp long, rep long, role byte")
             .repartition("key", "part"))
    return dealt.mapInArrow(partial(_verify, tau=tau), "a long, b long").distinct()


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, m: int | None = None,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id, component) per row of ``docs``.

    ``fingerprint`` is 16 hex digits; documents link at ``max_bits`` or fewer
    differing bits, ``component_id`` is the smallest doc_id reachable, and
    ``component`` names the component by one of its fingerprints, so that two
    components stay apart even where unrelated rows share a doc_id. Very long
    texts are taken whole. Null and empty texts have fingerprint zero and link
    like any other. Repeated rows are returned as often as they come. A row
    with a null doc_id gets its fingerprint and a null component, and links
    with nothing. An empty table gives an empty result; other columns are not
    read.
    """
    each = stage(fingerprints(docs, shingle, id_col, text_col), "simhash-docs")
    classes = stage(each.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    part = components(links(classes.selectExpr("fp AS rep", "fp"), max_bits, m))
    named = stage(classes.join(part, classes.fp == part.node, "left").selectExpr(
        "fp AS fp_", "least", "coalesce(component, fp) AS component_fp"), "simhash-components")
    least = named.groupBy("component_fp").agg(F.min("least").alias("component_id")).withColumnRenamed("component_fp", "c")
    found = named.join(least, F.col("component_fp") == F.col("c")).select("fp_", "component_fp", "component_id")
    digits = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    given = F.col("doc_id").isNotNull()
    return each.join(found, each.fp == found.fp_, "left").select(
        "doc_id", digits("fp").alias("fingerprint"), F.when(given, F.col("component_id")).alias("component_id"),
        F.when(given, digits("component_fp")).alias("component"))
