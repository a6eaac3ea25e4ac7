from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from barsmith.llm import ctw
from barsmith.llm.ctw import Lookup, gram_codes, log_gamma, score_texts


def is_learned(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 != 1


def log_kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)


class BruteTree:
    """Context-tree weighting by recursion over explicit nodes."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.children = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        for t in texts:
            for ctx, byte in self.steps(t):
                for k in range(8):
                    node, bit = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1
                    for d in range(depth + 1):
                        self.counts[node, ctx[:d]][bit] += 1
                        if d:
                            self.children[node, ctx[:d - 1]].add(ctx[:d])
        self.known = {}

    def steps(self, text):
        seq = bytes(self.depth) + text + b"\0"
        for i in range(self.depth, len(seq)):
            yield seq[i - self.depth:i][::-1], seq[i]

    def weighted(self, node, ctx):
        key = node, ctx
        if key not in self.known:
            a, b = self.counts.get(key, (0, 0))
            kt = log_kt(a, b)
            if len(ctx) < self.depth:
                below = sum(self.weighted(node, c) for c in self.children.get(key, ()))
                self.known[key] = kt, float(np.logaddexp(kt, below)) - math.log(2)
            else:
                self.known[key] = kt, kt
        return self.known[key][1]

    def score(self, text):
        total = 0.0
        for ctx, byte in self.steps(text):
            for k in range(8):
                node, bit = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1
                p = None
                for d in range(self.depth, -1, -1):
                    c = self.counts.get((node, ctx[:d]), (0, 0))
                    own = (c[bit] + .5) / (sum(c) + 1)
                    if d == self.depth:
                        p = own
                    else:
                        w = self.weighted(node, ctx[:d])
                        stop = math.exp(self.known[node, ctx[:d]][0] - math.log(2) - w)
                        p = stop * own + (1 - stop) * p
                total += math.log10(p)
        return total


def brute(rows, depth):
    raw = [(i, (t or "").encode()) for i, t in rows]
    tree = BruteTree([b for i, b in raw if is_learned(i)], depth)
    tokens = [(i, [*re.findall(rb"[^\x20\x09-\x0D]+", b.lower()), None]) for i, b in raw]
    c = Counter(t for i, ts in tokens if is_learned(i) for t in ts)
    n, v = sum(c.values()), len(c)
    return [(i, not is_learned(i), len(ts), sum(c[t] > 0 for t in ts), n,
             sum(math.log10((c[t] + .5) / (n + .5 * (v + 1))) for t in ts), tree.score(b)) for (i, b), (_, ts) in zip(raw, tokens)]


ROWS = [(i, t) for i, t in enumerate(["the cat sat on the mat", "The dog sat on the log", "a cat and a dog", "", None, "ünï çødé the",
                                      "zzz qqq", "the the the the the", "cat\tdog\ncat", "on the mat sat the cat"] * 2)]


@pytest.mark.parametrize("depth,head,shard,hot", [(2, 4, 50, 9), (3, 1 << 19, 3_000_000, 1024), (3, 4, 50, 30), (4, 0, 7, 30), (4, 0, 7, 1)])
def test_matches_brute_force(spark, depth, head, shard, hot):
    rows = ROWS + [(30, "x" * 300)]
    got = score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), depth, shard, head, hot).collect()
    for r, w in zip(sorted(got, key=lambda r: r.doc_id), brute(rows, depth)):
        assert tuple(r)[:5] == w[:5]
        assert math.isclose(r.base_score, w[5], rel_tol=1e-9) and math.isclose(r.score, w[6], rel_tol=1e-8)


def test_edge_cases(spark):
    schema = "doc_id long, text string, row string, score int"
    df = spark.createDataFrame([(1, "a b", "x", 1), (1, "a b", "x", 1), (None, "b", None, None)], schema)
    got = sorted(score_texts(df, 2).collect(), key=str)
    want = sorted(brute([(1, "a b"), (1, "a b"), (None, "b")], 2), key=str)
    assert [tuple(r)[:5] for r in got] == [w[:5] for w in want]
    assert score_texts(df.limit(0), 2).count() == 0
    held = next(i for i in range(99) if not is_learned(i))
    only = score_texts(spark.createDataFrame([(held, "a b")], "doc_id long, text string"), 2).first()
    assert (only.train_tokens, only.n_known, only.n_tokens) == (0, 0, 3) and only.base_score == 0
    assert math.isclose(only.score, 8 * 4 * math.log10(.5), rel_tol=1e-9)


def test_deeper_contexts_help_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    deep, flat = score_texts(docs, 5).toPandas(), score_texts(docs, 2).toPandas()
    size = sum(len(r.text.encode()) + 1 for r in docs.collect() if not is_learned(r.doc_id))
    assert len(deep) == 1000 and deep.score[deep.held_out].sum() > flat.score[flat.held_out].sum()
    assert -deep.score[deep.held_out].sum() * math.log2(10) / size < 3


def test_gram_codes_and_lookup():
    code, to = gram_codes(np.frombuffer(b"abc", np.uint8), np.array([0, 2, 2, 3]), 2)
    assert to.tolist() == [0, 3, 4, 6]
    tri = [(int(c) >> 16, int(c) >> 8 & 255, int(c) & 255) for c in code]
    assert tri == [(0, 0, 97), (97, 0, 98), (98, 97, 0), (0, 0, 0), (0, 0, 99), (99, 0, 0)]
    key = np.arange(1000, dtype=np.uint64) * np.uint64(7)
    found, value = Lookup(key, np.arange(1000.0)).get(np.arange(7000, dtype=np.uint64))
    assert found.sum() == 1000 and (value[found] == np.arange(1000)).all()
    x = np.array([.5, 1, 3.5, 1e6])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


def test_only_a_bounded_head_of_the_model_is_shipped(spark, monkeypatch):
    shipped, ship = [], ctw._ship
    monkeypatch.setattr(ctw, "_ship", lambda df, table: shipped.append(int((table.key != Lookup.EMPTY).sum())) or ship(df, table))
    rows = [(i, f"{t} {i * i}") for i, t in ROWS]
    got = score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 50, 4).collect()
    assert len(shipped) == 2 and shipped[0] <= 4 and 0 < shipped[1] <= 50
    for r, w in zip(sorted(got, key=lambda r: r.doc_id), brute(rows, 3)):
        assert math.isclose(r.score, w[6], rel_tol=1e-8)
