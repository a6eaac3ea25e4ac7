from __future__ import annotations

import random

import numpy as np
import pytest

from barsmith.llm.suffix import Run, Suffixes, anchor_positions, anchored, gram_hashes, make_runs, merge, pack, remove_earlier, unpack


def brute(rows, length):
    raw = [((t or "").encode(), i) for i, t in rows]
    first: dict[bytes, float] = {}
    key = lambda i: float("inf") if i is None else i
    for b, i in raw:
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, float("inf")), key(i))
    out = []
    for b, i in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < key(i):
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def corpus(seed, n=70, letters="ab \0é"):
    rnd = random.Random(seed)
    draw = lambda k: "".join(rnd.choice(letters) for _ in range(k))
    passages = [draw(rnd.randint(30, 160)) for _ in range(6)] + ["ab" * 60, " " * 90]
    rows = []
    for i in range(n):
        t = draw(rnd.randint(0, 80))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            if rnd.random() < 0.5:
                k = rnd.randrange(len(p))
                p = p[:k] + "X" + p[k + 1:]
            t += p + draw(rnd.randint(0, 20))
        rows.append((i * 3 % 71, t))
    return rows + [(500, None), (501, ""), (502, "short"), (503, rows[0][1]), (504, rows[0][1])]


@pytest.mark.parametrize("length,gram,letters", [(50, 16, "ab \0é"), (50, 16, "abcdefghij klm"), (24, 8, "abc"), (64, 16, "ab")])
def test_matches_brute_force(spark, length, gram, letters):
    rows = corpus(length + len(letters), letters=letters)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = remove_earlier(df, length, gram).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str) == brute(rows, length)


def test_null_and_repeated_ids_and_clashing_columns(spark):
    t = "".join(chr(97 + i * 7 % 26) for i in range(90))
    rows = [(4, t, 1, "x"), (4, t, 1, "x"), (None, t + "!", 2, "y"), (None, "?" + t, 2, "y"), (9, "zz" + t, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, found string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_earlier(df).collect()), key=str)
    assert got == brute([r[:2] for r in rows], 50)
    assert remove_earlier(df.limit(0)).count() == 0


def test_every_stretch_has_an_anchor():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 2, 600).astype(np.uint8)
    ends = np.array([0, 0, 49, 100, 600])
    at, _ = anchor_positions(data, ends, 50, 16)
    for lo, hi in zip(ends[:-1], ends[1:]):
        for p in range(lo, hi - 49):
            assert ((at >= p) & (at <= p + 34)).any()
    h, least = gram_hashes(data, ends, 50, 16)
    first, last = anchored(h, least, at, 34)
    for a, lo, hi in zip(at, first, last):
        own = [p for p in range(max(0, a - 34), a + 1) if p < len(least) and least[p] == h[a]]
        assert own == list(range(lo, hi + 1))


def test_runs_are_front_coded_and_merge_in_order():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(20, 60))).encode() for _ in range(120)]
    runs, want = [], []
    for k in range(0, 120, 17):
        data = np.frombuffer(b"".join(texts[k:k + 17]), np.uint8)
        ends = np.cumsum([0, *map(len, texts[k:k + 17])])
        n = len(ends) - 1
        first, last = ends[:-1], ends[:-1] + np.minimum(np.diff(ends), 20) - 20
        s = Suffixes.read(data, ends, ends[:-1], np.arange(n), np.arange(n), np.arange(n), 20, 8, first, last)
        want += [t[:20] for t in texts[k:k + 17]]
        for _, count, *cells in make_runs(s, 1, 8)[0]:
            assert unpack(pack(0, count, *cells)[2:]) == cells
            runs.append(Run(count, *cells))
    out = list(merge(runs))
    assert [x for _, x, _ in out] == sorted(x for _, x, _ in out) and set(x for _, x, _ in out) == set(want)
    for (_, a, _), (_, b, k) in zip(out, out[1:]):
        assert a[:k] == b[:k] and (a == b or k == min(len(a), len(b)) or a[k] != b[k])
