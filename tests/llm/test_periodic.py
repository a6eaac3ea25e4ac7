from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barsmith.llm.periodic import find_runs, periodic_runs, with_planted_runs
from barsmith.llm.queries import op12_periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, min_length=6, e=4):
    """All maximal runs, period by period; a period that a smaller one divides away is not the smallest."""
    out = []
    for q in range(1, len(w) // e + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i + q - start
            smaller = any(all(w[k] == w[k + r] for k in range(start, start + length - r)) for r in range(1, q))
            if length >= max(min_length, e * q) and not smaller:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return [x for k, x in enumerate(w) if k not in gone]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4), st.integers(1, 9), st.integers(4, 6))
def test_runs_equal_brute_force(docs, least, e):
    docs = [d * 5 if i % 2 else d for i, d in enumerate(docs)]
    flat = np.array([x for d in docs for x in d], np.int64)
    got = list(zip(*(x.tolist() for x in find_runs(flat, np.array([len(d) for d in docs]), least, e))))
    want, at = [], 0
    for d in docs:
        want += [(s + at, n, q) for s, n, q in brute(d, least, e)]
        at += len(d)
    assert got == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(0, 200), st.lists(st.integers(0, 3), max_size=20))
def test_long_periods(root, extra, around):
    w = around + (root * 30)[:4 * len(root) + extra] + around[::-1]
    got = list(zip(*(x.tolist() for x in find_runs(np.array(w), np.array([len(w)])))))
    assert got == brute(w)


def planted(i, text):
    w = WORD.findall(text or "")
    if i is None or not w:
        return w
    h = zlib.crc32(str(i).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (k - a) % p] for k in range(a, n)]


def test_query_equals_brute_force(spark, tmp_path):
    rnd = np.random.RandomState(3)
    rows = [(None, None), (1, None), (2, ""), (3, " \t\n "), (4, "a a a a a a"), (5, "a a a a a"), (5, "a a a a a"), (None, "x y " * 9),
            (6, "ab a b a b a b a b a b a b"), (7, "a b a b a b a b c c c c c c a b a b a b a b"), (8, "z " * 50_000)]
    rows += [(i, " ".join(f"w{x}" for x in rnd.randint(0, 2 + i % 40, rnd.randint(0, 160)))) for i in range(10, 400)]
    schema = "doc_id long, text string, runs string, n_words int, words string, n string, h int"
    spark.createDataFrame([(i, t, "r", 1, "w", "n", 2) for i, t in rows], schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op12_periodic(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t in rows:
        w = planted(i, t)
        runs = brute(w) if i != 8 else [(0, len(w), 1)] if len(set(w)) == 1 else None
        best = None
        for r in runs:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(collapsed(w, runs)))))
    assert got == sorted(want, key=str)
    assert sum(r[1] > 0 for r in got) > 30


def test_operator_output_empty_table_and_limits(spark):
    df = spark.createDataFrame([(1, "a b c c c c c c d")], "doc_id long, text string")
    r = periodic_runs(df).first()
    assert [tuple(x) for x in r.runs] == [(2, 6, 1)] and r.collapsed == "a b c d" and r.n_words == 9
    assert periodic_runs(df.limit(0)).count() == 0 and with_planted_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(df, min_exponent=3)


def test_very_long_text(spark):
    w = ["w%d" % (k % 700) for k in range(400_000)]
    df = spark.createDataFrame([(1, "head " + " ".join(w) + " tail"), (2, "a b")], "doc_id long, text string")
    r = {x.doc_id: x for x in periodic_runs(df).collect()}
    assert [tuple(x) for x in r[1].runs] == [(1, 400_000, 700)] and r[2].collapsed == "a b"
    assert r[1].collapsed == " ".join(["head", *w[:700], "tail"])
