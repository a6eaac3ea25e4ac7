from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from barsmith.llm.substring import COVERS, Words, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def corpus(seed=0, n=80):
    rng = np.random.default_rng(seed)
    draw = lambda k: [f"w{x}" for x in rng.integers(0, 500, k)]
    passages = [draw(int(k)) for k in rng.integers(20, 90, 6)]
    rows = []
    for i in range(n):
        w = draw(int(rng.integers(0, 60)))
        for _ in range(int(rng.integers(0, 3))):
            p = list(passages[int(rng.integers(6))])
            if rng.random() < 0.4:
                p[int(rng.integers(len(p)))] = "edit"
            w += p + draw(int(rng.integers(0, 10)))
        seps = rng.choice([" ", "\n", "  ", "\t"], len(w))
        rows.append((i, "".join(a + b for a, b in zip(w, seps))))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "the same " * 200)]


@pytest.mark.parametrize("window,period", [(35, None), (35, 13), (10, None), (3, 1)])
def test_matches_brute_force(spark, window, period):
    rows = corpus(window)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = remove_repeats(df, window, period).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(rows, window)
    for r in got:
        assert WORD.findall(r.text) == r.kept.split(" ") if r.kept else not WORD.findall(r.text)
        assert r.n_removed or r.text == (dict(rows)[r.doc_id] or "")


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    text = " ".join(f"ü{i}" for i in range(40))
    rows = [(1, text, 1, "x"), (1, text, 2, "y"), (None, "a b", 3, "z"), (None, None, 4, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, found string")
    got = sorted(map(tuple, remove_repeats(df, carry=("row", "found")).collect()), key=str)
    assert got == sorted([(1, 40, 40, "", "", 1, "x"), (1, 40, 40, "", "", 2, "y"), (None, 2, 0, "a b", "a b", 3, "z"),
                          (None, 0, 0, "", "", 4, "z")], key=str)
    assert remove_repeats(df.limit(0)).count() == 0


def test_covers_have_every_difference():
    for v, d in COVERS.items():
        assert {(a - b) % v for a in d for b in d} == set(range(v))


def test_words_part_at_text_ends():
    data = np.frombuffer("ab cdef  g".encode(), np.uint8)
    w = Words(data, np.array([0, 4, 4, 10]))
    assert [data[s:e].tobytes() for s, e in zip(w.start, w.end)] == [b"ab", b"c", b"def", b"g"]
    assert w.first.tolist() == [0, 2, 2, 4]
