from __future__ import annotations

import numpy as np
import pytest

from barsmith.llm.common import components, min_links, roots
from barsmith.llm.simhash import allocate, fingerprint, simhash_components
import xxhash


def slow_fingerprint(text: str, k: int = 4) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", " \n", "One", "A b C", "a b c d", "Ärger ÄRGER x y z\x0bq w e", "x " * 5000])
def test_fingerprint_matches_definition(text):
    assert fingerprint(text.encode()) == slow_fingerprint(text)


def brute(ids, fps, tau):
    parent = np.arange(len(ids))
    for i in range(len(ids)):
        j = np.array([j for j in range(len(ids)) if bin(fps[i] ^ fps[j]).count("1") <= tau])
        min_links(np.full(len(j), i), j, parent)
    return {ids[i]: ids[r] for i, r in enumerate(roots(parent))}


@pytest.mark.parametrize("m", [None, 2, 3, 4])
def test_components_match_brute_force(spark, m):
    rng = np.random.default_rng(3)
    rows, words = [], [f"w{i}" for i in range(400)]
    for i in range(60):
        base = list(rng.choice(words, 60))
        for _ in range(int(rng.integers(1, 5))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(60))] = str(rng.choice(words))
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000, ""), (1001, None), (1002, "x"), (1003, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in simhash_components(df, m=m).collect()}
    fps = {i: slow_fingerprint(t or "") for i, t in rows}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fps
    want = brute([i for i, _ in rows], [fps[i] for i, _ in rows], 4)
    assert {i: r.component_id for i, r in got.items()} == want


def test_null_ids_repeats_empty_and_extra_columns(spark):
    schema = "doc_id long, text string, fp string, rep int, component_id string"
    df = spark.createDataFrame([(5, "a b c", "z", 1, "q"), (5, "a b c", "z", 1, "q"), (None, "a b c", None, None, None)], schema)
    got = sorted(simhash_components(df).collect(), key=str)
    assert [(r.doc_id, r.component_id) for r in got] == [(5, 5), (5, 5), (None, None)]
    assert len({r.fingerprint for r in got}) == 1
    assert simhash_components(df.limit(0)).count() == 0


def test_thresholds_cover_and_sum(spark):
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**63, 500, dtype=np.int64)
    plan = allocate(spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(fp)], "rep long, fp long"), 4, 3)
    limits = plan.thresholds(fp.view(np.uint64))
    assert (limits.sum(axis=1) == 4 - 3 + 1).all()
    assert sorted(b for g in plan.groups for b in g) == list(range(64))


def test_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
