"""Words and windows are told apart by hashes that no pattern of letters or words defeats."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from test_ctw import brute as brute_scores
from test_substring import brute

from barsmith.llm import suffix
from barsmith.llm.ctw import score_texts
from barsmith.llm.repeats import PrimeRolling, word_hash
from barsmith.llm.substring import Words, remove_repeats


def thue_morse(n, a="a", b="b"):
    """A word of n letters (a power of two) and its complement: equal under any polynomial modulo 2^64 from 1,024 on."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return [(a, b)[x] for x in bits], [(b, a)[x] for x in bits]


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_long_words_of_a_hostile_pattern(spark, n):
    x, y = ("".join(w) for w in thue_morse(n))
    common = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{common} {x}"), (2, f"{common} {y}"), (3, f"{common} {x}")]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 35).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(rows, 35)


def test_windows_of_a_hostile_pattern(spark):
    x, y = thue_morse(2048)
    rows = [(1, " ".join(x)), (2, " ".join(y)), (3, " ".join(["c", *x]))]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 2048).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(rows, 2048)


def test_counts_of_hostile_words(spark):
    x, y = ("".join(w) for w in thue_morse(2048))
    rows = [(0, x), (2, x), (7, y), (8, "other")]  # held out: crc32(doc_id) mod 5 = 1
    docs = spark.createDataFrame(rows * 1, "doc_id long, text string")
    for r in score_texts(docs, depth=2).collect():
        want = {w[0]: w for w in brute_scores(rows, 2)}[r.doc_id]
        assert r.n_known == want[3] and abs(r.base_score - want[5]) < 1e-9, (r, want)


def test_word_hash_is_of_the_bytes_alone():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in [*range(1, 80), 64, 65, 500]] * 2
    words += [b"a", b"a\x01", b"aa", b"aaaaaaaa", b"aaaaaaaaa"]
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    end = np.flatnonzero(data == 32)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - [len(w) for w in words]
    for seed in (1, 2):
        h = word_hash(data, start, end, seed)
        assert len(set(h.tolist())) == len(set(words)) and (h[:82] == h[82:164]).all()
    assert word_hash(data, start, end, 1)[81] == xxhash.xxh64_intdigest(words[81], 1)
    assert len(word_hash(np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64), 1)) == 0


def test_prime_rolling_equals_the_polynomial():
    v = np.random.default_rng(1).integers(0, 2 ** 63, 3000).astype(np.uint64)
    p, base = (1 << 31) - 1, 0x5851F42D
    roll = PrimeRolling(v, 1)
    for s, n in [(0, 3000), (5, 1), (17, 35), (2990, 10)]:
        want = sum(int(x) % p * pow(base, i, p) for i, x in enumerate(v[s:s + n])) % p
        assert roll.hash(np.array([s]), np.array([s + n]))[0] == want


def test_whole_words_only_in_a_text():
    w = Words(np.frombuffer(b"ab c" + b"ab", np.uint8), np.array([0, 4, 6]))
    assert w.word[0] == w.word[2] != w.word[1]


def test_suffix_repeats_are_found_under_a_shared_hash(monkeypatch):
    # three strings left of one anchor, two of them equal, all under one hash
    monkeypatch.setattr(suffix, "_LEFT_BASE", np.array(0, np.uint64))
    left = np.frombuffer(b"xxxyxyxx", np.uint8).reshape(4, 2)
    shared, n_right, n_left = np.array([0, 4, 4, 4]), np.full(4, 4), np.full(4, 2)
    hit = suffix.earlier(shared, n_right, left, n_left, np.arange(4), 6, 4)
    assert hit[:, 2].tolist() == [False, False, True, True]
