from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

from barsmith.llm import bpe, token_counts  # noqa: E402
from barsmith.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY, op2_bpe, op7_token_counts, vocabulary  # noqa: E402

LETTERS = [*"abc ABC  \n\t.,'’éÜßΣσς123½²٣ \x1c\x1f\x85　漢字かな😀👍̈éİŉ", "<|endoftext|>",
           "<|startoftext|>", "<|", "'s", "'ll", "'LL", "the", "ing", " the", "   ", " \n", "\n "]


def texts(n: int) -> list[str]:
    rnd = random.Random(5)
    own = ["", " ", "  ", "a", "x" * 3000, " " * 500, "a\n  b", "a \n b", "<|endoftext|>", "a<|endoftext|>b"]
    return own + ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_ids_equal_the_library():
    lib = tokenizers.Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    t = texts(3000)
    want = [e.ids for e in lib.encode_batch(t, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u4").tolist() for x in bpe.Encoder(vocabulary(BYTE_VOCABULARY)).encode(t)]
    assert got == want


def test_counts_equal_the_library_at_every_piece():
    lib = tokenizers.Tokenizer.from_file(vocabulary(WORD_VOCABULARY))
    t = texts(2000)
    count = token_counts.Counter(vocabulary(WORD_VOCABULARY))
    assert [(c or [0])[-1] for c in count.counts(t)] == [len(e.ids) for e in lib.encode_batch(t, add_special_tokens=False)]
    text = "Hello, wörld! it's 42 straße"
    pieces = text.split()
    want = [len(lib.encode(" ".join(pieces[:i + 1]), add_special_tokens=False).ids) for i in range(len(pieces))]
    assert next(iter(count.counts([text]))) == want
    for i, n in enumerate(count.within("don'tstopping")):
        assert n == len(lib.encode("don'tstopping"[:i], add_special_tokens=False).ids)


def test_queries_edge_cases(spark, tmp_path):
    schema = "doc_id long, text string, ids string, counts int, n_bytes string"
    rows = [(1, None, "a", 1, "z"), (2, "", "a", 1, "z"), (3, "Straße the end<|endoftext|>", None, None, None),
            (3, "Straße the end<|endoftext|>", None, None, None), (None, "x", None, None, None), (5, "word " * 9000, "", 0, "")]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    lib = tokenizers.Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    got = sorted(map(str, op2_bpe(spark, str(tmp_path)).collect()))
    want = []
    for i, t, *_ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(f"Row(doc_id={i}, n_tokens={n}, ids_sha256='{a}', decoded_sha256='{b}')" for i, n, a, b in want)
    lib = tokenizers.Tokenizer.from_file(vocabulary(WORD_VOCABULARY))
    got = sorted(map(tuple, op7_token_counts(spark, str(tmp_path)).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t, *_ in rows]
    assert got == sorted(want, key=str)
    empty = spark.createDataFrame([], schema)
    path = vocabulary(BYTE_VOCABULARY)
    assert bpe.decode(bpe.encode(empty, path), path).count() == 0 and bpe.round_trip(empty, path).count() == 0
    df = spark.createDataFrame(rows, schema)
    assert sorted(map(str, bpe.decode(bpe.encode(df, path), path).collect())) == sorted(map(str, bpe.round_trip(df, path).collect()))
    assert token_counts.prefix_counts(empty, vocabulary(WORD_VOCABULARY)).count() == 0


def test_truncation_is_a_lookup(spark):
    df = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    counted = token_counts.prefix_counts(df, vocabulary(WORD_VOCABULARY))
    assert counted.select(token_counts.pieces_within(2)).first()[0] == 2


def test_truncation_inside_a_piece(spark):
    path = vocabulary(WORD_VOCABULARY)
    lib = tokenizers.Tokenizer.from_file(path)
    size = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    own = ["漢字かな交じり文" * 40, "https://example.org/" + "a/very-long_path.html?x=1&" * 20, "x" * 300, "don't!'restop'll", "  one two  ",
           "stop!<|endoftext|>'ll<|endoftext|><|startoftext|>go", "e\u0301te\u0301're\u0301 \u1112\u1161\u11ab\u1100\u1173\u11af",
           "\u0e01\u0e38\u0e48\u0e01\u0e48\u0e38", "", "İİSTRASSEß\u0958\u093c"]
    rows = [(i, t) for i, t in enumerate(own + texts(150)[10:])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    for budget in (0, 1, 3, 7, 20):
        for r in token_counts.truncate(df, path, budget).collect():
            text = rows[r.doc_id][1]
            fits = [i for i in range(len(text) + 1) if size(text[:i]) <= budget]
            want = text if fits[-1] == len(text) else text[:fits[-1]]
            assert r.n_tokens == size(text) and r.kept_tokens == size(r.kept) <= budget
            assert text.startswith(r.kept) and r.kept.strip() == want.strip()


def test_counts_at_every_prefix_take_one_walk():
    count, lib = token_counts.Counter(vocabulary(WORD_VOCABULARY)), tokenizers.Tokenizer.from_file(vocabulary(WORD_VOCABULARY))
    piece, steps = "漢字e\u0301don't" * 30, []
    count.vocab.stand, stand = lambda a, b: steps.append(1) or stand(a, b), count.vocab.stand
    table = count.within(piece)
    assert table == [len(lib.encode(piece[:i], add_special_tokens=False).ids) for i in range(len(piece) + 1)]
    assert len(steps) < 20 * len(piece)
    assert next(count.counts([piece]))[-1] == table[-1]
