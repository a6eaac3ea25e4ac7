from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

from barsmith.llm import alignment  # noqa: E402
from barsmith.llm.alignment import _pack, _unpack, align, spill  # noqa: E402
from barsmith.llm.bpe import byte_letters  # noqa: E402
from barsmith.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY, op13_alignment, vocabulary  # noqa: E402

LETTERS = [*"abc ABC.,'éÜßσς123½²  漢字かな😀👍̈éİŉ", " the", "ing", " and", "ation", "<|endoftext|>", "</s>", "<unk>", "<0x41>", "\n", "▁"]


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per text, pair by pair."""
    lib = tokenizers.Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    lib.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_VOCABULARY))
    letters = byte_letters()

    def raw_b(i):
        s = piece.id_to_piece(i)
        return bytes([int(s[3:-1], 16)]) if piece.is_byte(i) else s.replace("▁", " ").encode()

    out, docs_of = [], defaultdict(set)
    for k, t in enumerate(texts):
        a = lib.encode(" " + t, add_special_tokens=False).ids if t else []
        b = piece.encode(t) if t else []
        ra = [bytes(letters[c] for c in lib.id_to_token(i)) for i in a]
        rb = [raw_b(i) for i in b]
        if not t or b"".join(ra) != (" " + t).encode() or b"".join(rb) != (" " + t).encode():
            out.append(None)
            continue
        ea, eb = np.cumsum([len(x) for x in ra]).tolist(), np.cumsum([len(x) for x in rb]).tolist()
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b))
                 if max(ea[i] - len(ra[i]), eb[j] - len(rb[j])) < min(ea[i], eb[j])]
        cuts = sorted(set(ea) & set(eb))
        groups, last = [], 0
        for c in cuts:
            groups.append(",".join(str(x) for x, e in zip(a, ea) if last < e <= c) + "|" + ",".join(str(x) for x, e in zip(b, eb) if last < e <= c))
            last = c
        for p in links:
            docs_of[p].add(k)
        out.append((len(a), len(b), len(cuts), links, ";".join(groups)))
    high = Counter()
    for (a, _), d in docs_of.items():
        high[a] = max(high[a], len(d))
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (*r[:3], len(r[3]), sum(len(docs_of[p]) == high[p[0]] for p in r[3]), sum(len(docs_of[p]) for p in r[3]), r[4]) for r in out]


def texts(n, seed=4):
    rnd = random.Random(seed)
    own = [None, "", " ", "  two  spaces ", "same text here", "same text here", "x" * 900, "\ttab", "ends ", "▁", "<s>", "ﬁne ﬁ", "a\u0000b"]
    return own + ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "b", "d", 7, "g") for i, t in rows], "doc_id long, text string, block string, doc string, n_a int, groups string")


@pytest.mark.parametrize("block_docs, page, parts", [(1 << 16, 1 << 13, 5), (7, 3, 3), (1, 1, 1)])
def test_alignment_equals_brute_force(spark, block_docs, page, parts):
    t = texts(120 if page > 1 else 25)
    rows = [(None if k == 4 else 3 if k < 3 else k, x) for k, x in enumerate(t)]
    got = align(frame(spark, rows).repartition(3), vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_VOCABULARY), parts=parts,
                block_docs=block_docs, page=page)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    want = [(i, *w) for (i, _), w in zip(rows, brute(t))]
    assert sum(w[1] > 0 for w in want) > len(want) // 3 and sum(w[1] == 0 for w in want) > 4
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_query_digests_hot_pairs_and_empty_table(spark, tmp_path):
    t = ["the same words again"] * 400 + ["the other words"] * 5 + texts(60, 9)
    rows = list(enumerate(t))
    frame(spark, rows).repartition(4).write.parquet(f"{tmp_path}/some/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in op13_alignment(spark, f"{tmp_path}/some").collect()}
    for (i, _), w in zip(rows, brute(t)):
        assert got[i] == (*w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "")
    frame(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op13_alignment(spark, f"{tmp_path}/none").count() == 0


def test_a_very_long_text(spark):
    rnd = random.Random(1)
    words = ["stone", "water", "falling", "naïve", "übermut", "12", "x"]
    t = " ".join(rnd.choice(words) for _ in range(250_000))
    r = align(frame(spark, [(1, t), (2, "stone water")]), vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_VOCABULARY), parts=4,
              groups=alignment.F.length("groups").cast("string")).collect()
    long = next(x for x in r if x.doc_id == 1)
    piece = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_VOCABULARY))
    assert long.n_b == len(piece.encode(t)) and long.n_links >= max(long.n_a, long.n_b) and long.n_best >= 250_000 > 0
    assert long.n_links == long.n_a + long.n_b - long.n_groups


def test_runs_are_sorted_parts_of_bounded_pages(spark):
    rows = spill(frame(spark, list(enumerate(texts(300)))).coalesce(1), vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_VOCABULARY), parts=6).where("part IS NOT NULL").collect()
    seen = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.part, r.page)):
        a, b, n = _unpack(r.pairs)
        docs, doc, times = _unpack(r.members)
        assert set((a % 6).tolist()) == {r.part} and (n == docs).all() and docs.sum() == len(doc) == len(times)
        seen[r.part] += list(zip(a.tolist(), b.tolist()))
    assert len(seen) == 6 and all(s == sorted(set(s)) for s in seen.values())


def test_pack_round_trip():
    for c in ([], [5], [3, 1, 2**31, 0], [2**40, 7, 2**62]):
        back = _unpack(_pack(np.array(c, np.int64), np.array([1, 2], np.int64)))
        assert back[0].tolist() == c and back[1].tolist() == [1, 2]
