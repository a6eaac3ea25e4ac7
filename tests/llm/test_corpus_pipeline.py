from __future__ import annotations

import hashlib
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
tokenizers = pytest.importorskip("tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from barsmith.llm.common import min_links, roots  # noqa: E402
from barsmith.llm.mixing import rates  # noqa: E402
from barsmith.llm.queries import BYTE_VOCABULARY, vocabulary  # noqa: E402
from barsmith.llm.simhash import fingerprint  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = corpus_pipeline.quality(spark, docs, SF).cache()
    assert kept.columns == docs.columns and set(rows_of(kept)) <= set(rows_of(docs))
    ids = {r.doc_id for r in kept.collect()}
    right = [(i in ids) == bool(y) for i, y in labels.items()]
    assert sum(right) / len(right) > 0.95

    first = corpus_pipeline.near_duplicates(spark, kept, SF).cache()
    have = sorted(rows_of(kept), key=lambda r: r[0])
    fp = [fingerprint((r[1] or "").encode()) for r in have]
    parent = np.arange(len(have))
    for i in range(len(have)):
        near = np.array([j for j in range(len(have)) if (fp[i] ^ fp[j]).bit_count() <= 4])
        min_links(np.full(len(near), i), near, parent)
    assert rows_of(first) == sorted((have[i] for i in set(roots(parent))), key=str)

    cut = corpus_pipeline.substrings(spark, first, SF).cache()
    words = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", r.text) for r in first.collect()}
    seen = Counter(tuple(w[i:i + 35]) for w in words.values() for i in range(len(w) - 34))
    for r in cut.collect():
        w, gone = words[r.doc_id], set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i:i + 35])] > 1:
                gone.update(range(i, i + 35))
        assert r.text.split() == [x for i, x in enumerate(w) if i not in gone] and (not gone or r.n_chars == len(r.text))

    mixed = corpus_pipeline.mixture(spark, cut, SF).cache()
    assert mixed.columns == docs.columns and set(rows_of(mixed)) <= set(rows_of(cut))
    want = sum(r.rate * r.n for r in rates(cut).collect())
    assert abs(mixed.count() - want) < 6 * want ** 0.5

    lib = tokenizers.Tokenizer.from_file(vocabulary(BYTE_VOCABULARY))
    got = corpus_pipeline.tokens(spark, mixed, SF).collect()
    text = {r.doc_id: r.text for r in mixed.collect()}
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in mixed.collect())
    for r in got:
        ids = lib.encode(text[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_edge_cases_through_all_stages(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, component_id long, kept string"
    rows = [(1, None, None, None, None, 1, "a"), (2, "", "en", "s", 0, 2, None), (2, "", "en", "s", 0, 2, None),
            (None, "hello there", "en", None, 11, None, None), (5, "word " * 40000, "en", "t", 200000, 1, "x")]
    df = spark.createDataFrame(rows, schema)
    for given in (df, df.limit(0)):
        docs = given
        for name, step in corpus_pipeline.STAGES[1:]:
            out = step(spark, docs, SF)
            assert out.columns == docs.columns or name == "tokens"
            docs = out.cache()
            docs.count()
    out = corpus_pipeline.quality(spark, df, SF)
    assert out.columns == df.columns and out.count() <= 5
    assert corpus_pipeline.quality(spark, df.limit(0), SF).count() == 0
