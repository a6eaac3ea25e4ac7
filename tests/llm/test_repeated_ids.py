"""Unrelated rows that share an id are judged apart, and columns of any name pass."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from barsmith.llm.mixing import mix
from barsmith.llm.simhash import simhash_components

TEXT = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abc"}


def test_components_of_rows_that_share_an_id(spark):
    rows = [(5, "a"), (5, "b"), (6, "a"), (7, "b"), (4, "c"), (8, "b")]
    df = spark.createDataFrame([(i, TEXT[k], k) for i, k in rows], "doc_id long, text string, component string")
    got = simhash_components(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.component, []).append((r.doc_id, r.component_id))
    assert sorted(sorted(x) for x in by.values()) == [[(4, 4)], [(5, 5), (6, 5)], [(5, 5), (7, 5), (8, 5)]]


def test_near_duplicates_keep_one_row_of_each_group(spark):
    rows = [(5, TEXT["a"]), (5, TEXT["b"]), (6, TEXT["a"]), (7, TEXT["b"]), (9, TEXT["c"]), (9, TEXT["c"]), (None, TEXT["a"])]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, row string, component_id int").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text[:2]) for r in kept.collect()), key=str) == [(5, "a0"), (5, "b0"), (9, "c0"), (None, "a0")]


def test_mixing_keeps_columns_of_any_name(spark):
    names = ["doc_id", "text", "source", "__mix_key", "__mix_cdf", "mix_copy", "mix_order", "d_0", "mix_n", "rate"]
    rows = [(i, "t", "s", "U", "V", "W", "X", "Y", "Z", 7) for i in range(50)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'long' if n == 'doc_id' else 'int' if n == 'rate' else 'string'}" for n in names))
    got = mix(df, budget=200)
    assert got.columns == [*names, "mix_copy_", "mix_order_"]
    out = got.collect()
    assert out and all(tuple(r)[1:10] == ("t", "s", "U", "V", "W", "X", "Y", "Z", 7) for r in out)
    order = [r[-1] for r in out]
    assert order == sorted(order)
    plain = mix(df.select("doc_id", "text", "source"), budget=200).collect()
    assert Counter((r.doc_id, r[-2], r[-1]) for r in plain) == Counter((r.doc_id, r[-2], r[-1]) for r in out)
    extra = spark.createDataFrame([(1, "t", "s", "c", "o")], "doc_id long, text string, source string, __copy string, __order string")
    kept = corpus_pipeline.mixture(spark, extra, "")
    assert kept.columns == extra.columns and all((r["__copy"], r["__order"]) == ("c", "o") for r in kept.collect())


def test_long_texts_are_mixed_whole(spark):
    long = "word " * 300_000
    got = mix(spark.createDataFrame([(1, long, "s"), (2, "", "s"), (3, None, "s")], "doc_id long, text string, source string"), budget=30).collect()
    assert {len(r.text or "") for r in got} <= {len(long), 0} and any(r.text == long for r in got)
