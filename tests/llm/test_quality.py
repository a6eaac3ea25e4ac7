from __future__ import annotations

import zlib

import numpy as np

from barsmith.llm.quality import FEATURES, Model, classify, feature_table, features
from barsmith.llm.queries import op6_quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op6_quality(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.5).astype(int)).all()
    both = got[got.held_out].merge(labels, on="doc_id")
    assert (both.predicted == both.quality).mean() > 0.95
    good, bad = both.score[both.quality == 1], both.score[both.quality == 0]
    assert (good.to_numpy()[:, None] > bad.to_numpy()[None]).mean() > 0.97


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    a = {r.doc_id: r.score for r in classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in classify(docs, other).collect()}
    assert a == b


def test_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = np.zeros((4000, len(FEATURES)))
    x[:, :4] = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    m = Model(x, y)
    assert (0, 1) in m.pairs and ((m.score(x) > 0.5) == y).mean() > 0.9


def test_edge_cases(spark):
    schema = "doc_id long, text string, x string, score int"
    df = spark.createDataFrame([(1, None, "a", 1), (1, None, "a", 1), (None, "", None, None), (3, "word " * 50000, "", 0)], schema)
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = sorted(classify(df, labels, carry=("x", "score")).collect(), key=str)
    assert len(got) == 4 and got[0].asDict().keys() >= {"doc_id", "held_out", "score", "predicted", "x"}
    assert classify(df.limit(0), labels.limit(0)).count() == 0
    assert classify(df, labels.limit(0)).select("score").distinct().first().score == 0.5
    assert features(b"") == [0.0] * len(FEATURES) and feature_table(df).count() == 4


def test_common_word_counts_every_word():
    text = b"a b c d e f g h " + b"repeated " * 92
    assert features(text)[FEATURES.index("common_word")] == 0.92
