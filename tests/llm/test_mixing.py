from __future__ import annotations

import math
from collections import Counter

from barsmith.llm.mixing import mix, rates, with_cdf


def docs(spark, n=4000):
    rows = [(i, f"t{i}", "a" if i % 4 else "b", "c", 3) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, copy string, __x int")


def test_rates_reach_the_budget_and_weights(spark):
    df = docs(spark)
    r = {x.source: x for x in rates(df, {"a": 1, "b": 3}, budget=8000).collect()}
    assert math.isclose(r["a"].rate * r["a"].n, 2000) and math.isclose(r["b"].rate * r["b"].n, 6000)
    out = Counter(x.source for x in mix(df, {"a": 1, "b": 3}, budget=8000).select("source").collect())
    assert abs(out["a"] - 2000) < 6 * 2000 ** 0.5 and abs(out["b"] - 6000) < 6 * 6000 ** 0.5


def test_copies_follow_the_poisson_distribution(spark):
    df = docs(spark)
    got = mix(df, {"a": 1}, budget=3000)
    assert {x.source for x in got.select("source").distinct().collect()} == {"a"}
    per = Counter(Counter(x.doc_id for x in got.select("doc_id").collect()).values())
    for k in range(1, 4):
        want = 3000 * math.exp(-1) / math.factorial(k)
        assert abs(per[k] - want) < 6 * want ** 0.5


def test_large_rate_has_a_whole_distribution(spark):
    df = spark.createDataFrame([("a", 1, 2000.0)], "source string, n long, rate double")
    cdf = with_cdf(df).first().cdf
    assert abs(cdf[-1] - 1) < 1e-9 and cdf == sorted(cdf)


def test_order_is_global_and_repeatable(spark):
    a = [(r.doc_id, r.mix_copy, r.mix_order) for r in mix(docs(spark)).collect()]
    b = [(r.doc_id, r.mix_copy, r.mix_order) for r in mix(docs(spark).repartition(5)).collect()]
    assert a == b and [x[2] for x in a] == sorted(x[2] for x in a)


def test_nulls_repeats_empty_and_columns(spark):
    schema = "doc_id long, text string, source string, rate string, n int"
    df = spark.createDataFrame([(None, None, None, "r", 1), (1, "", "a", None, None), (1, "", "a", None, None)], schema)
    got = mix(df, budget=30)
    assert got.columns == [*df.columns, "mix_copy", "mix_order"]
    n = Counter((r.doc_id, r.mix_copy) for r in got.collect())
    assert all(v == 2 for (i, _), v in n.items() if i == 1) and any(i is None for i, _ in n)
    assert mix(df.limit(0)).count() == 0
    assert mix(df, weights={}).count() == 0
