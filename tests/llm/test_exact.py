from __future__ import annotations

import hashlib
import re

from barsmith.llm.exact import DigestIndex, digests
from barsmith.llm.queries import op11_exact
from barsmith.session import staging_path

SCHEMA = "doc_id long, text string, digest int, row string, copies string, keep_id long"
ROWS = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a b"), (5, "ab"), (6, "a  b "), (7, "a b"), (8, "a b c"), (8, "a b c"), (8, "abc"),
        (None, "abc"), (None, "lone"), (9, "é"), (10, "é"), (11, "x y" * 400_000), (12, "xy" * 400_000), (13, "😀 a"), (14, "a"), (15, "A"),
        (16, "\U0001f600a "), (-9223372036854775808, "a b  ")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r", "c", 5) for i, t in rows], SCHEMA)


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def brute(rows):
    """{normal text: (keep_id, size)}; a missing doc_id comes after all others."""
    out = {}
    for s in {normal(t) for _, t in rows}:
        of = [(-len(t or ""), i is None, i if i is not None else 0) for i, t in rows if normal(t) == s]
        best = min(of)
        out[s] = (None if best[1] else best[2], len(of))
    return out


def check(got, rows):
    want, by = brute(rows), {hashlib.sha256(normal(t).encode()).hexdigest(): normal(t) for _, t in rows}
    assert sorted((str(r.doc_id), by[r.text_sha256]) for r in got) == sorted((str(i), normal(t)) for i, t in rows)
    for r in got:
        assert (r.keep_id, r.group_size) == want[by[r.text_sha256]]
    for s, (keep, _) in want.items():
        assert [r.doc_id for r in got if r.kept and by[r.text_sha256] == s] == [keep]


def test_query_equals_brute_force(spark, tmp_path):
    frame(spark, ROWS).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    check(op11_exact(spark, str(tmp_path)).collect(), ROWS)


def test_hot_group_and_empty_table(spark, tmp_path):
    rows = [(i, "hot text" + " " * (i % 3)) for i in range(3000)] + [(i, f"t{i // 2}") for i in range(3000, 6000)]
    frame(spark, rows).repartition(6).write.parquet(f"{tmp_path}/hot/documents.parquet")
    check(op11_exact(spark, f"{tmp_path}/hot").collect(), rows)
    frame(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op11_exact(spark, f"{tmp_path}/none").count() == 0


def test_index_persists_and_later_deliveries_meet_it(spark):
    path = staging_path(spark, "index-test")
    first = digests(frame(spark, ROWS[:9]))
    DigestIndex(spark, path, buckets=3).add(first)
    again = DigestIndex(spark, path)
    assert again.buckets == 3
    second = digests(frame(spark, ROWS[9:] + ROWS[:2]))
    again.add(second)
    rows = ROWS + ROWS[:2]
    both = again.decide(first.unionByName(second)).selectExpr("*", "lower(hex(digest)) AS text_sha256").collect()
    check(both, rows)
    fresh = again.entries().where("fresh")
    assert fresh.count() == fresh.select("digest").distinct().count() == len(brute(rows))
    once = DigestIndex(spark, path)
    assert once.totals().count() == len(brute(rows))


def test_anti_join_is_a_merge_over_the_buckets(spark):
    index = DigestIndex(spark, staging_path(spark, "index-plan"))
    rows = digests(frame(spark, ROWS))
    index.add(rows)
    known = index.entries().where("fresh").select("digest").hint("merge")
    plan = rows.groupBy("digest").count().join(known, "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan
