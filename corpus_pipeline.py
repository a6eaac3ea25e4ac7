"""A training corpus from ``documents``: five stages, each one operator of ``barsmith.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows its
predecessor kept; all but the last return the columns of ``docs``. Null and
empty texts, null doc_ids, repeated rows, ties, empty tables and extra columns
pass as the operators define; extra columns of any name are carried along, and
very long texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm.bpe import round_trip
from barsmith.llm.common import ship, stage, table
from barsmith.llm.mixing import mix
from barsmith.llm.quality import classify
from barsmith.llm.queries import BYTE_VOCABULARY, vocabulary
from barsmith.llm.simhash import simhash_components
from barsmith.llm.substring import remove_repeats


def _others(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c not in ("doc_id", "text"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of low quality go."""
    ship(spark)
    own = {c: f"d_{i}" for i, c in enumerate(docs.columns)}
    named = docs.withColumnsRenamed(own)
    scored = classify(named, table(spark, sf_dir, "labels"), id_col=own["doc_id"], text_col=own["text"], carry=tuple(own.values()))
    return scored.where("predicted = 1").select(*[F.col(v).alias(c) for c, v in own.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays; of rows of the
    group that repeat it, one. Rows without a doc_id are in no group and stay."""
    ship(spark)
    given = docs.where("doc_id IS NOT NULL")
    if given.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        # rows that share a doc_id may be unrelated: each is judged under a number of its own
        names = [f"d_{i}" for i in range(len(docs.columns))]
        own = dict(zip(docs.columns, names))
        rows = stage(given.toDF(*names).select(F.monotonically_increasing_id().alias("row"), "*"), "pipeline-rows")
        found = simhash_components(rows, shingle=4, max_bits=4, id_col="row", text_col=own["text"])
        best = found.withColumnRenamed("doc_id", "row").join(rows.select("row", F.col(own["doc_id"]).alias("id")), "row").groupBy(
            "component_id").agg(F.min(F.struct("id", "row")).alias("first")).select("first.row")
        kept = rows.join(best.hint("merge"), "row", "left_semi").drop("row").toDF(*docs.columns)
    else:
        found = simhash_components(docs, shingle=4, max_bits=4)
        first = stage(found.where("doc_id = component_id").select(F.col("doc_id").alias("first_")), "pipeline-first")
        # merge: the same plan at every size, whether or not the ids would fit a broadcast
        kept = docs.join(first.hint("merge"), docs.doc_id == F.col("first_"), "left_semi")
    return kept.unionByName(docs.where("doc_id IS NULL"))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 35 words that occur elsewhere go; ``n_chars`` follows the text."""
    ship(spark)
    cut = remove_repeats(docs.withColumnsRenamed({c: f"d_{c}" for c in _others(docs)}), window=35,
                         carry=tuple(f"d_{c}" for c in _others(docs)))
    keep = {c: F.col(c) if c in ("doc_id", "text") else F.col(f"d_{c}") for c in docs.columns}
    if "n_chars" in keep:
        kind = docs.schema["n_chars"].dataType
        keep["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("d_n_chars"))
    return cut.select(*[v.alias(c) for c, v in keep.items()])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by the square root of their size, as many rows as documents expected; copies are rows, in random order."""
    ship(spark)
    mixed = mix(docs, power=0.5, seed=42)
    return mixed.select(*[f"`{c}`" for c in mixed.columns[:-2]])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's text (little-endian unsigned 32-bit), and digests of the ids and of the decoded text."""
    ship(spark)
    path = vocabulary(BYTE_VOCABULARY)
    return round_trip(docs, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("substrings", substrings), ("mixture", mixture),
          ("tokens", tokens)]

#: Fingerprints, the trained model and the token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
