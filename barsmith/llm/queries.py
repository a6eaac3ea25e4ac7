"""Registered queries op1..op13: thin wrappers with the production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path
from . import bpe, token_counts
from .alignment import align
from .common import table
from .ctw import score_texts
from .embed import embedding_components
from .exact import DigestIndex, digests
from .mixing import mix
from .periodic import periodic_runs, with_planted_runs
from .quality import classify
from .simhash import simhash_components
from .substring import remove_repeats
from .suffix import remove_earlier
from .topk import top_k

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
TOKEN_LIMIT = 2048


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the files are installed with the library on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary(BYTE_VOCABULARY)
    return bpe.round_trip(table(spark, sf_dir, "documents"), path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares proportional to the square root of a source's size, as many rows as documents."""
    return mix(table(spark, sf_dir, "documents"), power=0.5, seed=42).withColumnsRenamed(
        {"mix_copy": "copy", "mix_order": "shuffle_key"})


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_earlier(table(spark, sf_dir, "documents"), length=50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.prefix_counts(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY))
    n = token_counts.total("counts")
    return counted.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > TOKEN_LIMIT).alias("over_limit"))


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), window=35).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), every=20, k=20, scale=64)


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), depth=5)


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents arrive in two deliveries; the second meets the index of the first."""
    rows = digests(table(spark, sf_dir, "documents"))
    index = DigestIndex(spark, staging_path(spark, "digest-index"))
    for half in (0, 1):
        index.add(rows.where(F.col("row") % 2 == half))
    return index.decide(rows).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")), min_length=6, min_exponent=4)
    best = F.expr("""aggregate(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>),
        (b, r) -> CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)""")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("n_links") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return align(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_VOCABULARY),
                 groups=digest).withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_bpe": op2_bpe,
    "op3_mixing": op3_mixing,
    "op4_embeddings": op4_embeddings,
    "op5_suffixes": op5_suffixes,
    "op6_quality": op6_quality,
    "op7_token_counts": op7_token_counts,
    "op8_substring": op8_substring,
    "op9_topk": op9_topk,
    "op10_lm_scores": op10_lm_scores,
    "op11_exact": op11_exact,
    "op12_periodic": op12_periodic,
    "op13_alignment": op13_alignment,
}
