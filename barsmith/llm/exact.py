"""Exact deduplication through a persistent digest index.

The index is a bucketed table: one row per digest and delivery, bucketed and
sorted by the digest. A delivery is summarised per digest (combined before the
shuffle, so a text that a third of the rows share costs one row a task), met
with the index by a sort-merge anti-join that leaves the digests never seen
before, and appended. Digests seen before are appended as further entries, so
that the number of copies and the row that stays are exact over all
deliveries. Only the delivery is shuffled; the index is read where it lies.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage

#: Fixed value: the characters that do not count when texts are compared.
SPACES = " \t\n\x0b\x0c\r"
#: Digests met by broadcast hold at least one in so many rows, which bounds their number by it.
HOT_SHARE = 1000

_ENTRY = "digest binary, n_chars long, keep_id long, keep_delivery long, keep_row long, copies long, fresh boolean"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, n_chars, delivery, row) per row of ``docs``, staged in the shared folder.

    ``digest`` is the SHA-256 of the text without white space, ``n_chars`` the
    code points of the original text; a null text counts as empty. (delivery,
    row) tells rows apart that are equal in every column. Very long texts are
    hashed whole; other columns are not read, whatever their names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return stage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.translate(text, SPACES, "").cast("binary"), 256)).alias("digest"),
        F.length(text).cast("long").alias("n_chars"),
        F.lit(time.time_ns()).alias("delivery"), F.monotonically_increasing_id().alias("row")), "digests")


class DigestIndex:
    """Digests of all texts delivered so far, in ``path`` (a shared folder); opened again by its path.

    Of equal texts the longest original stays, then the smallest doc_id (a
    missing one last), then the earliest delivery and row: exactly one of
    repeated rows.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        try:
            self.buckets = spark.read.schema("buckets int").parquet(f"{self.path}/settings").first()[0]
        except AnalysisException:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.parquet(f"{self.path}/settings")
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} ({_ENTRY}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                  f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/entries'")

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, delivery: DataFrame) -> None:
        """Append the rows of :func:`digests` (or a part of them) to the index."""
        best = F.max(F.struct("n_chars", F.expr("~doc_id").alias("id"), F.expr("-delivery").alias("delivery"), F.expr("-row").alias("row")))
        # staged, or the optimiser would push the joins below the aggregate and meet the index row by row
        summary = stage(delivery.groupBy("digest").agg(best.alias("best"), F.count("*").alias("copies")), "summary")
        known = self.entries().where("fresh").select("digest").hint("merge")
        rows = (summary.join(known, "digest", "left_anti").withColumn("fresh", F.lit(True))
                .unionByName(summary.join(known, "digest", "left_semi").withColumn("fresh", F.lit(False))))
        (rows.repartition(self.buckets, "digest")
         .selectExpr("digest", "best.n_chars", "~best.id AS keep_id", "-best.delivery AS keep_delivery", "-best.row AS keep_row", "copies", "fresh")
         .write.insertInto(self.table))

    def totals(self) -> DataFrame:
        """(digest, keep_id, keep_delivery, keep_row, copies): one row per distinct text, aggregated without a shuffle."""
        best = F.max(F.struct("n_chars", F.expr("~keep_id").alias("id"), F.expr("-keep_delivery").alias("delivery"), F.expr("-keep_row").alias("row")))
        return (self.entries().groupBy("digest").agg(best.alias("best"), F.sum("copies").alias("copies"))
                .selectExpr("digest", "~best.id AS keep_id", "-best.delivery AS keep_delivery", "-best.row AS keep_row", "copies"))

    def decide(self, delivered: DataFrame) -> DataFrame:
        """(doc_id, keep_id, group_size, kept, digest) per row of ``delivered``, all of whose rows were added.

        The digests of at least one in HOT_SHARE rows, at most HOT_SHARE of
        them, meet their rows by broadcast, so that no task gets all copies of
        one text; the others by a sort-merge join.
        """
        totals = self.totals()
        every = self.entries().agg(F.sum("copies")).first()[0] or 0
        at = max(2, -(-every // HOT_SHARE))
        hot = F.broadcast(totals.where(F.col("copies") >= at))
        both = (delivered.join(hot, "digest")
                .unionByName(delivered.join(hot.select("digest"), "digest", "left_anti")
                             .join(totals.where(F.col("copies") < at).hint("merge"), "digest")))
        return both.select("doc_id", "keep_id", F.col("copies").alias("group_size"),
                           F.expr("row = keep_row AND delivery = keep_delivery").alias("kept"), "digest")
