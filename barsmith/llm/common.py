"""Helpers shared by the operators: inputs, staging, connected components."""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, stage  # noqa: F401

#: Rows of a block that a task expands at once.
CHUNK = 1 << 20


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application (as --py-files would)."""
    sc = spark.sparkContext
    if getattr(ship, "sent", None) != sc.applicationId:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        at = tempfile.mkdtemp(prefix="barsmith-code-")
        sc.addPyFile(shutil.make_archive(f"{at}/barsmith", "zip", os.path.dirname(package), os.path.basename(package)))
        ship.sent = sc.applicationId


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def min_links(a: np.ndarray, b: np.ndarray, parent: np.ndarray) -> None:
    """Union the node pairs (a[i], b[i]) in the forest ``parent``, in place.

    Vectorised union by smaller index: hook the larger root under the
    smaller one, then jump pointers, until no pair spans two trees.
    """
    while len(a):
        ra, rb = parent[a], parent[b]
        while True:
            ga, gb = parent[ra], parent[rb]
            if np.array_equal(ga, ra) and np.array_equal(gb, rb):
                break
            ra, rb = ga, gb
        parent[a], parent[b] = ra, rb
        apart = ra != rb
        if not apart.any():
            return
        a, b = np.minimum(ra, rb)[apart], np.maximum(ra, rb)[apart]
        np.minimum.at(parent, b, a)


def roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: (a long, b long) -> (node, component = smallest node).

    Alternating large-star and small-star rounds; each round's edge set and
    smallest neighbours are checkpointed in the shared folder, so both sides of
    a round's joins are plain shuffles: a star centre with very many leaves is
    one hot key on one side only, which the adaptive skew join splits.
    Self loops are allowed; rows with a null end are ignored.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    edges = (edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
             .checkpoint())
    before = None
    for _ in range(max_rounds):
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or seen == before:
            break
        before = seen
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m").checkpoint()
        large = (both.join(low, "a").where("b > a").selectExpr("b AS a", "m AS b")
                 .where("a <> b").distinct())
        large = large.checkpoint()
        low = large.groupBy("a").agg(F.min("b").alias("m")).checkpoint()
        small = large.join(low, "a")
        edges = (small.selectExpr("b AS a", "m AS b").unionByName(small.selectExpr("a", "m AS b"))
                 .where("a <> b").distinct().checkpoint())
    else:
        raise RuntimeError("components did not settle")
    low = edges.groupBy("a").agg(F.min("b").alias("component"))
    return (low.withColumnRenamed("a", "node")
            .unionByName(edges.selectExpr("b AS node", "b AS component").distinct()))
