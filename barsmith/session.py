"""Session helpers: a test/bench session and the shared staging folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "barsmith", **conf: str) -> SparkSession:
    """Session for tests and the bench. Cluster jobs bring their own session.

    AQE stays on (runtime coalescing, skew-join splitting and the
    size-checked broadcast of small join sides); the UI is off.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BARSMITH_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and staged tables.

    Read from the session (``spark.checkpoint.dir`` / the context's
    checkpoint dir). Only a local-mode session without one gets a fresh
    scratch folder; a cluster session without one is a configuration error,
    because a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        current = tempfile.mkdtemp(prefix="barsmith-ckpt-")
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one staged table."""
    return f"{shared_dir(spark)}/barsmith-{name}-{uuid.uuid4().hex[:12]}"


def stage(df, name: str = "stage"):
    """Write a frame as Parquet into the shared folder and read it back.

    For tables read by several later stages: they read the files, pruned to
    their columns, instead of replaying the plan, and a lost executor costs
    a re-read, not a recomputation from the source. (Not
    ``localCheckpoint``: its blocks die with the executor that holds them.)
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
