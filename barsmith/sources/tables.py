"""Report tables: overwrite sink, partitioned sink, read-back and verification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows per output file at most.
MAX_RECORDS_PER_FILE = 5_000_000


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def write_signals(df: DataFrame, target: str, files: int | None = None,
                  partition_by: Sequence[str] | None = None,
                  max_records_per_file: int = MAX_RECORDS_PER_FILE, fmt: str = "parquet",
                  replace: str = "all") -> None:
    """Overwrite ``target`` (a path, or a catalog table name) with ``df``.

    ``replace="partitions"`` replaces only the partitions that ``df`` has rows
    of: a day that is run again leaves the other days alone, and a run that
    fails leaves all of them. The target's partition columns must be
    ``partition_by``; a target that is not there yet is created.

    Array columns are dropped first (the report is flat). By default the
    rows are rebalanced: adaptive execution merges small and splits large
    partitions to its advisory size, within each directory when
    ``partition_by`` is given, so a hot directory gets several writers and
    files follow the size of the data. ``files=n`` instead narrows the frame
    with ``coalesce(n)``: no shuffle, at most n files, for small reports.
    """
    if replace not in ("all", "partitions"):
        raise ValueError("replace is 'all' or 'partitions'")
    if replace == "partitions" and not partition_by:
        raise ValueError("replacing partitions needs partition_by")
    flat = df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)])
    by = [F.col(c) for c in partition_by or ()]
    if files is not None and not by:
        out = flat.coalesce(files)
    else:
        out = flat.hint("rebalance", *by)
    writer = out.write.mode("overwrite").format(fmt).option("maxRecordsPerFile", max_records_per_file)
    if by:
        writer = writer.partitionBy(*partition_by)
    if replace == "partitions":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if _is_path(target):
        writer.save(target)
    elif replace == "partitions" and df.sparkSession.catalog.tableExists(target):
        # by position, in the table's order; not partitionBy, the table knows its partitions
        columns = df.sparkSession.table(target).columns
        (out.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", max_records_per_file).insertInto(target))
    else:
        writer.saveAsTable(target)


def read_signals(spark: SparkSession, target: str, schema: T.StructType | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """Read a written report back, from a catalog table or a path.

    Passing the written ``schema`` keeps partition columns typed as written
    (no inference of directory values) and in the original column order; a
    catalog table knows its types, so there it sets the order.
    """
    if _is_path(target):
        reader = spark.read.format(fmt)
        df = (reader.schema(schema) if schema is not None else reader).load(target)
    else:
        df = spark.table(target)
    return df.select(*schema.fieldNames()) if schema is not None else df


def verify_write(written: DataFrame, max_files: int | None = None) -> DataFrame:
    """One row: rows read back and distinct files behind them.

    With ``max_files`` a boolean ``files_within_limit`` takes the place of
    ``files``, for targets whose exact file count depends on the machine.
    """
    out = written.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.col("_metadata.file_path")).alias("files"),
    )
    if max_files is not None:
        out = out.select("rows", (F.col("files") <= F.lit(max_files)).alias("files_within_limit"))
    return out
