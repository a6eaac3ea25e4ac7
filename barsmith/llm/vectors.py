"""Blocks of vectors, shared by the embedding operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(v: str) -> str:
    """SQL: the array is not null and holds finite numbers only."""
    return (f"coalesce({v} IS NOT NULL AND size({v}) > 0 AND forall({v}, x -> x IS NOT NULL AND NOT isnan(x) "
            f"AND abs(x) < double('infinity')), false)")


def deal(df: DataFrame, key: str, rows: int, name: str = "block") -> tuple[DataFrame, int]:
    """Deal rows into blocks of about ``rows`` rows by a hash of ``key``; the number of blocks follows the row count."""
    n = max(1, -(-df.count() // rows))
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(n)).cast("int")), n


def matrix(column: pd.Series, dtype: str = "float64") -> np.ndarray:
    return np.array([np.asarray(v) for v in column], dtype)
