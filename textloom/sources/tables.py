"""Parquet table access with input balancing.

Text cleaning is CPU-bound per row.  A scan yields one task per parquet row
group, so a file with few row groups puts all regex work on one core.
``balance`` spreads such input round-robin over the cluster's cores, and only
then: on a cluster reading many splits it is a no-op and adds no shuffle.
"""

from __future__ import annotations

import os
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def _local_path(p: str) -> str | None:
    u = urlparse(p)
    if u.scheme in ("", "file"):
        return u.path if u.scheme == "file" else p
    return None


def scan_splits(df: DataFrame, enough: int | None = None) -> int | None:
    """Number of parquet row groups behind ``df`` (local files only; driver
    reads footers, no data).  Stops counting once ``enough`` is reached; None
    for non-local storage (where the scan is assumed to be split finely)."""
    try:
        import pyarrow.parquet as pq
    except ImportError:  # pragma: no cover
        return None
    total = 0
    for f in df.inputFiles():
        lp = _local_path(f)
        if lp is None or not os.path.exists(lp):
            return None
        total += pq.ParquetFile(lp).metadata.num_row_groups
        if enough is not None and total >= enough:
            break
    return total


def balance(df: DataFrame, min_splits: int | None = None) -> DataFrame:
    spark = df.sparkSession
    target = min_splits or spark.sparkContext.defaultParallelism
    n = scan_splits(df, enough=target)
    if n is not None and n < target:
        return df.repartition(target)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
               balanced: bool = True) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return balance(df) if balanced else df
