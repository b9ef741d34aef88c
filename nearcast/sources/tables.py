"""Driver-table loader (Parquet) and mart read with fallback."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearcast.session import path_exists

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; zone-less Parquet timestamps become UTC instants.

    The files carry no zone, so Spark reads ``timestamp_ntz``; with the
    session clock pinned to UTC the cast keeps the wall-clock value and makes
    it a comparable instant for interval arithmetic and ``to_utc_timestamp``.
    The cast is a projection, so column pruning and filter pushdown still
    reach the scan.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    casts = [F.col(f.name).cast("timestamp").alias(f.name)
             if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
             for f in df.schema.fields]
    return df.select(*casts)


def register_all(spark: SparkSession, sf_dir: str) -> None:
    """Register every driver table as a temp view of the same name."""
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            load(spark, sf_dir, t).createOrReplaceTempView(t)


def read_mart(spark: SparkSession, path: str | None, recompute=None) -> DataFrame:
    """Mart read: Parquet extract if present, else recompute the plan."""
    if path and path_exists(spark, path):
        return spark.read.parquet(path)
    if recompute is None:
        raise FileNotFoundError(path)
    return recompute()
