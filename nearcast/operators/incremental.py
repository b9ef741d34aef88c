"""Keyed delete+insert merge and windowed incremental builds.

Plain Parquet has no MERGE. A keyed merge is ``target left_anti batch_keys``
union ``batch``; written with dynamic partition overwrite it only rewrites
the partitions the batch touches. Never read and overwrite the same path in
one plan: stage the merged partitions under the shared checkpoint folder,
then overwrite the target from the staged copy.
"""

from __future__ import annotations

import math
import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearcast.session import materialize, path_exists


def keyed_merge(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Delete target rows whose key is in the batch, insert all batch rows.

    Batch duplicates survive (as in delete+insert). New batch columns are
    appended; old rows get nulls there (I2).
    """
    from nearcast.operators.dims import bounded_broadcast
    # a batch (one month) has far fewer keys than the target: broadcast them
    # behind the size check so the target is filtered in place, not shuffled
    batch_keys = bounded_broadcast(batch.select(*keys).distinct())
    kept = target.join(batch_keys, keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def replace_partitions(target: DataFrame, batch: DataFrame, part_cols: list[str]) -> DataFrame:
    """Partition reload: every target partition present in the batch is replaced."""
    from nearcast.operators.dims import bounded_broadcast
    touched = bounded_broadcast(batch.select(*part_cols).distinct())
    kept = target.join(touched, part_cols, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def write_partitions(df: DataFrame, path: str, part_cols: list[str], fmt: str = "parquet") -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are replaced.

    The commit protocol makes the replacement atomic per job (no half-loaded
    month, K20), and a task lost mid-write is simply re-run.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*part_cols).format(fmt).save(path))


def drop_partitions(spark: SparkSession, path: str, part_cols: list[str], values: list) -> None:
    """Delete partitions of a table, given by their values as text (null: the default partition)."""
    catalog = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in values:
        parts = [f"{catalog.escapePathName(c)}={catalog.DEFAULT_PARTITION_NAME() if v is None else catalog.escapePathName(v)}"
                 for c, v in zip(part_cols, row, strict=True)]
        fs, folder = _folder(spark, "/".join([path, *parts]))
        fs.delete(folder, True)


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish a publication that was cut off between its two renames: the table is absent, the old one set aside."""
    fs, table = _folder(spark, path)
    _, aside = _folder(spark, path + ".old")
    if fs.exists(aside):
        if fs.exists(table):
            fs.delete(aside, True)
        else:
            fs.rename(aside, table)


def publish_table(df: DataFrame, path: str, part_cols: list[str] | None = None) -> None:
    """Replace a whole Parquet table: written beside it, then put in its place by renames.

    A write that fails leaves the old table as it is, where an overwrite in place
    has already deleted it. ``df`` may read the table it replaces.
    """
    spark = df.sparkSession
    recover_table(spark, path)
    beside = f"{path}.next-{uuid.uuid4().hex}"
    fs, fresh = _folder(spark, beside)
    try:
        (df.write.partitionBy(*part_cols) if part_cols else df.write).parquet(beside)
    except Exception:
        fs.delete(fresh, True)
        raise
    _, table = _folder(spark, path)
    _, aside = _folder(spark, path + ".old")
    if fs.exists(table) and not fs.rename(table, aside):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(fresh, table):
        recover_table(spark, path)
        raise OSError(f"cannot publish {beside}")
    fs.delete(aside, True)
    spark.catalog.refreshByPath(path)


def merge_into_path(spark: SparkSession, path: str, batch: DataFrame, keys: list[str],
                    part_cols: list[str]) -> dict:
    """Keyed merge into a partitioned Parquet table at ``path``.

    The partitions that the batch or its keys touch are merged, staged and
    rewritten. Returns rows before/after in the touched partitions.
    """
    if not path_exists(spark, path):
        write_partitions(batch, path, part_cols)
        return {"rows_deleted": 0, "rows_loaded": batch.count()}
    batch = materialize(batch)
    target = spark.read.parquet(path)
    # a key may stand in another partition than the batch puts it in: both are rewritten
    touched = materialize(target.join(batch.select(*keys).distinct(), keys, "left_semi").select(*part_cols)
                          .unionByName(batch.select(*part_cols)).distinct())
    current = target.join(touched, part_cols, "left_semi")
    before = current.count()
    staged = materialize(keyed_merge(current, batch, keys))
    loaded = staged.count()
    # a dynamic overwrite would leave a partition that lost its last row in place
    emptied = touched.join(staged.select(*part_cols).distinct(), part_cols, "left_anti").select(
        *[F.col(c).cast("string") for c in part_cols]).collect()  # partitions, not rows
    write_partitions(staged, path, part_cols)
    drop_partitions(spark, path, part_cols, emptied)
    return {"rows_deleted": before, "rows_loaded": loaded}


def window_months(start: str, end: str, pad_hours: float = 0.0) -> tuple[str, str]:
    """First and last 'yyyy-MM' label that rows of [start - N h, end + N h) can carry."""
    slack = timedelta(days=math.ceil(pad_hours / 24))
    first, last = date.fromisoformat(start[:10]) - slack, date.fromisoformat(end[:10]) - timedelta(days=1) + slack
    return f"{first:%Y-%m}", f"{last:%Y-%m}"


def in_months(df: DataFrame, first: str, last: str, ym_col: str = "year_month") -> DataFrame:
    """Rows labelled with one of the months, or with none; prunes a table that is partitioned by the label."""
    return df.filter(F.col(ym_col).isNull() | F.col(ym_col).between(first, last))


def window_filter(df: DataFrame, col: str, start: str | None = None, end: str | None = None, year_month: str | None = None,
                  ym_col: str = "year_month", prune: bool = True) -> DataFrame:
    """One month, else half-open [start, end) of a date column, else everything.

    With ``prune`` a date window also names the months it spans, so that only
    their partitions are read; rows must be loaded under the month of their date.
    """
    if year_month:
        return df.filter(F.col(ym_col) == F.lit(year_month))
    if start and end:
        days = df.filter((F.col(col) >= F.lit(start).cast("date")) & (F.col(col) < F.lit(end).cast("date")))
        return in_months(days, *window_months(start, end), ym_col) if prune else days
    return df


def padded_window_filter(df: DataFrame, col: str, start: str, end: str, pad_hours: float,
                         ym_col: str = "year_month", prune: bool = True) -> DataFrame:
    """[start - N h, end + N h) on the observation side of a windowed join (P10, K6); ``prune`` as above."""
    pad = int(round(pad_hours * 3600))
    lo = F.timestamp_add("SECOND", F.lit(-pad), F.lit(start).cast("timestamp"))
    hi = F.timestamp_add("SECOND", F.lit(pad), F.lit(end).cast("timestamp"))
    out = df.filter((F.col(col) >= lo) & (F.col(col) < hi))
    return in_months(out, *window_months(start, end, pad_hours), ym_col) if prune else out


def month_counts(df: DataFrame, ym_col: str = "year_month") -> DataFrame:
    """Per-month and running row counts of a monthly build."""
    from pyspark.sql import Window
    g = df.groupBy(ym_col).agg(F.count(F.lit(1)).alias("rows"))
    # one row per month: a small, bounded window
    return g.withColumn("running_rows", F.sum("rows").over(
        Window.orderBy(ym_col).rowsBetween(Window.unboundedPreceding, 0)))
