"""Idempotent reloads, backfills, run audit log, exports and inventories.

Reload = dynamic partition overwrite: re-loading a month (or station-month)
replaces exactly that partition in one committed job, so a re-run gives the
same table and a failed run leaves the old partition in place (no half-loaded
month). A backfill reads all files of the batch in one job; the per-unit
outcome is a ``groupBy`` over the loaded rows joined back to the manifest, so
a missing or unreadable unit is reported instead of stopping the rest.
"""

from __future__ import annotations

import os
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearcast.operators.incremental import write_partitions
from nearcast.session import materialize, path_exists, scratch_path

AUDIT_COLUMNS = ("run_id string, unit string, source_file string, rows_deleted long, "
                 "rows_loaded long, event_ts timestamp, status string, error_message string")


def partition_counts(spark: SparkSession, path: str, part_cols: list[str]) -> DataFrame:
    """Current row count per partition of a table (empty if the table does not exist)."""
    if not path_exists(spark, path):
        schema = ", ".join(f"{c} string" for c in part_cols) + ", rows long"
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).groupBy(*part_cols).agg(F.count(F.lit(1)).alias("rows"))


def reload_partitions(spark: SparkSession, batch: DataFrame, path: str, part_cols: list[str]) -> DataFrame:
    """Replace every partition present in ``batch`` (S9 month, S10 station-month).

    The batch is first written once to a staging table under the shared
    checkpoint folder (one read of the raw files, lineage cut); touched
    partitions, counts and the final overwrite all read the staged copy.
    Returns per touched partition: rows_deleted (rows there before) and
    rows_loaded.
    """
    stage = scratch_path(spark, f"reload-{uuid.uuid4().hex}")
    batch.write.mode("overwrite").parquet(stage)
    staged = spark.read.parquet(stage)
    loaded = staged.groupBy(*part_cols).agg(F.count(F.lit(1)).alias("rows_loaded"))
    names = [F.col(c).cast("string").alias(c) for c in part_cols]
    loaded = loaded.select(*names, "rows_loaded")
    if path_exists(spark, path):
        before = spark.read.parquet(path).select(*names).groupBy(*part_cols).agg(F.count(F.lit(1)).alias("rows_deleted"))
        outcome = loaded.join(before, part_cols, "left")
    else:
        outcome = loaded.withColumn("rows_deleted", F.lit(0).cast("long"))
    # counted before the old partitions go; written, because the counts are read after that
    outcome = materialize(outcome.select(*part_cols, F.coalesce("rows_deleted", F.lit(0)).cast("long").alias("rows_deleted"),
                                         F.col("rows_loaded").cast("long").alias("rows_loaded")))
    write_partitions(staged, path, part_cols)
    return outcome


def backfill(spark: SparkSession, manifest: DataFrame, loaded: DataFrame, unit_cols: list[str],
             path: str, part_cols: list[str], run_id: str | None = None) -> DataFrame:
    """Multi-unit backfill with failure isolation.

    ``manifest`` lists the expected units (e.g. every month, or station x
    month); ``loaded`` is the one-job scan of all their files with lineage
    columns. Units with rows are reloaded together; units without rows are
    reported ``failed``. Output: one outcome row per unit.
    """
    run_id = run_id or str(uuid.uuid4())
    counts = loaded.groupBy(*unit_cols).agg(F.count(F.lit(1)).alias("rows_in_files"))
    outcome = manifest.join(counts, unit_cols, "left")
    res = reload_partitions(spark, loaded, path, part_cols)
    outcome = outcome.join(res, [c for c in unit_cols if c in res.columns], "left")
    ok = F.coalesce(F.col("rows_in_files"), F.lit(0)) > 0
    return outcome.select(
        F.lit(run_id).alias("run_id"), *unit_cols,
        F.coalesce("rows_deleted", F.lit(0)).cast("long").alias("rows_deleted"),
        F.coalesce("rows_loaded", F.lit(0)).cast("long").alias("rows_loaded"),
        F.when(ok, "success").otherwise("failed").alias("status"),
        F.when(ok, F.lit(None)).otherwise(F.lit("no rows read for unit")).alias("error_message"))


def backfill_each(spark: SparkSession, units: list[dict[str, str]], load, path: str, part_cols: list[str],
                  stop_on_error: bool = False, run_id: str | None = None) -> DataFrame:
    """One job per unit, so that a unit that fails is recorded and the others are loaded.

    ``units`` is the manifest as a list (months, or station x month);
    ``load(unit)`` returns the unit's rows. With ``stop_on_error`` the units
    after a failed one are recorded as skipped. Same columns as ``backfill``.
    """
    run_id = run_id or str(uuid.uuid4())
    rows, stopped = [], False
    for unit in units:
        deleted, loaded, status, error = 0, 0, "skipped", "an earlier unit failed"
        if not stopped:
            try:
                done = reload_partitions(spark, load(unit), path, part_cols).agg(
                    F.sum("rows_deleted"), F.sum("rows_loaded")).first()
                deleted, loaded = done[0] or 0, done[1] or 0
                status, error = ("success", None) if loaded else ("failed", "no rows read for unit")
            except Exception as e:  # whatever a unit's files do, the run goes on and reports it
                status, error = "failed", f"{type(e).__name__}: {str(e)[:500]}"
            stopped = stop_on_error and status == "failed"
        rows.append((run_id, *unit.values(), deleted, loaded, status, error))
    columns = ", ".join(f"{c} string" for c in (units[0] if units else {}))
    return spark.createDataFrame(rows, f"run_id string, {columns}{', ' if columns else ''}rows_deleted long, rows_loaded long, "
                                       "status string, error_message string")


def backfill_summary(outcomes: DataFrame) -> dict:
    """Totals of a backfill; ``exit_code`` is 1 if any unit failed."""
    r = outcomes.agg(F.count(F.lit(1)).alias("units"), F.count_if(F.col("status") == "failed").alias("failed"),
                     F.sum("rows_loaded").alias("rows_loaded")).first()
    return {"units": r["units"], "failed": r["failed"], "rows_loaded": r["rows_loaded"] or 0,
            "exit_code": 1 if r["failed"] else 0}


def audit_event(spark: SparkSession, log_path: str, run_id: str, unit: str, status: str,
                source_file: str = "", rows_deleted: int = 0, rows_loaded: int = 0,
                error_message: str | None = None) -> None:
    """Append one run event (start ``running`` / finish ``success``/``failed``)."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    row = [(run_id, unit, source_file, rows_deleted, rows_loaded, now, status, error_message)]
    spark.createDataFrame(row, AUDIT_COLUMNS).write.mode("append").parquet(log_path)


def audit_events(spark: SparkSession, log_path: str, outcomes: DataFrame) -> None:
    """Append the outcome rows of a backfill as finish events."""
    ev = outcomes.select("run_id", F.concat_ws("/", *[c for c in outcomes.columns
                                                       if c in ("station", "year_month")]).alias("unit"),
                         F.lit("").alias("source_file"), "rows_deleted", "rows_loaded",
                         F.current_timestamp().alias("event_ts"), "status", "error_message")
    ev.write.mode("append").parquet(log_path)


def run_state(spark: SparkSession, log_path: str) -> DataFrame:
    """Current state per (run, unit): the latest event wins."""
    log = spark.read.parquet(log_path)
    latest = F.max_by(F.struct(*[c for c in log.columns if c not in ("run_id", "unit")]), "event_ts")
    return log.groupBy("run_id", "unit").agg(latest.alias("s")).select("run_id", "unit", "s.*")


def issues(spark: SparkSession, log_path: str) -> DataFrame:
    """One timestamped line per failed unit."""
    st = run_state(spark, log_path).filter(F.col("status") == "failed")
    return st.select("event_ts", "run_id", "unit",
                     F.concat_ws(" ", F.lit("FAILED"), "unit", F.coalesce("error_message", F.lit(""))).alias("line"))


def export_marts(marts: dict[str, DataFrame], out_dir: str) -> list[str]:
    """Each aggregate -> one Parquet dataset."""
    paths = []
    for name, df in marts.items():
        p = os.path.join(out_dir, f"{name}.parquet")
        df.write.mode("overwrite").parquet(p)
        paths.append(p)
    return paths


def training_extract(spark: SparkSession, fact: DataFrame, cols: list[str], where, test_start: str,
                     out_dir: str, ym_col: str = "year_month", force: bool = False) -> dict[str, str]:
    """Project + filter once, split by month into train/test Parquet.

    Existing outputs are reused unless ``force``. Each side is written
    partitioned by month, so later reads prune by ``year_month``.
    """
    train_p, test_p = os.path.join(out_dir, "train"), os.path.join(out_dir, "test")
    if not force and path_exists(spark, train_p) and path_exists(spark, test_p):
        return {"train": train_p, "test": test_p}
    base = fact.filter(where).select(*cols)
    for side, path in ((F.col(ym_col) < test_start, train_p), (F.col(ym_col) >= test_start, test_p)):
        # static: months that moved to the other side must not stay behind
        (base.filter(side).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(ym_col).parquet(path))
    return {"train": train_p, "test": test_p}


def write_metrics(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Small metric tables -> one JSON or CSV file."""
    w = df.coalesce(1).write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.json(path))


def file_inventory(spark: SparkSession, path: str,
                   pattern: str = r"weather_([A-Z0-9]+)_(\d{4})_(\d{2})\.csv$") -> DataFrame:
    """station / year / month of every landing file from its name (S19); content not read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(name.alias("file_name"), "length",
                        F.regexp_extract(name, pattern, 1).alias("station"),
                        F.regexp_extract(name, pattern, 2).alias("year"),
                        F.regexp_extract(name, pattern, 3).alias("month")) \
        .filter(F.col("station") != "")


def inventory_counts(inv: DataFrame) -> DataFrame:
    """File counts per station and per year."""
    return inv.groupingSets([["station"], ["year"], []], "station", "year") \
        .agg(F.count(F.lit(1)).alias("files"), F.grouping_id().alias("gid"))


def files_not_loaded(inv: DataFrame, loaded: DataFrame) -> DataFrame:
    """Set difference: landing files whose (station, year-month) is not in the table."""
    units = inv.select("file_name", "station", F.concat_ws("-", "year", "month").alias("year_month"))
    have = loaded.select(F.upper("station").alias("station"), "year_month").distinct()
    return units.join(have, ["station", "year_month"], "left_anti")


def month_manifest(spark: SparkSession, months: list[str], stations: list[str] | None = None) -> DataFrame:
    """Units of a backfill: months, or station x month (S12, H-DT6)."""
    m = spark.createDataFrame([(x,) for x in months], "year_month string")
    if stations:
        s = spark.createDataFrame([(x,) for x in stations], "station string")
        return s.crossJoin(m)
    return m


def running_counts(counts: DataFrame, ym_col: str = "year_month") -> DataFrame:
    """Per-month and running totals (one row per month: a bounded window)."""
    return counts.withColumn("running_rows", F.sum("rows").over(
        Window.orderBy(ym_col).rowsBetween(Window.unboundedPreceding, 0)))


def content_hash(df: DataFrame, exclude: list[str] | None = None) -> tuple[int, int]:
    """(row count, order-insensitive content hash) of a table - one distributed aggregate."""
    cols = [c for c in df.columns if c not in (exclude or [])]
    h = F.xxhash64(*[F.col(c) for c in cols])
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("h")).first()
    return int(r["n"]), int(r["h"] or 0)


def idempotency_check(spark: SparkSession, load, path: str, exclude: list[str] | None = None) -> dict:
    """Run ``load()`` twice; the table must have equal, non-zero counts and content.

    Lineage columns that change per run (``run_id``, ``loaded_at``) are excluded.
    """
    exclude = exclude if exclude is not None else ["run_id", "loaded_at"]
    load()
    first = content_hash(spark.read.parquet(path), exclude)
    load()
    second = content_hash(spark.read.parquet(path), exclude)
    return {"first": first, "second": second, "passed": first == second and first[0] > 0}
