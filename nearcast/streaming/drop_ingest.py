"""File-drop ingest as Structured Streaming (S2-S4, S7, S9-S13 on a landing folder).

The reference loads monthly file drops with a manual, serial loop. Here the
landing folder is a streaming file source: each micro-batch holds the files
that arrived since the last one, and ``foreachBatch`` applies the same
idempotent partition reload used in batch mode, then appends audit events.
The streaming checkpoint (under ``spark.checkpoint.dir``) records which
files were processed, so a restarted or re-run query neither skips nor
double-loads a file; a replayed micro-batch rewrites the same partitions
with the same content.

``trigger(availableNow=True)`` processes everything present and stops - the
batch-style backfill; a processing-time trigger keeps watching the folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from nearcast.session import checkpoint_dir
from nearcast.sources.csvtext import csv_options, first_file, header_of, sanitize_headers
from nearcast.sources.reload import audit_events, reload_partitions


def text_csv_stream(spark: SparkSession, landing: str, header: list[str], comment: str = "#",
                    glob: str = "*.csv", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming all-string CSV rows with the file name."""
    names = sanitize_headers(header)
    schema = T.StructType([T.StructField(f"_p{i}", T.StringType()) for i in range(len(names))])
    r = csv_options(spark.readStream.schema(schema), comment).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(landing)
    cols = [F.coalesce(F.trim(F.col(f"_p{i}")), F.lit("")).alias(n) for i, n in enumerate(names) if n is not None]
    return df.select(*cols, F.col("_metadata.file_name").alias("source_file"))


def start_drop_ingest(spark: SparkSession, landing: str, target: str, audit_log: str,
                      part_cols: list[str], name: str = "drop_ingest",
                      ym_pattern: str = r"(\d{4})[_-](\d{2})", station_pattern: str | None = None,
                      header: list[str] | None = None, available_now: bool = True,
                      checkpoint: str | None = None) -> StreamingQuery:
    """Start the landing-folder -> partitioned raw table stream.

    ``part_cols`` are built from the file name: ``year_month`` always,
    ``station`` when ``station_pattern`` is given (its first group). A
    partition is replaced by the file that holds it, so ``part_cols`` must name
    what a file holds: with station files, station and month.
    """
    if station_pattern and "station" not in part_cols:
        raise ValueError("files are per station: part_cols must include 'station', else one replaces another's rows")
    if header is None:
        header = header_of(spark, first_file(spark, landing.rstrip("/") + "/*.csv"))
    stream = text_csv_stream(spark, landing, header)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        ym = F.concat_ws("-", F.regexp_extract("source_file", ym_pattern, 1),
                         F.regexp_extract("source_file", ym_pattern, 2))
        b = batch.withColumn("run_id", F.lit(f"{name}-{epoch_id}")) \
            .withColumn("loaded_at", F.current_timestamp()).withColumn("year_month", ym)
        if station_pattern:
            b = b.withColumn("station", F.upper(F.regexp_extract("source_file", station_pattern, 1)))
        if b.isEmpty():
            return
        res = reload_partitions(batch.sparkSession, b, target, part_cols)
        audit_events(batch.sparkSession, audit_log,
                     res.withColumn("run_id", F.lit(f"{name}-{epoch_id}"))
                     .withColumn("status", F.lit("success"))
                     .withColumn("error_message", F.lit(None).cast("string")))

    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "streams", name)
    w = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", ckpt).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
