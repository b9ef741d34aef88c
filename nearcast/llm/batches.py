"""Size of the batches that Python tasks get."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROWS = 2000


def bounded_batches(spark: SparkSession, rows: int = ROWS) -> SparkSession:
    """Hand Python tasks at most ``rows`` rows at a time: whole documents are read, so a batch of Spark's
    default 10,000 rows would hold tens of MB of text several times over in every worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark
