"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every nearcast job relies on: UTC session clock (timestamps are
# instants; local wall clock only appears as explicit NTZ/strings), ANSI casts
# (bad numeric text is an error, as in the reference), AQE for runtime
# coalescing and skew splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Constraint propagation re-derives every predicate through every alias;
    # plans with many aliased time columns (four local/UTC pairs per flight)
    # grow it combinatorially (minutes of planning, driver OOM). Filters that
    # matter are written explicitly next to the scans instead.
    "spark.sql.constraintPropagation.enabled": "false",
}


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings that keep partitions near ``target_partition_bytes`` for a given input size.

    Shuffle partitions start at input / target (at least 2 x total cores),
    and AQE coalesces small ones back to the advisory size at run time; scans
    split files at the same size; skewed join partitions above 4 x target
    are split by AQE. For 100 TB on 1,000 executors x 4 cores: ~400k
    initial shuffle partitions, each ~256 MB before coalescing.
    """
    cores = executors * cores_per_executor
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "nearcast", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a shared session
                pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it (a shared filesystem). Where it is
    unset, which is the local/test case, a fresh scratch folder becomes the
    context's checkpoint folder; a session on a cluster without the setting
    is refused, because executors do not share the driver's folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="nearcast-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def materialize(df):
    """Write ``df`` once as a Parquet table in the shared checkpoint folder; read it back.

    For an expensive intermediate that several branches of one plan read:
    Spark only shares a shuffle between branches when their plans
    canonicalise identically, which inferred filters often prevent. The
    written table cuts the lineage (a lost executor re-reads files, it does
    not recompute the join), and unlike ``Dataset.checkpoint`` the plan is
    evaluated once (one columnar write, no second pass to fill the
    checkpoint).
    """
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
