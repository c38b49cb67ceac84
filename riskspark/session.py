"""Session helpers: one place for the Spark settings the operators assume."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "riskspark",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.

    UTC session time zone (all event-time logic is UTC), AQE on (coalesces the
    many small shuffle partitions of the tiny dimension-side aggregates and splits
    skewed join partitions at runtime), UI off.  On a cluster, pass no master and
    let spark-submit decide; shuffle partitions should then be sized so one
    partition is ~128-256 MB of shuffle data.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # Settings that are safe to change on a live session (the driver may hand
    # us its own session; UTC is required for the event-time semantics).
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the operators rely on (safe to set on a live session).

    * UTC session time zone: event-time logic and timestamp literals are UTC.
    * Constraint propagation off: the validation suite folds ~30 predicates into
      one projection; Catalyst's constraint inference over joins of such
      projections grows combinatorially (driver OOM while planning).  Filters we
      need are written explicitly, so nothing is lost.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder.

    Read ``spark.checkpoint.dir`` from the session (on a cluster this names a
    shared folder).  Only in local mode (tests) an unset folder is replaced by a
    private one; on a cluster that would be a folder of one machine, so it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="riskspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        pass
    return d


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system the path belongs to (not of the driver's disk)."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Size and change time of an input path, asked of its file system: a changed table is another input."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop).getLength(), fs.getFileStatus(hadoop).getModificationTime()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared checkpoint folder for one written intermediate table.

    The name holds the application's id and a random part: drivers in containers
    commonly share a process id, and two applications (or a rerun) on one shared
    folder must not meet each other's tables or stream checkpoints.
    """
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/riskspark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def write_scratch(df, name: str):
    """Write ``df`` once as Parquet into the shared scratch folder and read it back: lineage ends there, columns stay prunable."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
