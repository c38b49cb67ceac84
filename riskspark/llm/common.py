"""Shared helpers of the operators: reading, scratch tables, batch sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import scratch_path

#: word separators of the ``[^\x20\x09-\x0D]+`` word rule, as a Java regular expression
WS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet into the shared scratch folder and read it back.

    The folder is below ``spark.checkpoint.dir``, so a lost executor loses
    nothing and the written table cuts the lineage.  The schema is handed over
    (no inference job, and an empty result keeps its columns).  ``free`` lets the
    driver collect its garbage after a large write: Spark removes the shuffle
    files of a finished plan only then.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    if free:
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that ``materialize`` wrote, once everything that reads it is written; other tables stay."""
    spark = df.sparkSession
    own = scratch_path(spark, "").rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") + "/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if own in folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def arrow_batches(spark: SparkSession, rows: int = 512) -> None:
    """Rows per Arrow batch: texts reach 100 KB and more, the default of 10,000 rows is too many."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shards(spark: SparkSession) -> int:
    """Number of hash blocks for packed shuffles: the session's shuffle partitions.

    On a cluster that setting is sized with the data (a partition of 100-250 MB),
    so a block keeps its size while the input grows.
    """
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ascii_lower(col):
    """A-Z to a-z only; other letters keep their case (``lower`` would change them too).

    ``lower`` does just that on pure ASCII text, several times faster than ``translate``.
    """
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def ws_words(col):
    """Words ``[^\x20\x09-\x0D]+`` of a text as an array (null: empty)."""
    return F.filter(F.split(F.coalesce(col, F.lit("")), WS), lambda w: w != "")


def ws_word_count(col):
    """Number of ``[^\x20\x09-\x0D]+`` words (null: 0) without building a second array."""
    a = F.split(F.coalesce(col, F.lit("")), WS)
    return (F.size(a) - F.when(F.element_at(a, 1) == "", 1).otherwise(0)
            - F.when((F.size(a) > 1) & (F.element_at(a, -1) == ""), 1).otherwise(0)).cast("long")
