"""Training-set preparation: stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def split_hash(key: str, seed: int) -> F.Column:
    """Deterministic per-row order key: sha256 of ``seed:key`` (identical in any engine)."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)


def stratified_split(df: DataFrame, label: str, frac: float = 0.8, seed: int = 42,
                     key: str = "event_id", digits: int = 3) -> DataFrame:
    """Per class, the first floor(frac * n_class) rows in hash order are 'train'.

    Exact class proportions like a stratified shuffle split, but deterministic and distributed: rows are ranked inside
    (class, first ``digits`` hex digits of the hash), which cuts a class of any size into 16 ** digits even parts, and the
    parts before come from a count per (class, part), aggregated before its shuffle.  Rows without a label are a class.
    """
    from .joins import broadcast_if_small

    h = df.withColumn("_h", split_hash(key, seed)).withColumn("_part", F.substring("_h", 1, int(digits)))
    n = h.groupBy(F.col(label).alias("_class"), F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    by_class = Window.partitionBy("_class")
    before = by_class.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = n.select("_class", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                    F.floor(F.sum("_n").over(by_class) * F.lit(float(frac))).alias("_cut"))
    rank = F.row_number().over(Window.partitionBy(label, "_part").orderBy("_h", key))
    j = h.withColumn("_rank", rank).join(broadcast_if_small(offs), F.col(label).eqNullSafe(F.col("_class")) & F.col("_part").eqNullSafe(F.col("_p")))
    train = F.col("_before") + F.col("_rank") <= F.col("_cut")
    return j.withColumn("split", F.when(train, "train").otherwise("test")).select(*df.columns, "split")
