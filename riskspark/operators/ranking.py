"""Top-k / ordering operators.

Every ``orderBy(...).limit(k)`` below plans as ``TakeOrderedAndProject``: each
task keeps its own top k, only k rows per task reach the final merge -- never
a full sort of the table.  Per-group top-k uses ``row_number`` over a window
partitioned by the group (one group's rows are bounded by k after the filter;
the window itself spills if a group is huge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C


def clamp_n(n: int, lo: int = 1, hi: int = C.RECENT_MAX) -> int:
    return max(lo, min(hi, int(n)))


def latest(df: DataFrame, ts: str = "validated_at", tie: str = "event_id") -> DataFrame:
    """Newest row."""
    return df.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(1)


def recent(df: DataFrame, n: int = 50, ts: str = "created_at", tie: str = "event_id") -> DataFrame:
    """Newest N rows, N clamped to 1..200."""
    return df.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(clamp_n(n))


def recent_features(df: DataFrame, n: int = 500, ts: str = "created_at", col: str = "features") -> DataFrame:
    """T4: newest N rows that carry a non-empty feature map."""
    return (df.where(F.size(F.col(col)) > 0)
              .orderBy(F.col(ts).desc(), F.col("event_id").desc()).limit(int(n)))


def head_by(df: DataFrame, ts: str, n: int, tie: str = "event_id") -> DataFrame:
    """Oldest N rows."""
    return df.orderBy(F.col(ts).asc(), F.col(tie).asc()).limit(int(n))


def top_k(df: DataFrame, k: int, value: str, by_abs: bool = True, tie: str | None = None) -> DataFrame:
    """Top-k rows by (absolute) value."""
    key = F.abs(F.col(value)) if by_abs else F.col(value)
    order = [key.desc()] + ([F.col(tie).asc()] if tie else [])
    return df.orderBy(*order).limit(int(k))


def top_k_per_group(df: DataFrame, group: str, k: int, value: str, by_abs: bool = True,
                    tie: str | None = None) -> DataFrame:
    """T5 per event: top-k contributors of each group with a direction label."""
    key = F.abs(F.col(value)) if by_abs else F.col(value)
    w = Window.partitionBy(group).orderBy(key.desc(), *([F.col(tie).asc()] if tie else []))
    return (df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
              .withColumn("direction", F.when(F.col(value) > 0, "increased_risk").otherwise("decreased_risk")))


def rank_slices(slices: DataFrame, low: float = C.LOW_METRIC_FLAG) -> DataFrame:
    """Slices ordered by F1 (desc) with low precision / recall flagged."""
    return (slices.withColumn("low_precision", F.col("precision") < low)
                  .withColumn("low_recall", F.col("recall") < low)
                  .orderBy(F.col("f1").desc(), F.col("slice"), F.col("value")))


def reconcile(input_n: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """Conservation check -- input rows vs the sum of the routed outputs."""
    row = input_n.agg(F.count(F.lit(1)).alias("input"))
    for name, d in parts.items():
        row = row.withColumn(name, d.agg(F.count(F.lit(1))).scalar())
    total = sum((F.col(n) for n in parts), F.lit(0))
    return row.withColumn("balanced", F.col("input") == total)
