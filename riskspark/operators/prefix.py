"""Distributed prefix sums / global ranks without an unpartitioned window.

``Window.orderBy(x)`` with no ``partitionBy`` moves the whole table into one
task.  Instead we range-bucket the rows by approximate quantiles of the leading
order key (cut points computed once, a bounded list of ``n_buckets`` values),
compute per-bucket totals (a ``n_buckets``-row summary), turn them into
offsets, and run the ordered window *inside* each bucket.  Rows with equal
leading keys always fall in the same bucket, so peer semantics (RANGE frames)
and tie-breaks are preserved exactly.

Cut points and offsets are literals in the final plan, so a lost executor
recomputes exactly the same buckets (no dependence on partition ids).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

#: buckets at least; more where the session shuffles into more partitions, so they follow the data's size
DEFAULT_BUCKETS = 64


def _bucket_count(df: DataFrame, n_buckets: int | None) -> int:
    if n_buckets is not None:
        return n_buckets
    return max(DEFAULT_BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _numeric_key(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    if isinstance(dt, DateType):
        return F.unix_date(F.col(c)).cast("double")
    if isinstance(dt, StringType):
        # first six bytes as a number: same order as the text, equal prefixes share a bucket
        head = F.substring(F.encode(F.col(c), "UTF-8"), 1, 6)
        return F.conv(F.rpad(F.hex(head), 12, "0"), 16, 10).cast("double")
    return F.col(c).cast("double")


def _materialize(df: DataFrame) -> DataFrame:
    """The kernel reads its input three times (quantiles, bucket totals, final pass): write it once
    to the shared checkpoint folder so an expensive upstream plan runs once and lineage is cut."""
    from ..session import write_scratch

    return write_scratch(df, "prefix")


def _bucketize(df: DataFrame, lead: str, n_buckets: int, rel_err: float = 0.001, written: bool = False):
    key = "_pk_lead"
    keyed = df.withColumn(key, _numeric_key(df, lead))
    if not written:
        keyed = _materialize(keyed)
    if n_buckets <= 1:
        return keyed.withColumn("_pk_bucket", F.lit(0)), 1
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = keyed.approxQuantile(key, probs, rel_err)
    cuts = sorted(set(c for c in cuts if c is not None))
    if not cuts:
        return keyed.withColumn("_pk_bucket", F.lit(0)), 1
    arr = F.array(*[F.lit(float(c)) for c in cuts])
    # bucket = number of cut points strictly below the key (nulls go to bucket 0)
    bucket = F.coalesce(F.size(F.filter(arr, lambda c: c < F.col(key))), F.lit(0))
    return keyed.withColumn("_pk_bucket", bucket), len(cuts) + 1


def _offsets(totals: list, n: int, cols: list[str]) -> dict:
    by_b = {r["_pk_bucket"]: r for r in totals}
    out = {c: [] for c in cols}
    run = {c: 0 for c in cols}
    for b in range(n):
        for c in cols:
            out[c].append(run[c])
            v = by_b[b][c] if b in by_b and by_b[b][c] is not None else 0
            run[c] = run[c] + v
    return out


def cumulative(df: DataFrame, order_col: str, value_cols: list[str], descending: bool = False,
               n_buckets: int | None = None, prefix: str = "cum_", next_col: str | None = None) -> DataFrame:
    """Running inclusive sums of ``value_cols`` in ``order_col`` order (peers included).

    Adds ``{prefix}{c}`` (running sum through the row's order value) and
    ``{prefix}total_{c}`` (the grand total) for each value column.
    """
    keyed, nb = _bucketize(df, order_col, _bucket_count(df, n_buckets))
    if descending:
        keyed = keyed.withColumn("_pk_bucket", F.lit(nb - 1) - F.col("_pk_bucket"))
    totals = keyed.groupBy("_pk_bucket").agg(*[F.sum(c).alias(c) for c in value_cols],
                                              F.min(order_col).alias("_min"), F.max(order_col).alias("_max")).collect()
    offs = _offsets(totals, nb, value_cols)
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = (Window.partitionBy("_pk_bucket").orderBy(order)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    out = keyed
    for c in value_cols:
        lit_arr = F.array(*[F.lit(v) for v in offs[c]])
        grand = sum((r[c] or 0) for r in totals)
        out = (out.withColumn(f"{prefix}{c}", F.sum(c).over(w) + F.element_at(lit_arr, F.col("_pk_bucket") + 1))
                  .withColumn(f"{prefix}total_{c}", F.lit(grand)))
    if next_col:
        # next order value: within the bucket by lead(), across the boundary from the
        # first value of the next non-empty bucket (a literal per bucket)
        by_b = {r["_pk_bucket"]: r for r in totals}
        nxt, following = [], None
        for b in reversed(range(nb)):
            nxt.append(following)
            if b in by_b and by_b[b]["_min" if not descending else "_max"] is not None:
                following = by_b[b]["_min" if not descending else "_max"]
        nxt.reverse()
        typ = df.schema[order_col].dataType.simpleString()
        arr = F.array(*[F.lit(v).cast(typ) for v in nxt])
        wl = Window.partitionBy("_pk_bucket").orderBy(order)
        out = out.withColumn(next_col, F.coalesce(F.lead(order_col).over(wl),
                                                  F.element_at(arr, F.col("_pk_bucket") + 1)))
    return out.drop("_pk_lead", "_pk_bucket")


def global_rank(df: DataFrame, order_cols: list[str], n_buckets: int | None = None,
                name: str = "_rank", written: bool = False) -> DataFrame:
    """0-based position of each row in ``order_cols`` order (ties must be broken by the caller's
    columns, e.g. a unique id last).  ``written``: the rows come from a written table as they are."""
    keyed, nb = _bucketize(df, order_cols[0], _bucket_count(df, n_buckets), written=written)
    totals = keyed.groupBy("_pk_bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    offs = _offsets(totals, nb, ["n"])["n"]
    w = Window.partitionBy("_pk_bucket").orderBy(*[F.col(c) for c in order_cols])
    lit_arr = F.array(*[F.lit(v) for v in offs])
    return (keyed.withColumn(name, F.row_number().over(w) - 1 + F.element_at(lit_arr, F.col("_pk_bucket") + 1))
                 .drop("_pk_lead", "_pk_bucket"))
