"""Window operators: velocity features (W1-W5), latest / first rows (W6-W8), time split.

Velocity features have two physical forms with identical results:

``method="window"``  one ``WindowExec`` per frame over ``PARTITION BY key ORDER BY ts``
    (Catalyst shares the sort between frames).  One shuffle; but every row of a
    key lands in one task -- a key holding a third of the table is a third of
    the table in one task.

``method="prefix"``  (default) skew-safe form.  A row enters at its instant and leaves a window
    of width w at its instant + w; a RANGE aggregate over ``[ts - w, ts]`` is what
    entered up to ts less what left before it.  Both run inside ``(key, time bucket)``
    partitions (so a hot key is split over its buckets) and are shifted by the
    totals of the key's earlier buckets (one row per (key, bucket), partial
    aggregation).  Sums run in DECIMAL so the subtraction is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.scalar import parse_time, ts_lit

_UNIT_US = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
            "day": 86_400_000_000, "week": 7 * 86_400_000_000}


def interval_micros(text: str) -> int:
    n, unit = text.split()
    unit = unit.lower().rstrip("s")
    return int(n) * _UNIT_US[unit]


def _finish(name: str, agg: str, cnt, dsum):
    if agg == "count":
        return cnt.cast("bigint").alias(name)
    if agg == "sum":
        return F.coalesce(dsum.cast("double"), F.lit(0.0)).alias(name)
    if agg == "avg":
        # exact decimal sum -> double, one IEEE division: bit-identical across engines
        avg = F.when(cnt > 0, dsum.cast("double") / cnt.cast("double"))
        return F.coalesce(avg, F.lit(0.0)).alias(name)
    raise ValueError(agg)


def velocity_features(df: DataFrame, key: str = "user_id", ts: str = "event_ts",
                      amount: str = "amount", specs=None, method: str = "prefix",
                      bucket: str = "1 day", constants: bool = True, amount_scale: int = 2) -> DataFrame:
    """RANGE-frame count/sum/avg per key (peers included), plus constant features.

    Amounts are summed as decimals of ``amount_scale`` places (2: whole cents;
    finer amounts are rounded to that), so both forms are exact and equal.
    """
    specs = specs or C.VELOCITY_FEATURES
    if method == "window":
        out = _velocity_window(df, key, ts, amount, specs, amount_scale)
    else:
        out = _velocity_prefix(df, key, ts, amount, specs, interval_micros(bucket), amount_scale)
    if constants:
        out = out.select("*", *[F.lit(0.0).alias(c) for c in C.CONSTANT_FEATURES])
    return out


def _velocity_window(df, key, ts, amount, specs, scale=2):
    cols = []
    for name, agg, width in specs:
        frame = (f"OVER (PARTITION BY `{key}` ORDER BY `{ts}` "
                 f"RANGE BETWEEN INTERVAL {width} PRECEDING AND CURRENT ROW)")
        cnt = F.expr(f"count(`{amount}`) {frame}")
        dsum = F.expr(f"sum(cast(`{amount}` as decimal({16 + scale},{scale}))) {frame}")
        if agg == "count":
            cnt = F.expr(f"count(1) {frame}")
        cols.append(_finish(name, agg, cnt, dsum))
    return df.select("*", *cols)


def _velocity_prefix(df, key, ts, amount, specs, bucket_us, scale=2):
    """A row enters at its instant and leaves the window of width w at its instant + w.

    Per key, ``feature_w(t) = entered at or before t - left_w before t``.  Both run over (key, time bucket)
    partitions; the totals of a key's earlier buckets come from a table of one row per (key, bucket).
    Rows stay where they are: no join back, so repeated or null ids keep their features, and the
    leaving rows are bare timestamps and amounts.
    """
    widths = sorted({interval_micros(w) for _, _, w in specs})
    money, wide = f"decimal({16 + scale},{scale})", f"decimal(38,{scale})"
    moves = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(w).cast("long").alias("w")) for i, w in enumerate([0, *widths])])
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    u = df.select("*", at.alias("_at"), F.explode(moves).alias("_p")).where("_p.k = 0 or _at is not null")
    own = F.col("_p.k") == 0
    t = F.col("_at") + F.col("_p.w")
    amt, nn = F.col(amount).cast(money), F.col(amount).isNotNull().cast("int")
    u = u.select(*[F.when(own, F.col(f"`{c}`")).alias(c) for c in df.columns], F.col(key).alias("_key"), t.alias("_t"),
                 F.floor(t / F.lit(bucket_us)).alias("_b"), F.col("_p.k").alias("_kind"), amt.alias("_amt"), nn.alias("_nn"))
    zero = F.lit(0).cast(wide)

    def three(k, over=lambda c: c):
        """Rows, amounts and their sum that enter (k = 0) or leave the k-th width."""
        mine = F.col("_kind") == k
        return {"c": F.coalesce(over(F.sum(F.when(mine, 1))), F.lit(0)), "n": F.coalesce(over(F.sum(F.when(mine, F.col("_nn")))), F.lit(0)),
                "s": F.coalesce(over(F.sum(F.when(mine, F.col("_amt")))).cast(wide), zero)}

    order = Window.partitionBy("_key", "_b").orderBy("_t")
    upto, before = order.rangeBetween(Window.unboundedPreceding, 0), order.rangeBetween(Window.unboundedPreceding, -1)
    kinds = range(len(widths) + 1)
    local = [v.alias(f"_{n}{k}") for k in kinds for n, v in three(k, lambda c, k=k: c.over(before if k else upto)).items()]
    rows = u.select("*", *local).where("_kind = 0")
    # totals of the key's earlier buckets, with partial aggregation: one row per (key, bucket)
    tot = u.where("_t is not null").groupBy("_key", "_b").agg(*[v.alias(f"_{n}{k}") for k in kinds for n, v in three(k).items()])
    earlier = Window.partitionBy("_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(F.col("_key").alias("_ck"), F.col("_b").alias("_cb"),
                       *[F.sum(f"_{n}{k}").over(earlier).alias(f"_o{n}{k}") for k in kinds for n in "cns"])
    j = rows.join(carry, F.col("_key").eqNullSafe(F.col("_ck")) & (F.col("_b") == F.col("_cb")), "left")

    def total(n, k):
        return F.col(f"_{n}{k}") + F.coalesce(F.col(f"_o{n}{k}").cast(wide if n == "s" else "long"), zero if n == "s" else F.lit(0))

    feats = []
    for name, agg, width in specs:
        k = widths.index(interval_micros(width)) + 1
        cnt_rows, cnt_nn = (total(n, 0) - total(n, k) for n in "cn")
        dsum = F.when(cnt_nn > 0, total("s", 0) - total("s", k))
        feats.append(_finish(name, agg, cnt_rows if agg == "count" else cnt_nn, dsum))
    return j.select(*[F.col(f"`{c}`") for c in df.columns], *feats)


# ---------------------------------------------------------------------------
# W6-W8 latest / first rows (aggregate form: partial aggregation, no sort)
# ---------------------------------------------------------------------------
def materialize(features: DataFrame, key: str, start, end, ts: str = "event_ts",
                created: str = "validated_at") -> DataFrame:
    """Latest feature row per key with ``ts`` in ``[start, end]`` (newest created wins ties)."""
    s, e = parse_time(start), parse_time(end)
    if e < s:
        raise ValueError("materialize: end is before start")
    f = features.where(F.col(ts).between(ts_lit(s), ts_lit(e)))
    others = [c for c in f.columns if c != key]
    best = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(F.col(ts), F.col(created)))
    return f.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


def first_write(df: DataFrame, key: str = "event_id", order=("validated_at",)) -> DataFrame:
    """First write wins per key (earliest by ``order``; the whole row is kept)."""
    others = [c for c in df.columns if c != key]
    pick = F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(key).agg(pick.alias("_r")).select(key, "_r.*")


def latest_decision(df: DataFrame, event_id=None, ts: str = "created_at") -> DataFrame:
    """Newest decision per event (or for one event id)."""
    d = df if event_id is None else df.where(F.col("event_id") == F.lit(str(event_id)))
    others = [c for c in d.columns if c != "event_id"]
    # decisions of one instant: the larger row text wins, so a rerun picks the same row
    tie = F.to_json(F.struct(*[F.col(c) for c in others]))
    pick = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(F.col(ts), tie))
    return d.groupBy("event_id").agg(pick.alias("_r")).select("event_id", "_r.*")


def latest_overall(df: DataFrame, ts: str = "created_at", tie: str = "event_id") -> DataFrame:
    """W8 overall / T2: the newest row (TakeOrderedAndProject, distributed top-1)."""
    return df.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(1)


# ---------------------------------------------------------------------------
# W10 time split
# ---------------------------------------------------------------------------
def time_split(df: DataFrame, ts: str = "event_ts", frac: float = 0.8, tie: str = "event_id",
               label: str | None = None, mode: str = "time", seed: int = 42, written: bool = False) -> DataFrame:
    """First floor(frac*n) rows in (ts, tie) order are 'train', the rest 'test'.

    ``mode="stratified"`` is the hash split per ``label`` (M12) for tables too
    small to split by time; the caller chooses, the size of the table does not.
    The global rank comes from the bucketed prefix kernel, never a global window.
    ``written``: the rows are read from a written table, which the kernel need not write again.
    """
    from .prefix import global_rank
    from .ml_prep import stratified_split

    if mode == "stratified":
        return stratified_split(df, label, frac, seed, key=tie)
    if mode != "time":
        raise ValueError(f"unknown split mode {mode}")
    n = df.count()
    cut = int(frac * n)
    r = global_rank(df, [ts, tie], written=written)
    return r.withColumn("split", F.when(F.col("_rank") < cut, "train").otherwise("test")).drop("_rank")


# ---------------------------------------------------------------------------
# V16 trailing volume (global event-time window, time-bucketed)
# ---------------------------------------------------------------------------
def trailing_count(df: DataFrame, ts: str = "event_ts", seconds: int = C.VOLUME_WINDOW_SECONDS,
                   name: str = "trailing_count", weight: str | None = None) -> DataFrame:
    """Rows (or the sum of ``weight``) in ``[ts - seconds, ts]`` over the whole stream (no entity key).

    A plain ``ORDER BY ts`` window would put the whole table in one task.  Time is cut into buckets as long as the
    window; a row enters its own bucket at its time and leaves in the next bucket, ``seconds`` later.  All that leaves in
    a bucket was there at its start, so inside a bucket

        count(t) = entered at or before t + (left in the whole bucket - left before t)

    One scan, one shuffle by bucket and one sort; a task holds one window's worth of rows and the bare
    timestamps of the one before.  Rows without a timestamp count each other, as peers of a RANGE frame do.
    """
    width = int(seconds) * 1_000_000
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    n = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    both = F.array(F.struct(t.alias("t"), n.alias("enters"), F.lit(None).cast("long").alias("leaves"), row.alias("row")),
                   F.struct((t + width).alias("t"), F.lit(None).cast("long").alias("enters"), n.alias("leaves"),
                            F.lit(None).cast(df.schema).alias("row")))
    d = df.select(F.inline(both)).where("enters is not null or t is not null").withColumn("bucket", F.floor(F.col("t") / width))
    order = Window.partitionBy("bucket").orderBy("t")
    upto, before = order.rangeBetween(Window.unboundedPreceding, 0), order.rangeBetween(Window.unboundedPreceding, -1)
    whole = order.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = lambda c: F.coalesce(c, F.lit(0))
    count = zero(F.sum("enters").over(upto)) + zero(F.sum("leaves").over(whole)) - zero(F.sum("leaves").over(before))
    return d.withColumn(name, F.when(F.col("t").isNull(), F.sum("enters").over(whole)).otherwise(count)).where("row is not null").select("row.*", name)


def flag_volume_spike(df: DataFrame, limit: int = C.VOLUME_SPIKE_THRESHOLD, ts: str = "event_ts",
                      seconds: int = C.VOLUME_WINDOW_SECONDS) -> DataFrame:
    """``volume_spike`` when more than ``limit`` events fall in the trailing window."""
    t = trailing_count(df, ts, seconds)
    return t.withColumn("volume_spike", F.col("trailing_count") > F.lit(int(limit)))
