"""Sinks (S6-S13): validated / quarantine / dead-letter tables, decision log, labels, reports.

Writes are idempotent by construction: an insert is ``first-write-wins`` inside
the batch plus a ``left_anti`` against keys already in the target table, so a
replayed micro-batch (after an executor or driver loss) adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar as P
from ..functions.messages import typed_validated
from ..session import path_exists


BUCKETS = 16
DAY = "part_day"


def keyed_parts(df: DataFrame, key: str, day: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with the partition columns of a keyed table: hash bucket of the key and, with ``day``, its date.

    The number of buckets is part of the column's name, so a table is never read with another number.
    """
    b = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(int(buckets))).cast("int")
    out = df.withColumn(f"part_bucket_{int(buckets)}", b)
    if day is not None:
        out = out.withColumn(DAY, F.coalesce(F.col(day).cast("date"), F.lit("1970-01-01").cast("date")))
    return out


def keys_beside(spark: SparkSession, path: str, batch: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """Keys of the table in the partitions that ``batch`` (with its partition columns) touches.

    The filters are literals, so files of other partitions are never listed into the scan.  The driver sees the days
    and buckets of one batch; past ``MANY`` days it takes their range.
    """
    seen = batch.agg(*[F.collect_set(c).alias(c) for c in parts]).first()
    target = spark.read.parquet(path)
    lacking = [c for c in parts if c not in target.columns]
    if lacking:
        raise ValueError(f"{path} is not partitioned by {lacking}")
    for c in parts:
        values = sorted(seen[c])
        if len(values) > MANY:
            target = target.where(F.col(c).between(values[0], values[-1]))
        else:
            target = target.where(F.col(c).isin(values))
    return target.select(key, *parts)


MANY = 1000


def append_ignore(spark: SparkSession, path: str, batch: DataFrame, key: str = "event_id",
                  order: list[str] | None = None, day: str | None = None, buckets: int = BUCKETS) -> int:
    """Insert rows whose key is not in the table yet; returns the exact inserted count.

    The table is partitioned by hash bucket of the key, and by the date of ``day`` where the key fixes it (an event id
    names one message with one event time).  The anti join reads the key column of the batch's own partitions only:
    with ``day`` the cost of a batch does not grow with the table's age.  Without ``day`` a key conflicts whatever
    else its row holds.  Rows with a null key never conflict with the table, as in SQL.
    """
    from ..operators.windows import first_write

    rows = keyed_parts(first_write(batch, key, order) if order else batch.dropDuplicates([key]), key, day, buckets)
    parts = [c for c in rows.columns if c not in batch.columns]
    rows = rows.persist()
    new = rows
    try:
        if path_exists(spark, path):
            new = rows.join(keys_beside(spark, path, rows, key, parts), [key, *parts], "left_anti").persist()
        n = new.count()
        if n:
            new.repartition(*parts).write.mode("append").partitionBy(*parts).parquet(path)
        return n
    finally:
        new.unpersist()
        rows.unpersist()


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Lines that are not a JSON object."""
    return parsed.where("is_dead").select(
        *[c for c in ("seq", "arrived_at") if c in parsed.columns], F.col("raw"),
        F.lit("not_json").alias("error"))


def quarantine_rows(v: DataFrame, spike: str | None = None) -> DataFrame:
    """``(event_id, reason, payload)`` for messages failing the suite or arriving in a volume spike."""
    bad = ~F.col("is_valid") | F.col(spike) if spike else ~F.col("is_valid")
    q = v.where(~F.col("is_dead") & bad)
    return q.select(P.quarantine_id("event_id", "raw").alias("event_id"),
                    P.failure_reason("failed", spike).alias("reason"), F.col("raw").alias("payload"),
                    *[c for c in ("arrived_at",) if c in v.columns])


def two_slots(spark: SparkSession, root: str, batch_id: int, schema: str) -> tuple[DataFrame, str]:
    """State of a micro-batch sink that stays bounded and survives replays: ``(state before this batch, folder to write)``.

    Batch n reads what batch n - 1 left in the other of two slots and overwrites its own, so a replay of n starts from
    the same state and nothing but the last two states is ever stored.  Rows of a later batch id (an earlier run
    that wrote to the same root) are not read.
    """
    mine, other = f"{root}/slot={int(batch_id) % 2}", f"{root}/slot={(int(batch_id) + 1) % 2}"
    full = f"{schema}, batch_id long"
    before = (spark.read.schema(full).parquet(other) if path_exists(spark, other)
              else spark.createDataFrame([], full))
    return before.where(F.col("batch_id") < int(batch_id)).drop("batch_id"), mine


def save_slot(state: DataFrame, folder: str, batch_id: int) -> None:
    """Overwrite a slot of ``two_slots`` with this batch's state."""
    state.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).write.mode("overwrite").parquet(folder)


def flag_spikes(spark: SparkSession, v: DataFrame, root: str, batch_id: int | None, limit: int,
                seconds: int = C.VOLUME_WINDOW_SECONDS, late_seconds: int = 0, resolution_micros: int = 1) -> DataFrame:
    """V16 over micro-batches: ``volume_spike`` when more than ``limit`` messages arrived in the trailing window.

    Messages of earlier batches count through a ring in ``root/volume_ring``: arrivals per instant of the last
    ``seconds + late_seconds``, carried from batch to batch (``two_slots``), so the state never outgrows one window.
    With ``resolution_micros=1`` a window that crosses batches is exact; a coarser ring holds one row per step and may miss
    earlier arrivals of the window's first step.  Lines that are not JSON are not counted; messages without an arrival
    time are in no spike.  ``arrived_at`` should be the landing's clock: the ring follows the newest arrival.
    """
    from ..operators.windows import trailing_count

    micros = F.unix_micros(F.col("arrived_at").cast("timestamp"))
    counted = (~F.col("is_dead")).cast("int") if "is_dead" in v.columns else F.lit(1)
    rows = v.select("*", counted.alias("_n"), F.lit(False).alias("_earlier"))
    if batch_id is not None:
        old, slot = two_slots(spark, f"{root}/volume_ring", batch_id, "t long, n long")
        step = F.lit(int(resolution_micros))
        own = (rows.where("arrived_at is not null and _n = 1").select((F.floor(micros / step) * step).alias("t"), F.lit(1).cast("long").alias("n")))
        ring = own.unionByName(old).groupBy("t").agg(F.sum("n").alias("n"))
        oldest = ring.agg(F.max("t") - (seconds + late_seconds) * 1_000_000).scalar()
        save_slot(ring.where(F.col("t") >= oldest), slot, batch_id)
        arrived = F.timestamp_micros(F.col("t")).cast(v.schema["arrived_at"].dataType).alias("arrived_at")
        rows = rows.unionByName(old.select(arrived, F.col("n").cast("int").alias("_n"), F.lit(True).alias("_earlier")),
                                allowMissingColumns=True)
    t = trailing_count(rows, "arrived_at", seconds, weight="_n").where(~F.col("_earlier"))
    spike = F.col("arrived_at").isNotNull() & (F.col("_n") == 1) & (F.col("trailing_count") > F.lit(int(limit)))
    return t.withColumn("volume_spike", spike).drop("_n", "_earlier", "trailing_count")


def route_sinks(spark: SparkSession, v: DataFrame, root: str, batch_id: int | None = None,
                spike_limit: int | None = None) -> dict:
    """One pass over a validated batch -> validated / quarantine / dead-letter tables.

    With ``spike_limit`` messages that arrive in a volume spike go to quarantine
    too, their reason ending in ``; volume_spike``.  The batch is persisted once so
    the ring and the three writes do not re-read (and parse) the source; all three
    inserts ignore keys that are already there, so a replayed batch adds nothing.
    """
    parsed = None
    if spike_limit is not None and "arrived_at" in v.columns:
        parsed = v.persist()
        v = flag_spikes(spark, parsed, root, batch_id, spike_limit)
    spike = "volume_spike" if "volume_spike" in v.columns else None
    v = v.persist()
    try:
        ok = v.where(F.col("is_valid") & ~F.col(spike)) if spike else v.where("is_valid")
        stamp = F.col("arrived_at") if "arrived_at" in v.columns else F.current_timestamp().cast("timestamp_ntz")
        valid = typed_validated(ok.withColumn("validated_at", stamp), extra=["validated_at"])
        n_valid = append_ignore(spark, f"{root}/txn_validated", valid, "event_id", ["validated_at"], day="event_ts")
        n_quar = append_ignore(spark, f"{root}/txn_quarantine", quarantine_rows(v, spike), "event_id",
                               ["arrived_at"] if "arrived_at" in v.columns else None)
        dead = dead_letters(v)
        if batch_id is not None:
            dead = dead.withColumn("batch_id", F.lit(batch_id))
        # equal broken lines are separate messages: the key is text, batch and number within the batch
        number = F.row_number().over(Window.partitionBy("raw").orderBy("raw"))
        dead = dead.withColumn("dead_id", F.sha2(F.concat_ws("|", F.lit(str(batch_id)), number.cast("string"), "raw"), 256))
        n_dead = append_ignore(spark, f"{root}/dead_letter", dead, "dead_id")
        return {"validated": n_valid, "quarantined": n_quar, "dead_letter": n_dead}
    finally:
        v.unpersist()
        if parsed is not None:
            parsed.unpersist()


def write_report(df: DataFrame, root: str, as_of, name: str, fmt: str = "json") -> str:
    """Write a report under ``root/<name>/as_of=<stamp>/`` (partition-style directory)."""
    stamp = P.parse_time(as_of).strftime("%Y%m%d_%H%M%S")
    path = f"{root.rstrip('/')}/{name}/as_of={stamp}"
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.json(path)
    return path


def latest_report(spark: SparkSession, root: str, name: str, fmt: str = "json") -> DataFrame:
    """Rows of the newest stamped run (partition pruning on ``as_of``)."""
    r = spark.read.option("header", "true").format(fmt).load(f"{root.rstrip('/')}/{name}")
    newest = r.agg(F.max("as_of")).scalar()
    return r.where(F.col("as_of") == newest)
