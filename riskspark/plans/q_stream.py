"""Streaming queries (S5, S9, ST1-ST12): each drains a file stream derived from the driver tables.

The stream inputs are written by Spark from the fixture views into the shared
checkpoint folder (a file source, as a broker export or landing folder would
be); the stream is drained with ``availableNow`` and its output read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import messages as M
from ..session import checkpoint_dir, scratch_path, write_scratch
from ..sources import fixtures as X
from ..streaming import pipelines as ST
from .oracle import with_ctes
from .q_drift import _PL
from .q_functions import proxy_sql
from .q_joins import _V2_SQL
from .q_models import _CHECK_SQL, _SNAPS
from .registry import register

_DUE = ("due", """
SELECT d.event_id, d.created_at, d.amount, d.channel, d.drift_phase, v.payload
FROM decision_log d LEFT JOIN txn_validated v ON d.event_id = v.event_id
WHERE d.event_id IS NOT NULL AND d.created_at <= (SELECT max(created_at) FROM decision_log) - INTERVAL 5 MINUTE""")

def _land_messages(spark, sf, files: int = 10) -> str:
    """Raw JSON lines, ``files`` text files in arrival order."""
    checkpoint_dir(spark)
    path = scratch_path(spark, "landing-raw")
    X.raw_messages(spark, sf).repartitionByRange(files, "seq").sortWithinPartitions("seq") \
        .select("raw").write.text(path)
    return path


def _land_table(spark, df, name: str, order: str, files: int = 4) -> tuple[str, object]:
    checkpoint_dir(spark)
    path = scratch_path(spark, f"landing-{name}")
    df.repartitionByRange(files, order).write.parquet(path)
    return path, spark.read.parquet(path).schema


ROWS_PER_FILE = 50_000
#: rows of a time slice of a stream join (its state holds about two slices), and slices at most
ROWS_PER_SLICE, MOST_SLICES = 2_000_000, 12


def _land_in_order(spark, df, name: str, order: str, files: int = 6) -> tuple[str, object, int]:
    """(path, schema, files per slice): time slices, each written after the one before: micro-batches of a slice follow the order of arrival.

    A slice is one file, or as many as keep a file at about ``ROWS_PER_FILE`` rows: one task writes and parses a file.
    """
    checkpoint_dir(spark)
    path = scratch_path(spark, f"landing-{name}")
    df = write_scratch(df, f"arrivals-{name}")
    at = F.unix_micros(F.col(order).cast("timestamp"))
    cuts, n = df.agg(F.percentile_approx(at, [i / files for i in range(1, files)], 10000), F.count(F.lit(1))).first()
    edges = [None, *sorted(set(cuts or [])), None]
    per = max(1, n // (files * ROWS_PER_FILE))
    for lo, hi in zip(edges, edges[1:]):
        part = df.where(at > lo) if lo is not None else df
        part = part.where(at <= hi) if hi is not None else part
        (part.repartition(per) if per > 1 else part.coalesce(1)).write.mode("append").parquet(path)
    return path, df.schema, per


#: whether a stream runs a last micro-batch without rows, to drop state behind the watermark
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def _arrives_in_order(spark, path: str, schema, order: str, per: int) -> bool:
    """Whether a stream of ``per`` files a micro-batch (files go by their time of change) brings no row older than an earlier batch's.

    It does not where slices have fewer files than that (few rows, or many at one instant) or their files the same time.
    """
    land = spark.read.schema(schema).parquet(path)
    files = sorted(land.groupBy(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"))
                   .agg(F.min(order).alias("lo"), F.max(order).alias("hi")).collect())       # a row per file
    batches = [files[k:k + per] for k in range(0, len(files), per)]
    return len(files) == len(land.inputFiles()) and all(f.lo is not None for f in files) and all(
        max(f["at"] for f in a) < min(f["at"] for f in b) and max(f.hi for f in a) <= min(f.lo for f in b) for a, b in zip(batches, batches[1:]))


def _decision_stream(spark, sf):
    d = X.decision_log(spark, sf).select(
        "event_id", "user_id", "final_score", "decision", "fallbacks", "served_by", "created_at",
        F.col("latency_ms.total").alias("latency_total"))
    path, schema = _land_table(spark, d, "decisions", "created_at")
    return spark.readStream.schema(schema).parquet(path)


@register("st1_validate_stream", with_ctes("""
SELECT 'validated' AS "table", count(DISTINCT event_id) AS rows FROM msg_flags WHERE NOT is_dead AND len(failed_raw) = 0
UNION ALL SELECT 'quarantine', count(DISTINCT event_id) FROM msg_flags WHERE NOT is_dead AND len(failed_raw) > 0
UNION ALL SELECT 'dead_letter', count(*) FROM msg_flags WHERE is_dead""", "msg_flags"),
          ops="ST1 ST2 S5 S6 S7 S8 S9 J15")
def st1_validate_stream(spark, sf):
    land = _land_messages(spark, sf)
    out = scratch_path(spark, "routed")
    q = ST.validate_stream(ST.raw_event_stream(spark, land, max_files_per_trigger=3), out,
                           scratch_path(spark, "ckpt-validate"))
    q.awaitTermination()
    parts = []
    for t, name in (("txn_validated", "validated"), ("txn_quarantine", "quarantine"), ("dead_letter", "dead_letter")):
        parts.append(spark.read.parquet(f"{out}/{t}").agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(name).alias("table"), "rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("st1_spike_stream", with_ctes("""
SELECT 'validated' AS "table", event_id, CAST(NULL AS VARCHAR) AS reason FROM spikes
WHERE len(failed_raw) = 0 AND NOT spike GROUP BY event_id
UNION ALL
SELECT 'quarantine', event_id, first(CASE WHEN len(failed_raw) = 0 THEN 'validation_failed'
  ELSE 'validation_failed: ' || array_to_string(list_sort(list_distinct(failed_raw)), ', ') END
  || CASE WHEN spike THEN '; volume_spike' ELSE '' END ORDER BY validated_at) FROM spikes
WHERE len(failed_raw) > 0 OR spike GROUP BY event_id""", "msg_flags", extra=[("spikes", """
SELECT *, count(*) OVER (ORDER BY validated_at RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW) > 40 AS spike
FROM msg_flags WHERE NOT is_dead""")]), ops="ST1 V16 P34 S6 S7 S9")
def st1_spike_stream(spark, sf):
    """Messages on the landing's clock in several micro-batches; spikes that cross batches are found through the ring."""
    land, schema, per = _land_in_order(spark, X.raw_messages(spark, sf).select("raw", "arrived_at"), "spikes", "arrived_at", 4)
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", per).parquet(land)
    out = scratch_path(spark, "routed-spikes")
    ST.validate_stream(raw, out, scratch_path(spark, "ckpt-spikes"), spike_limit=40).awaitTermination()
    valid = spark.read.parquet(f"{out}/txn_validated").select(F.lit("validated").alias("table"), "event_id", F.lit(None).cast("string").alias("reason"))
    return valid.unionByName(spark.read.parquet(f"{out}/txn_quarantine").select(F.lit("quarantine").alias("table"), "event_id", "reason"))


def _parsed_stream(spark, sf):
    land = _land_messages(spark, sf)
    return ST.with_event_time(M.parse_messages(ST.raw_event_stream(spark, land)))


@register("st3_dedupe_stream", with_ctes(
    "SELECT count(DISTINCT event_id) AS events FROM msg_flags WHERE NOT is_dead", "msg_flags"), ops="ST3")
def st3_dedupe_stream(spark, sf):
    s = _parsed_stream(spark, sf).where(~F.col("is_dead")).withColumnRenamed("arrived_at", "ts")
    d = ST.run_to_table(ST.dedupe_stream(s.select("event_id", "ts"), ts="ts"), "dedupe")
    return d.agg(F.count(F.lit(1)).alias("events"))


@register("st4_volume_stream", with_ctes("""
SELECT max(n) AS max_events, count(*) FILTER (WHERE n > 40) AS spike_windows, count(*) AS windows FROM (
  SELECT w, count(*) AS n FROM (
    SELECT unnest(generate_series(s - 59, s)) AS w FROM (
      SELECT CAST(floor(epoch_us(event_ts) / 1000000) AS BIGINT) AS s FROM msg_flags WHERE NOT is_dead) a) b
  GROUP BY w) c""", "msg_flags"), ops="ST4 V16")
def st4_volume_stream(spark, sf):
    s = _parsed_stream(spark, sf).where(~F.col("is_dead") & F.col("arrived_at").isNotNull())
    v = ST.run_to_table(ST.volume_stream(s, "arrived_at", limit=40), "volume", ["window_start", "window_end"])
    return v.agg(F.max("events").alias("max_events"), F.count_if("spike").alias("spike_windows"),
                 F.count(F.lit(1)).alias("windows"))


@register("st5_rate_stream", with_ctes("""
SELECT date_trunc('minute', created_at) AS window_start, count(*) AS requests,
       count(*) FILTER (WHERE decision IS NULL OR decision = 'unknown') AS errors
FROM decision_log GROUP BY 1""", "decision_log"), ops="ST5")
def st5_rate_stream(spark, sf):
    r = ST.run_to_table(ST.rate_stream(_decision_stream(spark, sf)), "rate", ["window_start"])
    return r.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "requests", "errors")


@register("st6_latency_stream", with_ctes("""
SELECT window_start, list_sort(list(latency_total))[CAST(ceil(0.95 * count(*)) AS BIGINT)] AS p95_ms, count(*) AS n
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, created_at) AS window_start, latency_total FROM decision_log) d
GROUP BY 1""", "decision_log"), ops="ST6")
def st6_latency_stream(spark, sf):
    r = ST.run_to_table(ST.latency_stream(_decision_stream(spark, sf)), "latency", ["window_start"])
    return r.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "p95_ms", "n")


@register("st7_fallback_stream", with_ctes("""
SELECT time_bucket(INTERVAL 5 MINUTE, created_at) AS window_start, fallback, count(*) AS n FROM (
  SELECT created_at, 'anomaly_missing' AS fallback FROM decision_log WHERE fb_anomaly_missing
  UNION ALL SELECT created_at, 'champion_missing' FROM decision_log WHERE fb_champion_missing
  UNION ALL SELECT created_at, 'rules_only' FROM decision_log WHERE fb_rules_only) f
GROUP BY 1, 2""", "decision_log"), ops="ST7 A17")
def st7_fallback_stream(spark, sf):
    r = ST.run_to_table(ST.fallback_stream(_decision_stream(spark, sf)), "fallback", ["window_start", "fallback"])
    return r.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "fallback", "n")


@register("st8_canary_stream", with_ctes("""
SELECT time_bucket(INTERVAL 5 MINUTE, created_at) AS window_start,
       CASE WHEN user_id % 100 < 20 THEN 'v2' ELSE 'v1' END AS target, count(*) AS n
FROM decision_log GROUP BY 1, 2""", "decision_log"), ops="ST8 P24")
def st8_canary_stream(spark, sf):
    r = ST.run_to_table(ST.canary_stream(_decision_stream(spark, sf)), "canary", ["window_start", "target"])
    return r.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "target", "n")


@register("st9_shadow_stream", with_ctes("""
SELECT a.event_id, a.final_score AS v1_score, b.final_score AS v2_score,
       b.final_score - a.final_score AS score_delta, a.decision <> b.decision AS decision_diff
FROM decisions1 a JOIN v2 b ON a.event_id = b.event_id""", "decisions1", extra=[("v2", """
SELECT event_id, s AS final_score,
       CASE WHEN s >= 0.92 THEN 'block' WHEN s >= 0.8 THEN 'review' WHEN s >= 0.55 THEN 'step_up' ELSE 'approve' END
       AS decision
FROM (SELECT *, least(CAST(1 AS DOUBLE), final_score + CAST(eid % 7 - 3 AS DOUBLE) / CAST(100 AS DOUBLE)) AS s
      FROM decisions1 WHERE eid % 5 <> 0) x""")]), ops="ST9 J11")
def st9_shadow_stream(spark, sf):
    from .q_joins import _shadow_pair
    v1, v2 = _shadow_pair(spark, sf)
    d = X.decision_log(spark, sf, rescored=False).select("event_id", "created_at")
    p1, s1 = _land_table(spark, v1.join(d, "event_id"), "v1", "created_at")
    p2, s2 = _land_table(spark, v2.join(d, "event_id"), "v2", "created_at")
    j = ST.shadow_stream(spark.readStream.schema(s1).parquet(p1), spark.readStream.schema(s2).parquet(p2))
    return ST.run_to_table(j, "shadow")


@register("st9_shadow_totals", with_ctes(f"""
SELECT le, count(*) FILTER (WHERE d <= le) AS n, count(*) AS pairs, count(*) FILTER (WHERE decision_diff) AS decision_diff,
       round(CAST(sum(CAST(d AS DECIMAL(20, 10))) AS DOUBLE), 6) AS delta_sum
FROM (SELECT b.final_score - a.final_score AS d, a.decision <> b.decision AS decision_diff
      FROM decisions1 a JOIN v2 b ON a.event_id = b.event_id) p,
     (SELECT unnest([{', '.join(f"CAST('{b}' AS DOUBLE)" for b in C.DELTA_BUCKETS)}]) AS le) l
GROUP BY le""", "decisions1", extra=[_V2_SQL]), ops="ST9 J11")
def st9_shadow_totals(spark, sf):
    """Running histogram of score deltas and difference count over several micro-batches."""
    from .q_joins import _shadow_pair
    # both models' answers and their times come from decisions made and written once
    made = write_scratch(X.decision_log(spark, sf, rescored=False).select("event_id", "final_score", "decision", "latency_ms", "created_at"),
                         "shadow-decisions")
    v1, v2 = _shadow_pair(spark, sf, made)
    d = made.select("event_id", "created_at")
    # both sides arrive in the order of time, so answers that can meet no later one leave the join's state
    n = d.count()
    slices = max(2, min(MOST_SLICES, n // ROWS_PER_SLICE))
    sides, ordered = [], True
    for name, v in (("v1", v1), ("v2", v2)):
        p, s, per = _land_in_order(spark, v.select("event_id", "final_score", "decision").join(d, "event_id"), name, "created_at", slices)
        ordered = ordered and _arrives_in_order(spark, p, s, "created_at", per)
        sides.append(spark.readStream.schema(s).option("maxFilesPerTrigger", per).parquet(p))
    root = scratch_path(spark, "shadow-totals")
    before = spark.conf.get(NO_DATA)
    spark.conf.set(NO_DATA, "false")                     # the files end: no state has to be dropped after the last answer
    try:
        ST.shadow_totals_stream(*sides, root, scratch_path(spark, "ckpt-shadow-totals"),
                                delay="10 minutes" if ordered else "30 days").awaitTermination()
    finally:
        spark.conf.set(NO_DATA, before)
    return ST.delta_histogram(ST.shadow_totals(spark, root)).withColumn("delta_sum", F.round(F.col("delta_sum").cast("double"), 6))


def _scoring_inputs(spark, sf):
    """(events, snapshots, champion, forest) of the scorer, made once for the stream and the batch."""
    from .q_joins import _snapshots
    from .q_models import _forest, _tree_model, serving_events
    return serving_events(spark, sf), _snapshots(spark, sf), _tree_model(spark, sf)[0], _forest(spark, sf)


def _scored_stream(spark, events, *models):
    """Events of several micro-batches through the saved champion and forest; a task scores a file of about ``ROWS_PER_FILE`` rows."""
    files = max(4, -(-events.count() // ROWS_PER_FILE))
    p, s = _land_table(spark, events, "events", "event_ts", files)
    events = spark.readStream.schema(s).option("maxFilesPerTrigger", -(-3 * files // 4)).parquet(p)
    return ST.run_to_table(ST.score_stream(events, *models), "score")


@register("st10_score_stream", ops="ST10 J8 M1 M2 M5 M6 M9 P22")
def st10_score_stream(spark, sf):
    return _scored_stream(spark, *_scoring_inputs(spark, sf)).select("event_id", "final_score", "decision", "scores", "fallbacks", "feast_failed")


@register("st10_stream_equals_batch", with_ctes(f"""
SELECT count(*) AS n, count(*) FILTER (feast_failed) AS feast_failed, 0 AS differ FROM ({_CHECK_SQL}) x""",
    "feats", "txn_validated", extra=_SNAPS), ops="ST10 M9")
def st10_stream_equals_batch(spark, sf):
    """The stream's rows against the batch scorer's: same events, same scores, decisions and flags."""
    from ..operators.scoring import score_events
    inputs = _scoring_inputs(spark, sf)
    cols = ["final_score", "decision", "scores", "feast_failed"]
    a = _scored_stream(spark, *inputs).select("event_id", F.struct(*cols).alias("s"))
    b = score_events(*inputs).select(F.col("event_id").alias("b_id"), F.struct(*cols).alias("b"))
    j = a.join(b, F.col("event_id") == F.col("b_id"), "full")
    return j.agg(F.count("event_id").alias("n"), F.count_if("s.feast_failed").alias("feast_failed"),
                 F.count_if(~F.col("s").eqNullSafe(F.col("b"))).cast("int").alias("differ"))


@register("st11_velocity_stream", with_ctes("""
SELECT event_id, user_txn_count_5m, user_txn_count_1h, user_amount_sum_1h FROM feats""", "feats"),
          ops="ST11 W1 W2 W3")
def st11_velocity_stream(spark, sf):
    v = X.txn_validated(spark, sf).select("event_id", "user_id", "event_ts", "amount")
    p, s = _land_table(spark, v, "velocity", "event_ts")
    out = ST.run_to_table(ST.velocity_stream(spark.readStream.schema(s).parquet(p)), "velocity")
    return out.select("event_id", "user_txn_count_5m", "user_txn_count_1h", "user_amount_sum_1h")


@register("st11_velocity_late", with_ctes("""
SELECT event_id, user_txn_count_5m, user_txn_count_1h, user_amount_sum_1h FROM feats""", "feats"),
          ops="ST11 W1 W2 W3")
def st11_velocity_late(spark, sf):
    """Rows up to eight minutes late over several micro-batches, each emitted once and equal to the batch form.

    A last marker row three hours after all others moves the watermark past them; it is never passed itself.
    """
    v = X.txn_validated(spark, sf).select("event_id", "user_id", "event_ts", "amount")
    late = F.expr("make_interval(0, 0, 0, 0, 0, cast(event_id as bigint) % 5 * 2)")
    v = v.withColumn("arrives", F.col("event_ts") + late)
    p, s, per = _land_in_order(spark, v, "late", "arrives", 5)
    marker = spark.read.schema(s).parquet(p).agg(*[(F.max(c) + F.expr("INTERVAL 3 HOURS")).alias(c) for c in ("event_ts", "arrives")])
    marker.select(*[F.col(f.name) if f.name in marker.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in s]) \
        .write.mode("append").parquet(p)
    events = spark.readStream.schema(s).option("maxFilesPerTrigger", per).parquet(p)
    out = ST.run_to_table(ST.velocity_final_stream(events), "velocity-late")
    return out.select("event_id", "user_txn_count_5m", "user_txn_count_1h", "user_amount_sum_1h")


@register("st12_delayed_labels", with_ctes(f"""
SELECT label_source, label, count(*) AS n FROM (
  SELECT coalesce({_PL}, {proxy_sql('event_id', 'drift_phase', 'amount', 'channel')}) AS label,
         CASE WHEN {_PL} IS NOT NULL THEN '{C.GROUND_TRUTH_SOURCE}' ELSE '{C.PROXY_SOURCE}' END AS label_source
  FROM (SELECT * FROM due QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY created_at) = 1) c) x
GROUP BY 1, 2""", "decision_log", "txn_validated", extra=[_DUE]), ops="ST12 F1 S11")
def st12_delayed_labels(spark, sf):
    d = X.decision_log(spark, sf).select("event_id", "created_at", "amount", "channel", "drift_phase")
    p, s = _land_table(spark, d, "decisions-lab", "created_at")
    labels = scratch_path(spark, "labels")
    q = ST.delayed_label_stream(spark.readStream.schema(s).parquet(p), X.txn_validated(spark, sf), labels,
                                scratch_path(spark, "ckpt-labels"))
    q.awaitTermination()
    return spark.read.parquet(labels).groupBy("label_source", "label").agg(F.count(F.lit(1)).alias("n"))

