"""Queries for readers and writers (S1-S4, S10, S12-S14), P1, P12, M8, U4, T6."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar as P
from ..operators import joins as J
from ..operators import ranking as R
from ..operators.scoring import positive_score, to_decision_log
from ..session import checkpoint_dir, scratch_path
from ..sources import fixtures as X
from ..sources import sinks as SK
from ..sources import tables as T
from .oracle import with_ctes
from .registry import register


@register("s1_s2_read_columns", """
SELECT user_id, event_id, value FROM events""", ops="S1 S2")
def s1_s2_read_columns(spark, sf):
    # duplicate names in the list are dropped; only these columns reach the parquet scan
    return T.read_transactions(spark, f"{sf}/events.parquet", columns=["user_id", "event_id", "value", "user_id"],
                               required=["event_id", "ts"])


@register("s3_invalid_timestamps", with_ctes("""
SELECT count(*) FILTER (WHERE ts_text IS NOT NULL AND TRY_CAST(ts_text AS TIMESTAMP) IS NULL) AS invalid
FROM (SELECT CASE WHEN eid % 83 = 0 THEN 'not a time' ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%S') END AS ts_text
      FROM txn) t""", "txn"), ops="S3")
def s3_invalid_timestamps(spark, sf):
    t = X.txn(spark, sf).select(F.when(F.col("event_id").cast("bigint") % 83 == 0, F.lit("not a time"))
                                .otherwise(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("event_ts"))
    return T.invalid_timestamp_count(t, "event_ts")


@register("s4_required_gate", with_ctes("""
SELECT 'complete' AS source, count(*) AS rows, '' AS missing FROM txn
UNION ALL SELECT 'without currency', 0, 'currency' FROM (SELECT 1) x""", "txn"), ops="S4 V1 U2")
def s4_required_gate(spark, sf):
    """The gate reads a table that has all required columns and refuses one that lacks some."""
    path = scratch_path(spark, "required-gate")
    t = X.txn(spark, sf).select(*C.REQUIRED_COLUMNS)
    t.write.parquet(f"{path}/complete.parquet")
    t.drop("currency").write.parquet(f"{path}/lacking.parquet")
    read = T.read_transactions(spark, f"{path}/complete.parquet", required=C.REQUIRED_COLUMNS)
    rows = read.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("complete").alias("source"), "rows", F.lit("").alias("missing"))
    try:
        T.read_transactions(spark, f"{path}/lacking.parquet", required=C.REQUIRED_COLUMNS)
        missing = ""
    except ValueError as e:
        missing = ",".join(c for c in C.REQUIRED_COLUMNS if c in str(e))
    refused = spark.range(1).select(F.lit("without currency").alias("source"), F.lit(0).cast("bigint").alias("rows"),
                                    F.lit(missing).alias("missing"))
    return rows.unionByName(refused)


@register("p1_canonical_event", with_ctes("""
SELECT event_id, 'txn.created' AS event_type, event_ts, user_id, merchant_id, device_id, ip_id, amount,
       currency, country, channel, drift_phase FROM txn""", "txn"), ops="P1")
def p1_canonical_event(spark, sf):
    return P.canonical_event(X.txn(spark, sf))


@register("p12_relative_time", with_ctes(f"""
SELECT count(*) AS n FROM decision_log
WHERE created_at >= TIMESTAMP '{X.AS_OF}' - INTERVAL 90 MINUTE AND created_at < TIMESTAMP '{X.AS_OF}'""",
                                         "decision_log"), ops="P12 P9")
def p12_relative_time(spark, sf):
    now = datetime.fromisoformat(X.AS_OF)
    start, end = P.parse_time("now-90m", now=now), P.parse_time("now", now=now)
    d = X.decision_log(spark, sf)
    return d.where((F.col("created_at") >= P.ts_lit(start)) & (F.col("created_at") < P.ts_lit(end))) \
        .agg(F.count(F.lit(1)).alias("n"))


@register("s10_to_decision_log", with_ctes("""
SELECT event_id, user_id, CAST(CASE WHEN eid % 2 = 0 THEN NULL ELSE drift_phase END AS INTEGER) IS NULL AS x,
       coalesce(CASE WHEN eid % 2 = 0 THEN NULL ELSE drift_phase END, 0) AS drift_phase,
       coalesce(CASE WHEN eid % 3 = 0 THEN NULL ELSE final_score END, 0.0) AS final_score,
       coalesce(CASE WHEN eid % 5 = 0 THEN NULL ELSE decision END, 'unknown') AS decision,
       coalesce(served_by, 'v1') AS served_by,
       CASE WHEN eid % 7 <> 0 THEN rules_score END AS rules, CASE WHEN eid % 7 <> 0 THEN champion_score END AS champion,
       CASE WHEN eid % 7 <> 0 THEN anomaly_score END AS anomaly,
       CASE WHEN eid % 11 <> 0 THEN CAST(fb_rules_only AS INTEGER) + CAST(fb_champion_missing AS INTEGER) + CAST(fb_anomaly_missing AS INTEGER) ELSE 0 END AS flags,
       CASE WHEN eid % 11 <> 0 THEN 3 ELSE 0 END AS flag_names,
       CASE WHEN eid % 7 <> 0 THEN champion_type END AS champion_type, CASE WHEN eid % 11 <> 0 THEN latency_total END AS latency_total,
       18 AS n_columns
FROM decisions1""", "decisions1"), ops="S10")
def s10_to_decision_log(spark, sf):
    d = X.decision_log(spark, sf, rescored=False)
    eid = F.col("event_id").cast("bigint")

    def without(c, k):
        return F.when(eid % k == 0, F.lit(None)).otherwise(F.col(c)).alias(c)

    raw = d.select("event_id", "event_ts", *C.ID_COLUMNS, "amount", "country", "channel", without("drift_phase", 2),
                   without("final_score", 3), without("decision", 5), without("scores", 7), without("fallbacks", 11),
                   without("model_versions", 7), without("latency_ms", 11), "served_by")
    out = to_decision_log(raw, now=X.AS_OF)
    x = raw.select("event_id", F.col("drift_phase").isNull().alias("x"))
    return out.join(x, "event_id").select(
        "event_id", "user_id", "x", "drift_phase", "final_score", "decision", "served_by", "scores.rules", "scores.champion", "scores.anomaly",
        F.size(P.true_flags("fallbacks")).alias("flags"), F.size("fallbacks").alias("flag_names"), "model_versions.champion_type",
        F.col("latency_ms.total").alias("latency_total"), F.lit(len(out.columns)).alias("n_columns"))


@register("s12_s13_reports", with_ctes(f"""
SELECT '{P.parse_time(X.AS_OF).strftime("%Y%m%d_%H%M%S")}' AS as_of, coalesce(served_by, 'unknown') AS model, count(*) AS count,
       round(avg(final_score), 6) AS avg_score,
       CAST(count(*) FILTER (WHERE decision = 'block') AS DOUBLE) / count(*) AS block_rate
FROM decision_log
WHERE created_at >= TIMESTAMP '{X.AS_OF}' - INTERVAL 60 MINUTE AND created_at < TIMESTAMP '{X.AS_OF}'
GROUP BY 2""", "decision_log"), ops="S12 S13")
def s12_s13_reports(spark, sf):
    from ..operators.metrics import compare_models
    checkpoint_dir(spark)
    root = scratch_path(spark, "reports")
    d = X.decision_log(spark, sf)
    for as_of in ("2024-01-01T05:00:00", X.AS_OF):
        SK.write_report(compare_models(d.where(P.in_window("created_at", as_of, 1))), root, as_of, "compare")
        SK.write_report(compare_models(d.where(P.in_window("created_at", as_of, 1))), root, as_of, "compare_csv", "csv")
    # the newest run of both formats: JSON for the rates, CSV for the counts
    j, c = SK.latest_report(spark, root, "compare"), SK.latest_report(spark, root, "compare_csv", "csv")
    return j.select(F.col("as_of").cast("string").alias("as_of"), "model", "avg_score", "block_rate").join(
        c.select("model", F.col("count").cast("bigint").alias("count")), "model")


@register("s14_read_profiles", ops="S14 J9")
def s14_read_profiles(spark, sf):
    checkpoint_dir(spark)
    d = scratch_path(spark, "profiles")
    t = X.txn(spark, sf)
    t.groupBy("user_id").agg(F.min("home_country").alias("home_country")).write.option("header", "true") \
        .csv(f"{d}/users.csv")
    t.select("merchant_id").distinct().write.option("header", "true").csv(f"{d}/merchants.csv")
    prof = T.read_profiles(spark, d)
    return J.enrich_profiles(t.select("event_id", "user_id"), {"users": ("user_id", prof["users"])}) \
        .groupBy("home_country").agg(F.count(F.lit(1)).alias("n"))


_PROFILE_SQL = [("u", "SELECT user_id, min(home_country) AS home_country, CAST(user_id % 17 AS DOUBLE) / 4 AS avg_amount_30d FROM txn GROUP BY user_id"),
                ("m", "SELECT DISTINCT merchant_id, CAST(merchant_id % 3 AS INTEGER) AS merchant_risk_tier FROM txn"),
                ("d", "SELECT DISTINCT device_id, CAST(device_id % 8 AS DOUBLE) / 8 AS device_risk_score FROM txn WHERE device_id % 13 <> 0"),
                ("i", "SELECT DISTINCT ip_id, CASE WHEN ip_id % 7 <> 0 THEN CAST(ip_id % 4 AS DOUBLE) / 4 END AS ip_risk_score FROM txn")]


@register("s14_typed_profiles", with_ctes("""
SELECT t.event_id, u.home_country, u.avg_amount_30d, m.merchant_risk_tier, d.device_risk_score, i.ip_risk_score
FROM txn t LEFT JOIN u ON t.user_id = u.user_id LEFT JOIN m ON t.merchant_id = m.merchant_id
LEFT JOIN d ON t.device_id = d.device_id LEFT JOIN i ON t.ip_id = i.ip_id""", "txn", extra=_PROFILE_SQL), ops="S14 J9")
def s14_typed_profiles(spark, sf):
    """All four profile files, written as CSV, read typed and joined to every event; some devices lack a profile, some scores do not parse."""
    root = scratch_path(spark, "profiles")
    t = X.txn(spark, sf)
    files = {
        "users": t.groupBy("user_id").agg(F.min("home_country").alias("home_country"))
                  .withColumn("avg_amount_30d", (F.col("user_id") % 17).cast("double") / 4),
        "merchants": t.select("merchant_id").distinct().withColumn("merchant_risk_tier", F.col("merchant_id") % 3),
        "devices": t.where("device_id % 13 <> 0").select("device_id").distinct()
                    .withColumn("device_risk_score", (F.col("device_id") % 8).cast("double") / 8),
        "ips": t.select("ip_id").distinct().withColumn("ip_risk_score", F.when(F.col("ip_id") % 7 == 0, F.lit("unknown"))
                                                       .otherwise(((F.col("ip_id") % 4).cast("double") / 4).cast("string"))),
    }
    for name, df in files.items():
        df.write.option("header", "true").csv(f"{root}/{name}.csv")
    prof = T.read_profiles(spark, root)
    out = J.enrich_profiles(t.select("event_id", *C.ID_COLUMNS), {n: (T.PROFILE_KEYS[n], d) for n, d in prof.items()})
    return out.select("event_id", "home_country", "avg_amount_30d", "merchant_risk_tier", "device_risk_score", "ip_risk_score")


@register("m8_positive_score", with_ctes("""
SELECT event_id, least(greatest(final_score * CAST(1.5 AS DOUBLE) - CAST(0.2 AS DOUBLE), CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)) AS clamped FROM decisions1""", "decisions1"),
          ops="M8 P29")
def m8_positive_score(spark, sf):
    d = X.decision_log(spark, sf, rescored=False)
    return d.select("event_id", positive_score(F.col("final_score") * 1.5 - 0.2, kind="decision").alias("clamped"))


@register("u4_training_fallback", with_ctes("""
SELECT count(*) AS n, 'all_rows' AS mode FROM txn_validated""", "txn_validated"), ops="U4 P10")
def u4_training_fallback(spark, sf):
    from .training_base import windowed_base
    base, mode = windowed_base(X.txn_validated(spark, sf), "2025-01-01T00:00:00", "2025-02-01T00:00:00")
    return base.agg(F.count(F.lit(1)).alias("n")).withColumn("mode", F.lit(mode))


def _top_drift_sql(tests):
    from .q_drift import _report_ctes
    return with_ctes("""
SELECT report, "column", method, round(statistic, 6) AS statistic, drifted, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY method ORDER BY round(coalesce(1.0 - p_value, statistic), 6) DESC, "column") AS rank FROM rep) t WHERE rank <= 8""",
                     "decision_log", extra=_report_ctes(tests))


@register("t6_top_drift", _top_drift_sql(False), ops="T6 D7")
def t6_top_drift(spark, sf):
    """The most drifted columns of each method: a statistic of one method is not compared with another's."""
    from . import feedback as FB
    r = FB.all_reports(FB.drift_reports(X.decision_log(spark, sf), X.AS_OF))
    r = r.withColumn("strength", F.round(F.coalesce(F.lit(1.0) - F.col("p_value"), F.col("statistic")), 6))
    top = R.top_k_per_group(r, "method", 8, "strength", by_abs=False, tie="column")
    return top.select("report", "column", "method", F.round("statistic", 6).alias("statistic"), "drifted", "rank")
