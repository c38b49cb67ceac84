"""Queries for joins (J*), latest/first rows (W6-W10), top-k (T*), sinks (S6/S7/S11) and U5."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import messages as M
from ..functions import scalar as P
from ..operators import joins as J
from ..operators import ranking as R
from ..operators import windows as W
from ..session import write_scratch
from ..sources import fixtures as X
from ..sources.sinks import dead_letters, quarantine_rows
from .oracle import decide_sql, with_ctes
from .registry import register


_FD_SQL = ("fd", """
SELECT user_id, event_ts AS fts, max_by(user_txn_count_1h, validated_at) AS c1h,
       max_by(user_amount_sum_1h, validated_at) AS s1h, max_by(user_avg_amount_30d, validated_at) AS a30
FROM feats GROUP BY 1, 2""")

#: the entity rows ask for the features some minutes after their event, so other rows' features apply too
_ASK = "INTERVAL 7 MINUTE"


@register("j1_asof", with_ctes(f"""
SELECT e.event_id, e.user_id, e.event_ts,
       CASE WHEN f.fts >= e.event_ts - INTERVAL 2 HOUR THEN f.c1h END AS user_txn_count_1h,
       CASE WHEN f.fts >= e.event_ts - INTERVAL 2 HOUR THEN f.s1h END AS user_amount_sum_1h,
       CASE WHEN f.fts >= e.event_ts - INTERVAL 2 HOUR THEN f.a30 END AS user_avg_amount_30d
FROM (SELECT event_id, user_id, event_ts + {_ASK} AS event_ts FROM txn_validated) e
ASOF LEFT JOIN fd f ON e.user_id = f.user_id AND e.event_ts >= f.fts""",
                               "txn_validated", "feats", extra=[_FD_SQL]), ops="J1")
def j1_asof(spark, sf):
    ent = X.txn_validated(spark, sf).select("event_id", "user_id", (F.col("event_ts") + F.expr(_ASK)).alias("event_ts"))
    # the offline feature table, computed once: the join reads it twice (rows and carries)
    feats = write_scratch(W.velocity_features(X.txn_validated(spark, sf)).select(
        "user_id", "event_ts", "validated_at", "user_txn_count_1h", "user_amount_sum_1h", "user_avg_amount_30d"), "offline-features")
    return J.asof_join(ent, feats, "user_id", ts="event_ts", created="validated_at", ttl="2 hours",
                       bucket="1 hour")


@register("j2_decisions_with_labels", with_ctes("""
SELECT d.event_id, d.created_at, d.final_score, l.label AS true_label, l.labeled_at
FROM decision_log d LEFT JOIN txn_labels l ON d.event_id = l.event_id""", "decision_log", "txn_labels"),
          ops="J2")
def j2_decisions_with_labels(spark, sf):
    j = J.decisions_with_labels(X.decision_log(spark, sf), X.txn_labels(spark, sf))
    return j.select("event_id", "created_at", "final_score", "true_label", "labeled_at")


@register("j3_unlabeled", with_ctes("""
SELECT d.event_id, d.created_at FROM decision_log d
WHERE NOT EXISTS (SELECT 1 FROM txn_labels l WHERE l.event_id = d.event_id)""", "decision_log", "txn_labels"),
          ops="J3")
def j3_unlabeled(spark, sf):
    return J.unlabeled(X.decision_log(spark, sf), X.txn_labels(spark, sf)).select("event_id", "created_at")


@register("j4_with_payload", with_ctes("""
SELECT d.event_id, coalesce(TRY_CAST(json_extract_string(v.payload, '$.is_fraud') AS INTEGER),
                            TRY_CAST(json_extract_string(v.payload, '$.label') AS INTEGER),
                            TRY_CAST(json_extract_string(v.payload, '$.isFraud') AS INTEGER)) AS payload_label
FROM decision_log d LEFT JOIN txn_validated v ON d.event_id = v.event_id""", "decision_log", "txn_validated"),
          ops="J4 J5 P4")
def j4_with_payload(spark, sf):
    j = J.with_payload(X.decision_log(spark, sf), X.txn_validated(spark, sf))
    return j.select("event_id", P.payload_label("payload").alias("payload_label"))


@register("j6_labeled_by_model", with_ctes("""
SELECT d.served_by, count(*) AS n, CAST(sum(l.label) AS BIGINT) AS positives
FROM decision_log d JOIN txn_labels l ON d.event_id = l.event_id GROUP BY 1""", "decision_log", "txn_labels"),
          ops="J6")
def j6_labeled(spark, sf):
    j = J.labeled_decisions(X.decision_log(spark, sf), X.txn_labels(spark, sf))
    return j.groupBy("served_by").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("positives"))


@register("j7_attach_context", with_ctes("""
SELECT f.event_id, f.user_txn_count_5m, b.amount, b.country, b.channel
FROM feats f LEFT JOIN txn_validated b
  ON f.event_ts = b.event_ts AND f.user_id = b.user_id AND f.merchant_id = b.merchant_id
 AND f.device_id = b.device_id AND f.ip_id = b.ip_id""", "feats", "txn_validated"), ops="J7")
def j7_attach_context(spark, sf):
    f = W.velocity_features(X.txn_validated(spark, sf)).select(
        "event_id", "event_ts", *C.ID_COLUMNS, "user_txn_count_5m")
    base = X.txn_validated(spark, sf).select("event_ts", *C.ID_COLUMNS, "amount", "country", "channel")
    j = J.attach_context(f, base, ["event_ts", *C.ID_COLUMNS])
    return j.select("event_id", "user_txn_count_5m", "amount", "country", "channel")


def _snapshots(spark, sf, start="2024-01-01 01:00:00", end="2024-01-01 05:00:00", views=None):
    # features once for all views, and every snapshot once for all its readers (a stream reads it in each micro-batch)
    f = X.validated_features(spark, sf)
    snaps = {}
    for key in views or C.FEATURE_VIEWS:
        cols = C.FEATURE_VIEWS[key]
        snaps[key] = write_scratch(W.materialize(f.select(key, "event_ts", "validated_at", *cols), key, start, end)
                                   .select(key, *cols), f"snapshot-{key}")
    return snaps


def _snap_sql(key, cols):
    c = ", ".join(cols)
    return (f"snap_{key}", f"""
SELECT {key}, {c} FROM (
  SELECT {key}, {c}, row_number() OVER (PARTITION BY {key} ORDER BY event_ts DESC, validated_at DESC) AS rn
  FROM feats WHERE event_ts BETWEEN TIMESTAMP '2024-01-01 01:00:00' AND TIMESTAMP '2024-01-01 05:00:00') s
WHERE rn = 1""")


_SNAPS = [_snap_sql(k, v) for k, v in C.FEATURE_VIEWS.items()]


@register("w6_materialize", with_ctes("SELECT * FROM snap_user_id", "feats", extra=_SNAPS[:1]), ops="W6")
def w6_materialize(spark, sf):
    return _snapshots(spark, sf, views=["user_id"])["user_id"]


@register("j8_online_features", with_ctes("""
SELECT e.event_id, u.user_txn_count_1h, m.merchant_chargeback_rate_30d, d.device_risk_score, i.ip_risk_score,
       (u.user_id IS NULL OR m.merchant_id IS NULL OR d.device_id IS NULL OR i.ip_id IS NULL) AS feast_failed
FROM txn_validated e
LEFT JOIN snap_user_id u ON e.user_id = u.user_id
LEFT JOIN snap_merchant_id m ON e.merchant_id = m.merchant_id
LEFT JOIN snap_device_id d ON e.device_id = d.device_id
LEFT JOIN snap_ip_id i ON e.ip_id = i.ip_id""", "feats", "txn_validated", extra=_SNAPS), ops="J8 W6")
def j8_online_features(spark, sf):
    ev = X.txn_validated(spark, sf).select("event_id", *C.ID_COLUMNS)
    o = J.online_features(ev, _snapshots(spark, sf))
    return o.select("event_id", "user_txn_count_1h", "merchant_chargeback_rate_30d", "device_risk_score",
                    "ip_risk_score", "feast_failed")


@register("j14_latest_online", with_ctes("""
SELECT e.event_id, u.user_txn_count_1h, u.user_id IS NULL AS user_missing
FROM (SELECT * FROM txn_validated ORDER BY validated_at DESC, event_id DESC LIMIT 1) e
LEFT JOIN snap_user_id u ON e.user_id = u.user_id""", "feats", "txn_validated", extra=_SNAPS[:1]), ops="J14 T2")
def j14_latest_online(spark, sf):
    snaps = _snapshots(spark, sf, views=["user_id"])
    o = J.latest_online(X.txn_validated(spark, sf), snaps)
    return o.select("event_id", "user_txn_count_1h", F.col("feast_failed").alias("user_missing"))


@register("j9_enrich_profiles", with_ctes("""
SELECT t.event_id, u.home_country AS profile_home_country, m.risk_tier
FROM txn t
LEFT JOIN (SELECT user_id, min(home_country) AS home_country FROM txn GROUP BY 1) u ON t.user_id = u.user_id
LEFT JOIN (SELECT merchant_id,
                  CASE WHEN r >= 0.02 THEN 2 WHEN r >= 0.01 THEN 1 ELSE 0 END AS risk_tier
           FROM (SELECT DISTINCT merchant_id, CAST(merchant_id % 30 AS DOUBLE) / CAST(1000 AS DOUBLE) AS r
                 FROM txn) x) m ON t.merchant_id = m.merchant_id""", "txn"), ops="J9 P28")
def j9_enrich_profiles(spark, sf):
    t = X.txn(spark, sf)
    users = t.groupBy("user_id").agg(F.min("home_country").alias("profile_home_country"))
    merch = (t.select("merchant_id").distinct()
              .withColumn("risk_tier", P.risk_tier((F.col("merchant_id") % 30).cast("double") / 1000.0)))
    e = J.enrich_profiles(t.select("event_id", "user_id", "merchant_id"),
                          {"users": ("user_id", users), "merchants": ("merchant_id", merch)})
    return e.select("event_id", "profile_home_country", "risk_tier")


def _shadow_pair(spark, sf, decisions=None):
    d = decisions if decisions is not None else X.decision_log(spark, sf, rescored=False)
    eid = F.col("event_id").cast("bigint")
    v1 = d.select("event_id", "final_score", "decision", F.col("latency_ms.total").alias("latency_ms"))
    s2 = F.least(F.lit(1.0), F.col("final_score") + ((eid % 7) - 3).cast("double") / 100.0)
    v2 = (d.where(eid % 5 != 0)
           .select("event_id", s2.alias("final_score"), P.decide(s2).alias("decision"),
                   (F.col("latency_ms.total") + 1.0).alias("latency_ms")))
    return v1, v2


_V2_SQL = ("v2", f"""
SELECT event_id, s AS final_score, {decide_sql('s')} AS decision, latency_total + 1.0 AS latency_ms
FROM (SELECT *, least(CAST(1 AS DOUBLE), final_score + CAST(eid % 7 - 3 AS DOUBLE) / CAST(100 AS DOUBLE)) AS s
      FROM decisions1 WHERE eid % 5 <> 0) x""")


@register("j11_shadow_compare", with_ctes("""
SELECT a.event_id, a.final_score AS v1_score, b.final_score AS v2_score,
       coalesce(b.final_score, 0.0) - coalesce(a.final_score, 0.0) AS score_delta,
       coalesce(a.decision, '') <> coalesce(b.decision, '') AS decision_diff
FROM decisions1 a JOIN v2 b ON a.event_id = b.event_id""", "decisions1", extra=[_V2_SQL]), ops="J11")
def j11_shadow_compare(spark, sf):
    v1, v2 = _shadow_pair(spark, sf)
    return J.shadow_compare(v1, v2).select("event_id", "v1_score", "v2_score", "score_delta", "decision_diff")


@register("j12_shadow_errors", with_ctes("""
SELECT b.event_id IS NULL AS shadow_error,
       coalesce(a.decision, '') <> coalesce(b.decision, '') AS decision_diff, count(*) AS n
FROM decisions1 a LEFT JOIN v2 b ON a.event_id = b.event_id GROUP BY 1, 2""", "decisions1", extra=[_V2_SQL]),
          ops="J12")
def j12_shadow_errors(spark, sf):
    v1, v2 = _shadow_pair(spark, sf)
    s = J.shadow_compare(v1, v2, keep_missing=True)
    return s.groupBy("shadow_error", "decision_diff").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- W7, W8, W10
@register("w7_first_write", with_ctes("""
SELECT event_id, min(validated_at) AS validated_at, count(*) AS copies FROM txn_raw GROUP BY 1""", "txn_raw"),
          ops="W7")
def w7_first_write(spark, sf):
    raw = X.txn(spark, sf, duplicates=True)
    fw = W.first_write(raw.select("event_id", "validated_at"), "event_id", ["validated_at"])
    copies = raw.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))
    return fw.join(copies, "event_id")


@register("w8_latest_decision", with_ctes("""
SELECT event_id, max(created_at) AS created_at, arg_max(decision, created_at) AS decision
FROM decision_log GROUP BY 1""", "decision_log"), ops="W8")
def w8_latest_decision(spark, sf):
    return W.latest_decision(X.decision_log(spark, sf)).select("event_id", "created_at", "decision")


@register("w10_time_split", with_ctes("""
SELECT event_id, CASE WHEN rn < (SELECT CAST(floor(0.8 * count(*)) AS BIGINT) FROM txn_validated)
                      THEN 'train' ELSE 'test' END AS split
FROM (SELECT event_id, row_number() OVER (ORDER BY event_ts, eid) - 1 AS rn FROM txn_validated) r""",
                                      "txn_validated"), ops="W10 W9")
def w10_time_split(spark, sf):
    v = X.txn_validated(spark, sf).withColumn("eid", F.col("event_id").cast("bigint"))
    return W.time_split(v, "event_ts", 0.8, tie="eid").select("event_id", "split")


# ---------------------------------------------------------------- T*
@register("t2_latest", with_ctes("""
SELECT event_id, validated_at FROM txn_validated ORDER BY validated_at DESC, event_id DESC LIMIT 1""",
                                 "txn_validated"), ops="T2")
def t2_latest(spark, sf):
    return R.latest(X.txn_validated(spark, sf)).select("event_id", "validated_at")


@register("t3_recent", with_ctes("""
SELECT event_id, created_at, decision FROM decision_log ORDER BY created_at DESC, event_id DESC LIMIT 200""",
                                 "decision_log"), ops="T3")
def t3_recent(spark, sf):
    return R.recent(X.decision_log(spark, sf), 1000).select("event_id", "created_at", "decision")


@register("t4_recent_features", with_ctes("""
SELECT event_id, created_at FROM decision_log WHERE has_features
ORDER BY created_at DESC, event_id DESC LIMIT 500""", "decision_log"), ops="T4")
def t4_recent_features(spark, sf):
    return R.recent_features(X.decision_log(spark, sf), 500).select("event_id", "created_at")


@register("t7_head_by", with_ctes("""
SELECT event_id, event_ts FROM txn_validated ORDER BY event_ts, event_id LIMIT 1000""", "txn_validated"),
          ops="T7")
def t7_head_by(spark, sf):
    return R.head_by(X.txn_validated(spark, sf), "event_ts", 1000).select("event_id", "event_ts")


# ---------------------------------------------------------------- S6, S7, S11, U5
@register("s6_insert_validated", with_ctes("""
SELECT m.event_id, min(m.validated_at) AS validated_at
FROM msg_flags m
WHERE NOT m.is_dead AND len(m.failed_raw) = 0
  AND NOT EXISTS (SELECT 1 FROM txn_validated t WHERE t.event_id = m.event_id AND t.eid % 4 = 0)
GROUP BY 1""", "msg_flags", "txn_validated"), ops="S6 J15 W7")
def s6_insert_validated(spark, sf):
    v = M.validate_messages(M.parse_messages(X.raw_messages(spark, sf)))
    batch = v.where("is_valid").select("event_id", F.col("arrived_at").alias("validated_at"))
    target = X.txn_validated(spark, sf).where(F.col("event_id").cast("bigint") % 4 == 0)
    return J.insert_ignore(target, batch, "event_id", ["validated_at"])


@register("s7_insert_quarantine", with_ctes("""
SELECT event_id, min(reason) AS reason FROM (
  SELECT event_id, 'validation_failed: ' || array_to_string(list_sort(list_distinct(failed_raw)), ', ') AS reason
  FROM msg_flags WHERE NOT is_dead AND len(failed_raw) > 0) q GROUP BY 1""", "msg_flags"), ops="S7 P33 P34 J15")
def s7_insert_quarantine(spark, sf):
    v = M.validate_messages(M.parse_messages(X.raw_messages(spark, sf)))
    q = quarantine_rows(v)
    empty = q.limit(0)
    return J.insert_ignore(empty, q, "event_id", ["arrived_at"]).select("event_id", "reason")


@register("s11_insert_labels", with_ctes(f"""
SELECT count(*) AS inserted FROM decisions1 d
WHERE NOT EXISTS (SELECT 1 FROM txn_labels l WHERE l.event_id = d.event_id)""", "decisions1", "txn_labels"),
          ops="S11 J15")
def s11_insert_labels(spark, sf):
    d = X.decision_log(spark, sf, rescored=False)
    batch = d.select("event_id", P.proxy_label("event_id", "drift_phase", "amount", "channel").alias("label"))
    new = J.insert_ignore(X.txn_labels(spark, sf), batch, "event_id")
    return new.agg(F.count(F.lit(1)).alias("inserted"))


@register("u5_reconcile", with_ctes("""
SELECT (SELECT count(*) FROM msg_flags) AS input,
       (SELECT count(DISTINCT event_id) FROM msg_flags WHERE NOT is_dead AND len(failed_raw) = 0) AS validated,
       (SELECT count(DISTINCT event_id) FROM msg_flags WHERE NOT is_dead AND len(failed_raw) > 0) AS quarantined,
       (SELECT count(*) FROM msg_flags WHERE is_dead) AS dead_letter,
       (SELECT count(*) FROM msg_flags WHERE NOT is_dead)
         - (SELECT count(DISTINCT event_id) FROM msg_flags WHERE NOT is_dead) AS duplicates,
       true AS balanced""", "msg_flags"), ops="U5 V15")
def u5_reconcile(spark, sf):
    v = M.validate_messages(M.parse_messages(X.raw_messages(spark, sf)))
    live = v.where(~F.col("is_dead"))
    valid = live.where("is_valid").select("event_id").distinct()
    quar = live.where(~F.col("is_valid")).select("event_id").distinct()
    dead = dead_letters(v)
    dups = live.groupBy("event_id").agg((F.count(F.lit(1)) - 1).alias("d")).where("d > 0") \
        .select(F.explode(F.sequence(F.lit(1), F.col("d"))).alias("x"))
    return R.reconcile(v, {"validated": valid, "quarantined": quar, "dead_letter": dead, "duplicates": dups})
