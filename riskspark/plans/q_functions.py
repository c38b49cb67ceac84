"""Queries for scalar functions (P*) and validation expectations (V*, S8, P33-P35, U5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import expectations as V
from ..functions import messages as M
from ..functions import scalar as P
from ..operators.windows import velocity_features
from ..sources import fixtures as X
from .oracle import MSG_CONDS, with_ctes
from .registry import register

AS_OF = X.AS_OF


def hexmod100_sql(h: str) -> str:
    r = "CAST(0 AS BIGINT)"
    for i in range(8):
        r = f"(({r}) * 96 + CAST(('0x' || substr({h}, {8 * i + 1}, 8)) AS BIGINT)) % 100"
    return r


def proxy_sql(eid: str, drift: str, amount: str, channel: str) -> str:
    jitter = f"CAST({hexmod100_sql(f'sha256({eid})')} AS DOUBLE) / CAST(1000 AS DOUBLE)"
    zero = "CAST(0 AS DOUBLE)"
    a = f"CASE WHEN coalesce({drift}, 0) = 1 THEN CAST(0.5 AS DOUBLE) ELSE {zero} END"
    b = f"CASE WHEN coalesce({amount}, 0) >= 1000 THEN CAST(0.4 AS DOUBLE) ELSE {zero} END"
    c = f"CASE WHEN lower(coalesce({channel}, '')) = 'mobile' THEN CAST(0.2 AS DOUBLE) ELSE {zero} END"
    return f"CAST(((({zero} + {a}) + {b}) + {c}) + {jitter} >= CAST(0.75 AS DOUBLE) AS INTEGER)"


def ts_sql(s: str) -> str:
    return f"TIMESTAMP '{s}'"


# ---------------------------------------------------------------- P1-P8
@register("p2_iso_utc", with_ctes("""
SELECT event_id, strftime(event_ts, '%Y-%m-%dT%H:%M:%S')
       || CASE WHEN epoch_us(event_ts) % 1000000 = 0 THEN '' ELSE '.' || strftime(event_ts, '%f') END
       || 'Z' AS event_ts_iso
FROM txn""", "txn"), ops="P2")
def p2_iso_utc(spark, sf):
    return X.txn(spark, sf).select("event_id", P.iso_utc("event_ts").alias("event_ts_iso"))


@register("p3_derive_label", with_ctes("""
SELECT event_id,
  coalesce(TRY_CAST(json_extract_string(payload, '$.is_fraud') AS INTEGER),
    CAST((((CAST(0 AS DOUBLE) + CASE WHEN amount >= 500 THEN 1.0 ELSE 0.0 END)
      + CASE WHEN coalesce(geo_mismatch, 0) = 1 THEN 1.0 ELSE 0.0 END)
      + CASE WHEN coalesce(is_new_device, 0) = 1 THEN 0.75 ELSE 0.0 END
      + CASE WHEN coalesce(is_new_ip, 0) = 1 THEN 0.75 ELSE 0.0 END
      + CASE WHEN lower(coalesce(channel, '')) = 'mobile' THEN 0.25 ELSE 0.0 END) >= 1.0 AS INTEGER)) AS label
FROM txn""", "txn"), ops="P3")
def p3_derive_label(spark, sf):
    t = X.txn(spark, sf).withColumn("is_fraud", F.get_json_object("payload", "$.is_fraud").try_cast("int"))
    return t.select("event_id", P.derive_label(t).alias("label"))


_PL = ("coalesce(TRY_CAST(json_extract_string(payload, '$.is_fraud') AS INTEGER), "
       "TRY_CAST(json_extract_string(payload, '$.label') AS INTEGER), "
       "TRY_CAST(json_extract_string(payload, '$.isFraud') AS INTEGER))")


@register("p4_payload_label", with_ctes(f"""
SELECT event_id, {_PL} AS label,
       CASE WHEN {_PL} IS NOT NULL THEN '{C.GROUND_TRUTH_SOURCE}' END AS label_source
FROM txn_validated""", "txn_validated"), ops="P4")
def p4_payload_label(spark, sf):
    v = X.txn_validated(spark, sf).withColumn("label", P.payload_label("payload"))
    return v.select("event_id", "label",
                    F.when(F.col("label").isNotNull(), F.lit(C.GROUND_TRUTH_SOURCE)).alias("label_source"))


@register("p5_payload_label_default", with_ctes(f"""
SELECT label, count(*) AS n FROM (SELECT coalesce({_PL}, 0) AS label FROM txn_validated) t GROUP BY label""",
                                                "txn_validated"), ops="P5")
def p5_payload_label_default(spark, sf):
    v = X.txn_validated(spark, sf)
    return v.groupBy(P.payload_label("payload", default=0).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register("p6_j10_training_label", with_ctes("""
SELECT v.event_id,
  coalesce(l.label, TRY_CAST(json_extract_string(v.payload, '$.label') AS INTEGER),
           TRY_CAST(json_extract_string(v.payload, '$.is_fraud') AS INTEGER)) AS label
FROM txn_validated v LEFT JOIN txn_labels l ON v.event_id = l.event_id""", "txn_validated", "txn_labels"),
          ops="P6 J10")
def p6_training_label(spark, sf):
    from ..operators.joins import training_base
    b = training_base(X.txn_validated(spark, sf), X.txn_labels(spark, sf))
    return b.select("event_id", P.training_label(b, key="label", delayed="delayed_label").alias("label"))


@register("p7_label_status", with_ctes("""
SELECT event_id, coalesce(label, 0) AS label,
       CASE WHEN (SELECT count(label) FROM lab) = 0 THEN 'missing' ELSE 'ok' END AS label_status
FROM lab""", "txn_validated", "txn_labels", extra=[("lab", """
SELECT v.event_id, l.label FROM txn_validated v LEFT JOIN txn_labels l ON v.event_id = l.event_id""")]),
          ops="P7")
def p7_label_status(spark, sf):
    v = X.txn_validated(spark, sf).select("event_id")
    lab = v.join(X.txn_labels(spark, sf).select("event_id", "label"), "event_id", "left")
    return P.label_status(lab)


@register("p8_proxy_label", with_ctes(f"""
SELECT event_id, {proxy_sql('event_id', 'drift_phase', 'amount', 'channel')} AS label
FROM decisions1""", "decisions1"), ops="P8")
def p8_proxy_label(spark, sf):
    d = X.decision_log(spark, sf, rescored=False)
    return d.select("event_id", P.proxy_label("event_id", "drift_phase", "amount", "channel").alias("label"))


# ---------------------------------------------------------------- P9-P13 windows
@register("p9_in_window", with_ctes(f"""
SELECT decision, count(*) AS n FROM decision_log
WHERE created_at >= {ts_sql(AS_OF)} - INTERVAL 1 HOUR AND created_at < {ts_sql(AS_OF)}
GROUP BY decision""", "decision_log"), ops="P9")
def p9_in_window(spark, sf):
    d = X.decision_log(spark, sf)
    return (d.where(P.in_window("created_at", AS_OF, 1)).groupBy("decision")
             .agg(F.count(F.lit(1)).alias("n")))


@register("p10_closed_window", with_ctes("""
SELECT event_id, event_ts FROM txn_validated
WHERE event_ts BETWEEN TIMESTAMP '2024-01-01 01:00:00' AND TIMESTAMP '2024-01-01 02:00:00'""",
                                         "txn_validated"), ops="P10")
def p10_closed_window(spark, sf):
    v = X.txn_validated(spark, sf)
    return v.where(P.between_times("event_ts", "2024-01-01T01:00:00", "2024-01-01T02:00:00Z")) \
            .select("event_id", "event_ts")


@register("p11_ref_cur_split", with_ctes(f"""
SELECT CASE WHEN created_at >= {ts_sql(AS_OF)} - INTERVAL 1 HOUR AND created_at < {ts_sql(AS_OF)} THEN 'cur'
            WHEN created_at >= {ts_sql(AS_OF)} - INTERVAL 7 HOUR
                 AND created_at < {ts_sql(AS_OF)} - INTERVAL 1 HOUR THEN 'ref' END AS win,
       count(*) AS n
FROM decision_log GROUP BY 1""", "decision_log"), ops="P11")
def p11_ref_cur_split(spark, sf):
    d = X.decision_log(spark, sf)
    return d.groupBy(P.window_tag("created_at", AS_OF, 6, 1).alias("win")).agg(F.count(F.lit(1)).alias("n"))


@register("p13_hour_of_day", with_ctes("""
SELECT CAST(hour(event_ts) AS INTEGER) AS hour_of_day, count(*) AS n FROM txn GROUP BY 1""", "txn"), ops="P13")
def p13_hour_of_day(spark, sf):
    return X.txn(spark, sf).groupBy(P.hour_of_day("event_ts").alias("hour_of_day")) \
        .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- P14-P20 feature frames
@register("p14_fill_context", with_ctes("""
SELECT event_id, coalesce(currency, 'USD') AS currency, CAST(0 AS DOUBLE) AS distance_from_home_km,
       0 AS geo_mismatch, 0 AS is_new_device, 0 AS is_new_ip, 0 AS drift_phase,
       CAST(hour(event_ts) AS INTEGER) AS hour_of_day
FROM txn""", "txn"), ops="P14")
def p14_fill_context(spark, sf):
    ids_only = X.txn(spark, sf).select("event_id", "event_ts", *C.ID_COLUMNS, "amount", "currency")
    f = P.fill_context(ids_only)
    return f.select("event_id", "currency", "distance_from_home_km", "geo_mismatch", "is_new_device",
                    "is_new_ip", "drift_phase", "hour_of_day")


_FEATS = [n for n, _, _ in C.VELOCITY_FEATURES] + C.CONSTANT_FEATURES


@register("p15_scoring_input", with_ctes(f"""
SELECT event_id, coalesce(amount, 0.0) AS amount, 'USD' AS currency, coalesce(country, 'US') AS country,
       coalesce(channel, 'web') AS channel, coalesce(drift_phase, 0) AS drift_phase,
       {', '.join(f'coalesce(CAST(f_{n} AS DOUBLE), CAST(0 AS DOUBLE)) AS {n}' for n in _FEATS)}
FROM decisions1""", "decisions1"), ops="P15")
def p15_scoring_input(spark, sf):
    d = X.decision_log(spark, sf, rescored=False)
    flat = P.flatten_features(d, keys=_FEATS, keep=["event_id", "amount", "country", "channel", "drift_phase"])
    s = P.scoring_input(flat, _FEATS)
    return s.select("event_id", "amount", "currency", "country", "channel", "drift_phase", *_FEATS)


_CTRY = sorted(C.COUNTRIES)


@register("p16_one_hot", with_ctes(
    "SELECT event_id, amount, "
    + ", ".join(f"CAST(country = '{c}' AS INTEGER) AS \"country={c}\"" for c in _CTRY) + ", "
    + ", ".join(f"CAST(channel = '{c}' AS INTEGER) AS \"channel={c}\"" for c in sorted(C.CHANNELS))
    + " FROM txn_validated", "txn_validated"), ops="P16")
def p16_one_hot(spark, sf):
    v = X.txn_validated(spark, sf).select("event_id", "amount", "country", "channel")
    names = P.one_hot_fit(v, ["country", "channel"])
    return P.one_hot(v, ["country", "channel"], names)


_ALIGN = ["amount", "user_txn_count_5m", "country=US", "channel=web", "unseen_feature"]


@register("p17_align_features", with_ctes("""
SELECT event_id, amount, CAST(user_txn_count_5m AS DOUBLE) AS user_txn_count_5m,
       CAST(CAST(country = 'US' AS INTEGER) AS DOUBLE) AS "country=US",
       CAST(CAST(channel = 'web' AS INTEGER) AS DOUBLE) AS "channel=web",
       CAST(0 AS DOUBLE) AS unseen_feature
FROM feats""", "feats"), ops="P17")
def p17_align_features(spark, sf):
    f = velocity_features(X.txn_validated(spark, sf))
    oh = P.one_hot(f, ["country", "channel"], ["country=US", "channel=web"], drop_source=False)
    return P.align_features(oh, _ALIGN, keep=["event_id"])


@register("p18_to_numeric", with_ctes("""
SELECT event_id, coalesce(TRY_CAST(json_extract_string(payload, '$.label') AS DOUBLE), 0.0) AS label_num,
       coalesce(TRY_CAST(currency AS DOUBLE), 0.0) AS currency_num,
       coalesce(amount, 0.0) AS amount_num
FROM txn""", "txn"), ops="P18")
def p18_to_numeric(spark, sf):
    t = X.txn(spark, sf)
    return t.select("event_id", P.to_numeric(F.get_json_object("payload", "$.label")).alias("label_num"),
                    P.to_numeric("currency").alias("currency_num"), P.to_numeric("amount").alias("amount_num"))


@register("p19_flatten_features", with_ctes(
    "SELECT event_id, " + ", ".join(f"CAST(f_{n} AS DOUBLE) AS {n}" for n in _FEATS) + " FROM decisions1",
    "decisions1"), ops="P19")
def p19_flatten_features(spark, sf):
    d = X.decision_log(spark, sf, rescored=False)
    return P.flatten_features(d, keep=["event_id"])


@register("p20_has_features", with_ctes(
    "SELECT has_features, count(*) AS n FROM decision_log GROUP BY 1", "decision_log"), ops="P20")
def p20_has_features(spark, sf):
    d = X.decision_log(spark, sf)
    return d.groupBy(P.has_features("features").alias("has_features")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- P21-P26
@register("p21_decision_as_label", with_ctes("""
SELECT decision, CASE WHEN lower(coalesce(decision, '')) IN ('review', 'block') THEN 1 ELSE 0 END AS label,
       count(*) AS n FROM decision_log GROUP BY 1, 2""", "decision_log"), ops="P21")
def p21_decision_as_label(spark, sf):
    d = X.decision_log(spark, sf)
    return d.groupBy("decision", P.decision_as_label("decision").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register("p23_predict_at", with_ctes("""
SELECT event_id, CAST(final_score >= 0.5 AS INTEGER) AS pred,
       CASE WHEN final_score >= 0.5 THEN 'fraud' ELSE 'legit' END AS label_text,
       CAST(final_score >= 0.7 AS INTEGER) AS pred_07
FROM decisions1""", "decisions1"), ops="P23")
def p23_predict_at(spark, sf):
    d = X.decision_log(spark, sf, rescored=False)
    return d.select("event_id", P.predict_at("final_score", 0.5).alias("pred"),
                    P.fraud_label_text("final_score", 0.5).alias("label_text"),
                    P.predict_at("final_score", 0.7).alias("pred_07"))


@register("p24_assign_variant", with_ctes("""
SELECT CASE WHEN user_id % 100 < 20 THEN 'v2' ELSE 'v1' END AS variant, count(*) AS n,
       count(DISTINCT user_id) AS users
FROM txn_validated GROUP BY 1""", "txn_validated"), ops="P24")
def p24_assign_variant(spark, sf):
    v = X.txn_validated(spark, sf)
    return v.groupBy(P.assign_variant("user_id", 20).alias("variant")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


@register("p25_true_flags", with_ctes("""
SELECT array_to_string(list_filter([
         CASE WHEN fb_anomaly_missing THEN 'anomaly_missing' END,
         CASE WHEN fb_champion_missing THEN 'champion_missing' END,
         CASE WHEN fb_rules_only THEN 'rules_only' END], lambda x: x IS NOT NULL), ',') AS flags,
       count(*) AS n
FROM decision_log GROUP BY 1""", "decision_log"), ops="P25 M7")
def p25_true_flags(spark, sf):
    d = X.decision_log(spark, sf)
    return d.groupBy(F.array_join(P.true_flags("fallbacks"), ",").alias("flags")).agg(F.count(F.lit(1)).alias("n"))


@register("p26_model_ref", with_ctes("""
SELECT event_id, substr(sha256(event_id) || sha256(event_id), 1, 40) AS ref FROM txn""", "txn"), ops="P26")
def p26_model_ref(spark, sf):
    t = X.txn(spark, sf)
    return t.select("event_id", P.model_ref(F.concat(F.sha2("event_id", 256), F.sha2("event_id", 256))).alias("ref"))


# ---------------------------------------------------------------- P27-P32
@register("p27_currency_of", with_ctes(
    "SELECT country, currency, count(*) AS n FROM txn GROUP BY 1, 2", "txn"), ops="P27")
def p27_currency_of(spark, sf):
    t = X.txn(spark, sf)
    return t.groupBy("country", P.currency_of("country").alias("currency")).agg(F.count(F.lit(1)).alias("n"))


@register("p28_risk_tier", with_ctes("""
SELECT tier, count(*) AS n FROM (
  SELECT CASE WHEN r >= 0.02 THEN 2 WHEN r >= 0.01 THEN 1 ELSE 0 END AS tier
  FROM (SELECT CAST(merchant_id % 30 AS DOUBLE) / CAST(1000 AS DOUBLE) AS r FROM txn) a) b GROUP BY tier""",
                                     "txn"), ops="P28")
def p28_risk_tier(spark, sf):
    t = X.txn(spark, sf).withColumn("r", (F.col("merchant_id") % 30).cast("double") / 1000.0)
    return t.groupBy(P.risk_tier("r").alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@register("p29_clip", with_ctes("""
SELECT event_id, least(greatest(amount / CAST(1000 AS DOUBLE), CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)) AS amount_unit
FROM txn""", "txn"), ops="P29")
def p29_clip(spark, sf):
    t = X.txn(spark, sf)
    return t.select("event_id", P.clip(F.col("amount") / 1000.0, 0.0, 1.0).alias("amount_unit"))


@register("p30_geo_mismatch", with_ctes(
    "SELECT geo_mismatch, count(*) AS n FROM txn GROUP BY 1", "txn"), ops="P30")
def p30_geo_mismatch(spark, sf):
    t = X.txn(spark, sf)
    return t.groupBy(P.geo_mismatch("country", "home_country").alias("geo_mismatch")).agg(
        F.count(F.lit(1)).alias("n"))


_T = C.RULE_THRESHOLDS


@register("p31_rules_triggered", with_ctes(f"""
SELECT event_id, array_to_string(list_filter([
  CASE WHEN amount >= {_T['very_high_amount']} AND susp THEN 'Very high amount + suspicious context' END,
  CASE WHEN amount >= {_T['high_amount']} AND susp THEN 'High amount + suspicious context' END,
  CASE WHEN user_txn_count_5m >= {_T['velocity_count_5m']} THEN 'High transaction velocity (5m)' END,
  CASE WHEN user_amount_sum_1h >= {_T['velocity_amount_1h']} THEN 'High spending velocity (1h)' END,
  CASE WHEN merchant_chargeback_rate_30d >= {_T['merchant_risk']} THEN 'High-risk merchant' END
  ], lambda x: x IS NOT NULL), '|') AS rules
FROM (SELECT *, geo_mismatch + is_new_device + is_new_ip >= 1 AS susp FROM feats) f""", "feats"), ops="P31")
def p31_rules_triggered(spark, sf):
    f = velocity_features(X.txn_validated(spark, sf))
    return f.select("event_id", F.array_join(P.rules_triggered(f), "|").alias("rules"))


@register("p32_anomaly_reasons", with_ctes(f"""
SELECT event_id, array_to_string(list_filter([
  CASE WHEN coalesce(anomaly_score, 0) > 0.8
       THEN 'Transaction looks highly unusual compared to baseline patterns' END,
  CASE WHEN geo_mismatch >= 1 THEN 'Geo mismatch' END,
  CASE WHEN is_new_device >= 1 THEN 'New device' END,
  CASE WHEN is_new_ip >= 1 THEN 'New IP' END,
  CASE WHEN user_txn_count_5m >= {_T['velocity_count_5m']} OR user_amount_sum_1h >= {_T['velocity_amount_1h']}
       THEN 'Unusual velocity' END
  ], lambda x: x IS NOT NULL)[1:4], '|') AS reasons
FROM decisions0""", "decisions0"), ops="P32")
def p32_anomaly_reasons(spark, sf):
    f = velocity_features(X.txn_validated(spark, sf))
    eid = F.col("event_id").cast("bigint")
    f = f.withColumn("anomaly_score", F.when(eid % 7 != 6, ((eid * 53) % 101).cast("double") / 100.0))
    return f.select("event_id", F.array_join(P.anomaly_reasons(f, "anomaly_score"), "|").alias("reasons"))


# ---------------------------------------------------------------- P36
@register("p36_feature_hash", with_ctes(
    "SELECT CASE WHEN has_features THEN sha256('[" + ", ".join(f'"{n}"' for n in sorted(_FEATS))
    + "]') ELSE sha256('[]') END AS feature_hash, count(*) AS n FROM decision_log GROUP BY 1",
    "decision_log"), ops="P36 A12")
def p36_feature_hash(spark, sf):
    d = X.decision_log(spark, sf)
    return d.groupBy(P.feature_hash(F.array_sort(F.map_keys("features"))).alias("feature_hash")) \
        .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- V / S8 / P33-P34 on raw messages
def _validated_messages(spark, sf):
    parsed = M.parse_messages(X.raw_messages(spark, sf))
    return M.validate_messages(parsed)


_REASON_SQL = ("CASE WHEN len(failed_raw) = 0 THEN NULL ELSE 'validation_failed: ' || "
               "array_to_string(list_sort(list_distinct(failed_raw)), ', ') END")


@register("v13_validate_messages", with_ctes(f"""
SELECT CASE WHEN is_dead THEN NULL ELSE event_id END AS event_id, is_dead,
       NOT is_dead AND len(failed_raw) = 0 AS is_valid,
       CASE WHEN is_dead THEN NULL ELSE {_REASON_SQL} END AS reason
FROM msg_flags""", "msg_flags"), ops="V2 V3 V4 V5 V6 V7 V8 V9 V10 V11 V13 P34 S8")
def v13_validate_messages(spark, sf):
    v = _validated_messages(spark, sf)
    reason = F.when(~F.col("is_dead") & ~F.col("is_valid"), P.failure_reason("failed"))
    return v.select("event_id", "is_dead", "is_valid", reason.alias("reason"))


def _report_sql():
    parts = []
    for i, (name, col, cond) in enumerate(MSG_CONDS, start=1):
        parts.append(f"SELECT {i} AS ordinal, '{name}' AS expectation, '{col}' AS column, count(*) AS evaluated, "
                     f"CAST(sum(CAST({cond} AS INTEGER)) AS BIGINT) AS unexpected FROM live")
    body = " UNION ALL ".join(parts)
    return with_ctes(f"SELECT *, unexpected = 0 AS success FROM ({body}) r", "msg_flags",
                     extra=[("live", "SELECT * FROM msg_flags WHERE NOT is_dead")])


@register("v14_validation_report", _report_sql(), ops="V12 V14")
def v14_validation_report(spark, sf):
    parsed = M.parse_messages(X.raw_messages(spark, sf)).where(~F.col("is_dead"))
    suite = [e for e in M.message_suite() if e.kind != "columns"]
    report = V.validation_report(parsed, suite, tokens={c: F.col(f"s_{c}") for c in C.ID_COLUMNS})
    return report.withColumn("ordinal", F.col("ordinal") + 1)


@register("v15_split_counts", with_ctes("""
SELECT CASE WHEN is_dead THEN 'dead_letter' WHEN len(failed_raw) = 0 THEN 'validated' ELSE 'quarantine' END
       AS route, count(*) AS n
FROM msg_flags GROUP BY 1""", "msg_flags"), ops="V15 S9")
def v15_split_counts(spark, sf):
    v = _validated_messages(spark, sf)
    route = F.when(F.col("is_dead"), "dead_letter").when(F.col("is_valid"), "validated").otherwise("quarantine")
    return v.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n"))


@register("s8_dead_letter", with_ctes("""
SELECT validated_at AS arrived_at, 'not_json' AS error FROM msg_flags WHERE is_dead""", "msg_flags"),
          ops="S8")
def s8_dead_letter(spark, sf):
    from ..sources.sinks import dead_letters
    return dead_letters(M.parse_messages(X.raw_messages(spark, sf))).select("arrived_at", "error")


@register("p33_quarantine_id", with_ctes("""
SELECT CASE WHEN eid % 17 = 0 THEN 'unknown:' || substr(sha256('{"seq":' || eid || '}'), 1, 16)
            ELSE event_id END AS quarantine_id
FROM txn""", "txn"), ops="P33")
def p33_quarantine_id(spark, sf):
    t = X.txn(spark, sf)
    eid = F.col("event_id").cast("bigint")
    raw = F.concat(F.lit('{"seq":'), F.col("event_id"), F.lit("}"))
    blanked = F.when(eid % 17 == 0, F.lit("")).otherwise(F.col("event_id"))
    return t.select(P.quarantine_id(blanked, raw).alias("quarantine_id"))


@register("p35_to_payload", with_ctes(f"""
SELECT event_id, {len(C.REQUIRED_COLUMNS)} AS fields, user_id, amount, country, channel FROM txn_validated""", "txn_validated"), ops="P35")
def p35_to_payload(spark, sf):
    """Payloads read back: every required field is there with its value."""
    t = X.txn_validated(spark, sf)
    p = t.select(P.to_payload(t, C.REQUIRED_COLUMNS).alias("payload"))
    got = F.from_json("payload", "event_id string, user_id bigint, amount double, country string, channel string")
    return p.select(got.alias("j"), F.size(F.json_object_keys("payload")).alias("fields")).select(
        "j.event_id", "fields", "j.user_id", "j.amount", "j.country", "j.channel")


@register("v1_expect_columns", with_ctes(f"""
SELECT CASE WHEN is_dead THEN NULL
            ELSE array_to_string(list_filter([CASE WHEN brk = 'missing_user' THEN 'user_id' END,
                                              CASE WHEN currency IS NULL THEN 'currency' END],
                                             lambda x: x IS NOT NULL), ',') END AS missing,
       count(*) AS n
FROM msg_flags GROUP BY 1""", "msg_flags"), ops="V1 U2 S4")
def v1_expect_columns(spark, sf):
    p = M.parse_messages(X.raw_messages(spark, sf))
    req = F.array(*[F.lit(c) for c in C.REQUIRED_COLUMNS])
    missing = F.when(~F.col("is_dead"), F.array_join(F.array_except(req, F.col("keys")), ","))
    return p.groupBy(missing.alias("missing")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- V12 suite as a JSON document
SUITE_DOC = {
    "expectations": [
        {"type": "expect_column_values_to_not_be_null", "kwargs": {"column": c}} for c in C.REQUIRED_COLUMNS
    ] + [
        {"type": "expect_column_values_to_be_between", "kwargs": {"column": "amount", "min_value": 0.01,
                                                                   "max_value": 100000}},
        {"type": "expect_column_values_to_be_in_set", "kwargs": {"column": "country", "value_set": C.COUNTRIES}},
        {"type": "expect_column_values_to_be_in_set", "kwargs": {"column": "channel", "value_set": C.CHANNELS}},
    ]
}


@register("v12_json_suite", with_ctes(f"""
SELECT count(*) FILTER (WHERE NOT (event_id IS NULL OR event_type IS NULL OR event_ts IS NULL OR user_id IS NULL
         OR merchant_id IS NULL OR device_id IS NULL OR ip_id IS NULL OR amount IS NULL OR currency IS NULL
         OR country IS NULL OR channel IS NULL OR drift_phase IS NULL
         OR coalesce(amount < 0.01 OR amount > 100000, false)
         OR coalesce(country NOT IN ({", ".join(repr(c) for c in C.COUNTRIES)}), false)
         OR coalesce(channel NOT IN ('web', 'mobile'), false))) AS valid,
       count(*) AS total
FROM txn""", "txn"), ops="V12 V13")
def v12_json_suite(spark, sf):
    import json
    suite = V.suite_from_json(json.dumps(SUITE_DOC))
    v = V.validate(X.txn(spark, sf), suite)
    return v.agg(F.count_if("is_valid").alias("valid"), F.count(F.lit(1)).alias("total"))
