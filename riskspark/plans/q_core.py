"""Queries: fixture views, velocity features, rules, ensemble, tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import scoring as S
from ..operators.windows import velocity_features
from ..sources import fixtures as X
from .oracle import with_ctes
from .registry import register

FEATS = [n for n, _, _ in C.VELOCITY_FEATURES] + C.CONSTANT_FEATURES
TXN_COLS = ["event_id", "event_type", "event_ts", "user_id", "merchant_id", "device_id", "ip_id", "amount",
            "currency", "country", "channel", "drift_phase", "home_country", "geo_mismatch", "is_new_device",
            "is_new_ip", "payload", "validated_at"]


def flat_decisions(d: DataFrame) -> DataFrame:
    """Decision log with nested columns flattened (comparable across engines)."""
    return d.select(
        "event_id", "event_ts", *C.ID_COLUMNS, "amount", "country", "channel", "drift_phase",
        "final_score", "decision",
        F.col("scores.rules").alias("rules_score"), F.col("scores.champion").alias("champion_score"),
        F.col("scores.anomaly").alias("anomaly_score"),
        F.col("fallbacks")["rules_only"].alias("fb_rules_only"),
        F.col("fallbacks")["champion_missing"].alias("fb_champion_missing"),
        F.col("fallbacks")["anomaly_missing"].alias("fb_anomaly_missing"),
        (F.size("features") > 0).alias("has_features"),
        F.col("latency_ms.total").alias("latency_total"), "served_by", "created_at")


FLAT_SQL_COLS = ("event_id, event_ts, user_id, merchant_id, device_id, ip_id, amount, country, channel, "
                 "drift_phase, final_score, decision, rules_score, champion_score, anomaly_score, "
                 "fb_rules_only, fb_champion_missing, fb_anomaly_missing, has_features, latency_total, "
                 "served_by, created_at")


@register("fx_txn", with_ctes(f"SELECT {', '.join(TXN_COLS)} FROM txn", "txn"), ops="P1 P27 P30 fixture B1")
def fx_txn(spark, sf):
    return X.txn(spark, sf).select(*TXN_COLS)


@register("fx_txn_validated", with_ctes(f"SELECT {', '.join(TXN_COLS)} FROM txn_validated", "txn_validated"),
          ops="V13 V15 fixture")
def fx_txn_validated(spark, sf):
    return X.txn_validated(spark, sf).select(*TXN_COLS)


@register("fx_decision_log", with_ctes(f"SELECT {FLAT_SQL_COLS} FROM decision_log", "decision_log"),
          ops="M9 S10 fixture B2")
def fx_decision_log(spark, sf):
    return flat_decisions(X.decision_log(spark, sf))


@register("fx_txn_labels", with_ctes("SELECT event_id, label, label_source, labeled_at FROM txn_labels",
                                     "txn_labels"), ops="fixture B3")
def fx_txn_labels(spark, sf):
    return X.txn_labels(spark, sf)


_VEL_SQL = with_ctes(f"SELECT event_id, user_id, event_ts, {', '.join(FEATS)} FROM feats", "feats")


@register("w1_w5_velocity", _VEL_SQL, ops="W1 W2 W3 W4 W5 (skew-safe prefix form)")
def w1_velocity(spark, sf):
    v = X.txn_validated(spark, sf)
    return velocity_features(v, method="prefix").select("event_id", "user_id", "event_ts", *FEATS)


@register("w1_w5_velocity_window", _VEL_SQL, ops="W1 W2 W3 W4 W5 (RANGE window form)")
def w1_velocity_window(spark, sf):
    v = X.txn_validated(spark, sf)
    return velocity_features(v, method="window").select("event_id", "user_id", "event_ts", *FEATS)


@register("m1_rules", with_ctes("SELECT event_id, amount, user_txn_count_5m, user_amount_sum_1h, rules_score "
                                "FROM scored", "scored"), ops="M1")
def m1_rules(spark, sf):
    f = velocity_features(X.txn_validated(spark, sf))
    return S.score_rules(f).select("event_id", "amount", "user_txn_count_5m", "user_amount_sum_1h", "rules_score")


@register("m6_ensemble", with_ctes("""
SELECT CASE WHEN champion_score IS NOT NULL AND anomaly_score IS NOT NULL THEN 'both'
            WHEN champion_score IS NOT NULL THEN 'champion_only'
            WHEN anomaly_score IS NOT NULL THEN 'anomaly_only' ELSE 'rules_only' END AS branch,
       count(*) AS n, sum(CAST(final_score >= rules_score AS INTEGER)) AS n_at_least_rules,
       round(avg(final_score), 6) AS avg_final
FROM decisions1 GROUP BY 1""", "decisions1"), ops="M6 M7")
def m6_ensemble(spark, sf):
    d = flat_decisions(X.decision_log(spark, sf, rescored=False))
    return (d.withColumn("branch", S.blend_branch("champion_score", "anomaly_score"))
             .groupBy("branch").agg(F.count(F.lit(1)).alias("n"),
                                    F.sum((F.col("final_score") >= F.col("rules_score")).cast("int"))
                                    .cast("bigint").alias("n_at_least_rules"),
                                    F.round(F.avg("final_score"), 6).alias("avg_final")))


@register("p22_decide", with_ctes("SELECT event_id, final_score, decision FROM decisions1", "decisions1"),
          ops="P22")
def p22_decide(spark, sf):
    d = X.decision_log(spark, sf, rescored=False)
    return d.select("event_id", "final_score", "decision")
