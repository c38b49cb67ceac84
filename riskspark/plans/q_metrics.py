"""Queries for aggregations and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import messages as M
from ..functions import scalar as P
from ..operators import joins as J
from ..operators import metrics as A
from ..operators import ranking as R
from ..operators.ml_prep import stratified_split
from ..session import write_scratch
from ..sources import fixtures as X
from .oracle import with_ctes
from .registry import register

AS_OF = X.AS_OF
AS_OF_L = X.AS_OF_LABELS
_PL0 = ("coalesce(TRY_CAST(json_extract_string(payload, '$.is_fraud') AS INTEGER), "
        "TRY_CAST(json_extract_string(payload, '$.label') AS INTEGER), "
        "TRY_CAST(json_extract_string(payload, '$.isFraud') AS INTEGER), 0)")


def div_sql(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def prf_sql(tp="tp", fp="fp", fn="fn") -> str:
    return (f"{div_sql(tp, f'{tp} + {fp}')} AS precision, {div_sql(tp, f'{tp} + {fn}')} AS recall, "
            f"{div_sql(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f1")


def conf_sql(label: str, pred: str) -> str:
    return (f"count(*) FILTER (WHERE {label} = 1 AND {pred} = 1) AS tp, "
            f"count(*) FILTER (WHERE {label} = 0 AND {pred} = 1) AS fp, "
            f"count(*) FILTER (WHERE {label} = 0 AND {pred} = 0) AS tn, "
            f"count(*) FILTER (WHERE {label} = 1 AND {pred} = 0) AS fn")


def unpivot_sql(src: str, cols: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS slice, CAST({d} AS VARCHAR) AS value, {cols} FROM {src}" for d in C.SLICE_DIMS)


# ------------------------------------------------------------ fixtures for the monitoring window
def slice_input(spark, sf, validated=None, features=None):
    """Decisions in [as_of-24h, as_of) left join payload labels of events in the same window.

    ``features``: the validated rows with their velocity features, if they are written already.
    """
    validated = features if features is not None else validated if validated is not None else write_scratch(X.txn_validated(spark, sf), "validated")
    d = X.decision_log(spark, sf, validated=validated, features=features).where(P.in_window("created_at", AS_OF, 24))
    lab = (validated.where(P.in_window("event_ts", AS_OF, 24))
           .select("event_id", P.payload_label("payload", default=0).alias("label")))
    # whether any label is there and the rows themselves: the decisions are scored and joined once
    m = write_scratch(d.join(lab, "event_id", "left"), "slice-input")
    has = m.agg(F.count("label")).scalar()
    return m.withColumn("label", F.when(has > 0, F.coalesce(F.col("label"), F.lit(0)))
                        .otherwise(P.decision_as_label("decision"))) \
            .withColumn("label_mode", F.when(has > 0, "payload_label").otherwise("fallback_decision"))


_SLICE_IN = ("m", f"""
SELECT d.*, coalesce(l.label, 0) AS label FROM decision_log d
LEFT JOIN (SELECT event_id, {_PL0} AS label FROM txn_validated
           WHERE event_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR AND event_ts < TIMESTAMP '{AS_OF}') l
  ON d.event_id = l.event_id
WHERE d.created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR AND d.created_at < TIMESTAMP '{AS_OF}'""")

_SLICE_SQL = f"""
SELECT slice, value, round(avg(final_score), 6) AS avg_score,
       {div_sql("count(*) FILTER (WHERE decision = 'block')", 'count(*)')} AS block_rate,
       {prf_sql("count(*) FILTER (WHERE label = 1 AND final_score >= 0.5)",
                "count(*) FILTER (WHERE label = 0 AND final_score >= 0.5)",
                "count(*) FILTER (WHERE label = 1 AND final_score < 0.5)")},
       count(*) AS count
FROM ({unpivot_sql('m', 'final_score, decision, label')}) u
WHERE value IS NOT NULL GROUP BY slice, value"""


@register("a1_slice_metrics", with_ctes(_SLICE_SQL, "decision_log", "txn_validated", extra=[_SLICE_IN]),
          ops="A1 A2 U1 J5 P5 P21")
def a1_slice_metrics(spark, sf):
    return A.slice_metrics(slice_input(spark, sf), t=C.SLICE_THRESHOLD)


@register("a2_label_mode", with_ctes("""
SELECT CASE WHEN count(label) > 0 THEN 'payload_label' ELSE 'fallback_decision' END AS label_mode,
       count(*) AS rows FROM m""", "decision_log", "txn_validated", extra=[_SLICE_IN]), ops="A2")
def a2_label_mode(spark, sf):
    return slice_input(spark, sf).groupBy("label_mode").agg(F.count(F.lit(1)).alias("rows"))


@register("t8_rank_slices", with_ctes(f"""
SELECT slice, value, f1, precision < 0.2 AS low_precision, recall < 0.2 AS low_recall
FROM ({_SLICE_SQL}) s""", "decision_log", "txn_validated", extra=[_SLICE_IN]), ops="T8")
def t8_rank_slices(spark, sf):
    s = A.slice_metrics(slice_input(spark, sf))
    return R.rank_slices(s).select("slice", "value", "f1", "low_precision", "low_recall")


@register("j13_slice_context", with_ctes(f"""
SELECT e.event_id, e.slice, e.value, s.f1, s.count FROM
 ({unpivot_sql('decisions1', 'event_id')}) e
LEFT JOIN ({_SLICE_SQL}) s ON e.slice = s.slice AND e.value = s.value""",
                                         "decision_log", "txn_validated", extra=[_SLICE_IN]), ops="J13")
def j13_slice_context(spark, sf):
    v = write_scratch(X.txn_validated(spark, sf), "validated")
    slices = A.slice_metrics(slice_input(spark, sf, v)).select("slice", "value", "f1", "count")
    ev = X.decision_log(spark, sf, rescored=False, validated=v)
    return J.slice_context(ev, slices).select("event_id", "slice", "value", "f1", "count")


# ------------------------------------------------------------ labeled performance (A3-A10)
def perf_rows(spark, sf):
    """decision_with_labels in the labeled_at window, label present (F2 input)."""
    j = J.decisions_with_labels(X.decision_log(spark, sf), X.txn_labels(spark, sf))
    return j.where(P.in_window("labeled_at", AS_OF_L, 24) & F.col("true_label").isNotNull())


_PERF_IN = ("pr", f"""
SELECT d.*, l.label AS true_label, l.labeled_at FROM decision_log d JOIN txn_labels l ON d.event_id = l.event_id
WHERE l.labeled_at >= TIMESTAMP '{AS_OF_L}' - INTERVAL 24 HOUR AND l.labeled_at < TIMESTAMP '{AS_OF_L}'""")


@register("a3_perf_slices", with_ctes(f"""
SELECT slice, value,
       {prf_sql("count(*) FILTER (WHERE true_label = 1 AND final_score >= 0.7)",
                "count(*) FILTER (WHERE true_label = 0 AND final_score >= 0.7)",
                "count(*) FILTER (WHERE true_label = 1 AND final_score < 0.7)")}, count(*) AS count
FROM ({unpivot_sql('pr', 'final_score, true_label')}) u WHERE value IS NOT NULL GROUP BY slice, value""",
                                      "decision_log", "txn_labels", extra=[_PERF_IN]), ops="A3 J2 P9")
def a3_perf_slices(spark, sf):
    return A.slice_metrics(perf_rows(spark, sf), t=C.PERF_THRESHOLD, label="true_label", with_scores=False)


def _auc_sql(src: str, score: str, label: str) -> str:
    return f"""(SELECT CASE WHEN max(P) > 0 AND max(N) > 0
                  THEN CAST(sum(neg * (P - cum_pos) * 2 + neg * pos) AS DOUBLE) / CAST(max(P) * max(N) * 2 AS DOUBLE)
                  END
   FROM (SELECT *, sum(pos) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS cum_pos,
                sum(pos) OVER () AS P, sum(neg) OVER () AS N
         FROM (SELECT {score} AS s, count(*) FILTER (WHERE {label} = 1) AS pos,
                      count(*) FILTER (WHERE {label} = 0) AS neg
               FROM {src} WHERE {score} IS NOT NULL AND {label} IS NOT NULL GROUP BY 1) st) c)"""


@register("a5_performance", with_ctes(f"""
SELECT rows, CAST(0.7 AS DOUBLE) AS threshold, {prf_sql()}, tp, fp, tn, fn,
       {_auc_sql('pr', 'final_score', 'true_label')} AS auc,
       CASE WHEN rows >= 200 AND classes >= 2 THEN 'ok' ELSE 'insufficient_data' END AS status,
       CASE WHEN rows >= 200 AND classes >= 2 THEN 'ok' ELSE 'insufficient labeled data' END AS reason
FROM (SELECT count(*) AS rows, count(DISTINCT true_label) AS classes,
             {conf_sql('true_label', 'CAST(final_score >= 0.7 AS INTEGER)')} FROM pr) a""",
                                      "decision_log", "txn_labels", extra=[_PERF_IN]), ops="A4 A5 A6 A21")
def a5_performance(spark, sf):
    return A.performance(perf_rows(spark, sf), t=C.PERF_THRESHOLD)


_LAB = ("lab", """
SELECT d.event_id, d.final_score, d.rules_score, d.champion_score, d.anomaly_score, d.served_by, l.label
FROM decisions1 d JOIN txn_labels l ON d.event_id = l.event_id""")


def labeled(spark, sf):
    d = X.decision_log(spark, sf, rescored=False)
    j = J.labeled_decisions(d, X.txn_labels(spark, sf))
    return j.select("event_id", "final_score", F.col("scores.rules").alias("rules_score"),
                    F.col("scores.champion").alias("champion_score"),
                    F.col("scores.anomaly").alias("anomaly_score"), "served_by", "label")


@register("a6_roc_auc", with_ctes(f"SELECT {_auc_sql('lab', 'final_score', 'label')} AS auc",
                                  "decisions1", "txn_labels", extra=[_LAB]), ops="A6 W9")
def a6_roc_auc(spark, sf):
    return A.roc_auc(labeled(spark, sf), "final_score", "label")


def _pr_sql(src, score, label):
    return f"""SELECT *, {div_sql('tp', 'tp + fp')} AS precision, {div_sql('tp', 'P')} AS recall FROM (
  SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
         sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp, sum(pos) OVER () AS P
  FROM (SELECT {score} AS s, count(*) FILTER (WHERE {label} = 1) AS pos, count(*) FILTER (WHERE {label} = 0) AS neg
        FROM {src} WHERE {score} IS NOT NULL AND {label} IS NOT NULL GROUP BY 1) st) c"""


@register("a7_pr_auc", with_ctes(f"""
SELECT round(sum(CAST(pos AS DOUBLE) / CAST(P AS DOUBLE) * precision), 9) AS pr_auc
FROM ({_pr_sql('lab', 'champion_score', 'label')}) t""", "decisions1", "txn_labels", extra=[_LAB]), ops="A7 W9")
def a7_pr_auc(spark, sf):
    return A.pr_auc(labeled(spark, sf), "champion_score", "label")


@register("a8_best_f1_threshold", with_ctes(f"""
SELECT coalesce(max(s), 0.5) AS threshold, max(f1) AS f1 FROM (
  SELECT s, f1 FROM (SELECT *, (CAST(2 AS DOUBLE) * precision * recall) / (precision + recall + 1e-12) AS f1
                     FROM ({_pr_sql('lab', 'final_score', 'label')}) t)
  ORDER BY f1 DESC, s ASC LIMIT 1) b""", "decisions1", "txn_labels", extra=[_LAB]), ops="A8 W9")
def a8_best_f1_threshold(spark, sf):
    return A.best_f1_threshold(labeled(spark, sf), "final_score", "label")


@register("a9_precision_at_5p", with_ctes("""
SELECT avg(CAST(label AS DOUBLE)) AS precision_at FROM (
  SELECT label, row_number() OVER (ORDER BY final_score DESC, event_id) AS rn FROM lab) r
WHERE rn <= greatest(1, CAST(floor(0.05 * (SELECT count(*) FROM lab)) AS BIGINT))""",
                                          "decisions1", "txn_labels", extra=[_LAB]), ops="A9")
def a9_precision_at(spark, sf):
    return A.precision_at(labeled(spark, sf), 0.05, "final_score", "label")


@register("a10_fpr", with_ctes(f"""
SELECT {div_sql("count(*) FILTER (WHERE label = 0 AND final_score >= 0.7)", "count(*) FILTER (WHERE label = 0)")}
       AS fpr FROM lab""", "decisions1", "txn_labels", extra=[_LAB]), ops="A10")
def a10_fpr(spark, sf):
    return A.fpr(labeled(spark, sf), 0.7, "final_score", "label")


@register("a11_class_balance", with_ctes("""
SELECT positives, negatives,
       CASE WHEN positives > 0 THEN CAST(negatives AS DOUBLE) / CAST(positives AS DOUBLE) ELSE 1.0 END
       AS scale_pos_weight
FROM (SELECT count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives
      FROM lab) c""", "decisions1", "txn_labels", extra=[_LAB]), ops="A11")
def a11_class_balance(spark, sf):
    return A.class_balance(labeled(spark, sf), "label")


@register("a11_class_weight", with_ctes("""
SELECT label, CASE WHEN label = 1 THEN (SELECT CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE)
                                               / CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) FROM lab)
                   ELSE 1.0 END AS weight, count(*) AS n FROM lab GROUP BY 1, 2""",
                                        "decisions1", "txn_labels", extra=[_LAB]), ops="A11")
def a11_class_weight(spark, sf):
    w = A.with_class_weight(labeled(spark, sf), "label")
    return w.groupBy("label", "weight").agg(F.count(F.lit(1)).alias("n"))


_FEATS = [n for n, _, _ in C.VELOCITY_FEATURES] + C.CONSTANT_FEATURES


@register("a12_fingerprint", with_ctes(f"""
SELECT count(*) AS rows, min(event_ts) AS min_ts, max(event_ts) AS max_ts, '{",".join(_FEATS)}' AS features,
       sha256('[{", ".join(chr(34) + f + chr(34) for f in _FEATS)}]') AS feature_hash
FROM txn_validated""", "txn_validated"), ops="A12 P36")
def a12_fingerprint(spark, sf):
    return A.fingerprint(X.txn_validated(spark, sf), "event_ts", _FEATS)


@register("a13_compare_models", with_ctes(f"""
SELECT coalesce(served_by, 'unknown') AS model, count(*) AS count, round(avg(final_score), 6) AS avg_score,
       {div_sql("count(*) FILTER (WHERE decision = 'block')", "count(*)")} AS block_rate,
       {div_sql("count(*) FILTER (WHERE decision = 'review')", "count(*)")} AS review_rate,
       {div_sql("count(*) FILTER (WHERE decision = 'step_up')", "count(*)")} AS step_up_rate
FROM decision_log
WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 60 MINUTE AND created_at < TIMESTAMP '{AS_OF}'
GROUP BY 1""", "decision_log"), ops="A13")
def a13_compare_models(spark, sf):
    d = X.decision_log(spark, sf).where(P.in_window("created_at", AS_OF, 1))
    return A.compare_models(d)


@register("a13_compare_models_filtered", with_ctes(f"""
SELECT coalesce(served_by, 'unknown') AS model, count(*) AS count, round(avg(final_score), 6) AS avg_score,
       CAST(0 AS DOUBLE) AS block_rate, CAST(1 AS DOUBLE) AS review_rate, CAST(0 AS DOUBLE) AS step_up_rate
FROM decision_log WHERE decision = 'review' GROUP BY 1""", "decision_log"), ops="A13")
def a13_compare_models_filtered(spark, sf):
    return A.compare_models(X.decision_log(spark, sf), decision="review")


@register("a14_compare_models_labeled", with_ctes(f"""
SELECT coalesce(served_by, 'unknown') AS model,
       {div_sql('tp', 'tp + fp')} AS precision, {div_sql('tp', 'tp + fn')} AS recall, count
FROM (SELECT served_by, {conf_sql('label', 'CAST(final_score >= 0.7 AS INTEGER)')}, count(*) AS count
      FROM lab GROUP BY 1) g""", "decisions1", "txn_labels", extra=[_LAB]), ops="A14 J6")
def a14_compare_models_labeled(spark, sf):
    return A.compare_models_labeled(labeled(spark, sf))


@register("a15_decision_distribution", with_ctes("""
SELECT decision, count(*) AS count,
       CAST(count(*) AS DOUBLE) / CAST(greatest((SELECT count(*) FROM decision_log), 1) AS DOUBLE) AS share
FROM decision_log GROUP BY 1""", "decision_log"), ops="A15")
def a15_decision_distribution(spark, sf):
    return A.decision_distribution(X.decision_log(spark, sf))


@register("a16_latency_summary", with_ctes("""
SELECT round(avg(latency_total), 6) AS avg_ms,
       (SELECT latency_total FROM decision_log ORDER BY latency_total
        LIMIT 1 OFFSET (SELECT least(count(*) - 1, CAST(floor(0.95 * count(*)) AS BIGINT)) FROM decision_log))
       AS p95_ms
FROM decision_log""", "decision_log"), ops="A16")
def a16_latency_summary(spark, sf):
    d = X.decision_log(spark, sf).select(F.col("latency_ms.total").alias("latency_total"))
    return A.latency_summary(d)


@register("a17_serving_counters", with_ctes("""
SELECT 'requests' AS counter, count(*) AS value FROM decision_log
UNION ALL SELECT 'fallback:rules_only', count(*) FROM decision_log WHERE fb_rules_only HAVING count(*) > 0
UNION ALL SELECT 'fallback:champion_missing', count(*) FROM decision_log WHERE fb_champion_missing
  HAVING count(*) > 0
UNION ALL SELECT 'fallback:anomaly_missing', count(*) FROM decision_log WHERE fb_anomaly_missing
  HAVING count(*) > 0""", "decision_log"), ops="A17")
def a17_serving_counters(spark, sf):
    return A.serving_counters(X.decision_log(spark, sf))


@register("a18_table_counts", with_ctes("""
SELECT 'txn_validated' AS "table", count(DISTINCT event_id) AS rows
FROM msg_flags WHERE NOT is_dead AND len(failed_raw) = 0
UNION ALL SELECT 'txn_quarantine', count(DISTINCT event_id) FROM msg_flags WHERE NOT is_dead AND len(failed_raw) > 0
UNION ALL SELECT 'dead_letter', count(*) FROM msg_flags WHERE is_dead""", "msg_flags"), ops="A18")
def a18_table_counts(spark, sf):
    v = M.validate_messages(M.parse_messages(X.raw_messages(spark, sf)))
    return A.table_counts({
        "txn_validated": v.where("is_valid").select("event_id").distinct(),
        "txn_quarantine": v.where(~F.col("is_dead") & ~F.col("is_valid")).select("event_id").distinct(),
        "dead_letter": v.where("is_dead")})


# ------------------------------------------------------------ model evaluation / champion
def _eval_sql(score: str) -> str:
    src = "lab"
    return f"""
SELECT '{score}' AS model,
       coalesce({_auc_sql(src, score, 'label')}, 0.0) AS roc_auc,
       coalesce((SELECT round(sum(CAST(pos AS DOUBLE) / CAST(P AS DOUBLE) * precision), 9)
                 FROM ({_pr_sql(src, score, 'label')}) t), 0.0) AS pr_auc,
       {prf_sql()},
       (SELECT avg(CAST(label AS DOUBLE)) FROM (
          SELECT label, row_number() OVER (ORDER BY {score} DESC, event_id) AS rn FROM {src}) r
        WHERE rn <= greatest(1, CAST(floor(0.05 * (SELECT count(*) FROM {src})) AS BIGINT))) AS precision_at_5p,
       {div_sql('fp', 'fp + tn')} AS fpr
FROM (SELECT {conf_sql('label', f'CAST({score} >= 0.5 AS INTEGER)')} FROM {src}) c"""


_MODELS = ["rules_score", "champion_score", "anomaly_score"]


def _evals(spark, sf):
    lab = labeled(spark, sf)
    out = None
    for m in _MODELS:
        s = lab.where(F.col(m).isNotNull())
        e = A.evaluate_scores(s, 0.5, score=m, label="label").select(F.lit(m).alias("model"), "*")
        out = e if out is None else out.unionByName(e)
    return out


_EVAL_SRC = " UNION ALL ".join(
    _eval_sql(m).replace("FROM lab", f"FROM (SELECT * FROM lab WHERE {m} IS NOT NULL)")
    .replace(" lab) ", f" (SELECT * FROM lab WHERE {m} IS NOT NULL)) ") for m in _MODELS)


@register("m10_evaluate_scores", with_ctes(_EVAL_SRC, "decisions1", "txn_labels", extra=[_LAB]), ops="M10 A6-A10")
def m10_evaluate_scores(spark, sf):
    return _evals(spark, sf)


@register("m11_choose_champion", with_ctes(f"""
SELECT model AS champion FROM ev
WHERE fpr <= 0.2 OR NOT EXISTS (SELECT 1 FROM ev WHERE fpr <= 0.2)
ORDER BY pr_auc DESC, CASE model WHEN 'rules_score' THEN 0 WHEN 'champion_score' THEN 1 ELSE 2 END LIMIT 1""",
                                          "decisions1", "txn_labels", extra=[_LAB, ("ev", _EVAL_SRC)]),
          ops="M11")
def m11_choose_champion(spark, sf):
    from ..operators.models import choose_champion
    order = F.when(F.col("model") == "rules_score", 0).when(F.col("model") == "champion_score", 1).otherwise(2)
    return choose_champion(_evals(spark, sf).withColumn("_order", order), order_col="_order")


@register("m12_stratified_split", with_ctes("""
SELECT label, split, count(*) AS n FROM (
  SELECT label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY sha256('42:' || event_id), event_id) - 1
                         < floor(count(*) OVER (PARTITION BY label) * 0.8) THEN 'train' ELSE 'test' END AS split
  FROM lab) s GROUP BY 1, 2""", "decisions1", "txn_labels", extra=[_LAB]), ops="M12")
def m12_stratified_split(spark, sf):
    s = stratified_split(labeled(spark, sf), "label", 0.8, 42, key="event_id")
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))
