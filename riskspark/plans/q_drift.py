"""Queries for drift (D1-D8, U3), volume spike (V16) and the feedback loop."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar as P
from ..operators import drift as D
from ..operators import metrics as A
from ..operators.windows import flag_volume_spike
from ..session import write_scratch
from ..sources import fixtures as X
from . import feedback as FB
from .oracle import with_ctes
from .q_functions import proxy_sql
from .q_metrics import _PERF_IN, conf_sql, prf_sql
from .registry import register

AS_OF = X.AS_OF
AS_OF_L = X.AS_OF_LABELS
_PL = ("coalesce(TRY_CAST(json_extract_string(payload, '$.is_fraud') AS INTEGER), "
       "TRY_CAST(json_extract_string(payload, '$.label') AS INTEGER), "
       "TRY_CAST(json_extract_string(payload, '$.isFraud') AS INTEGER))")


@register("v16_volume_spike", with_ctes("""
SELECT event_id, trailing_count, trailing_count > 40 AS volume_spike FROM (
  SELECT event_id, count(*) OVER (ORDER BY event_ts RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW)
         AS trailing_count FROM txn) t""", "txn"), ops="V16")
def v16_volume_spike(spark, sf):
    return flag_volume_spike(X.txn(spark, sf), limit=40).select("event_id", "trailing_count", "volume_spike")


# ------------------------------------------------------------------ drift
def tagged(spark, sf):
    d = X.decision_log(spark, sf)
    return d.withColumn("win", P.window_tag("created_at", AS_OF, 6, 1)).where(F.col("win").isNotNull())


_TAG = ("tg", f"""
SELECT *, CASE WHEN created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR THEN 'cur' ELSE 'ref' END AS win
FROM decision_log
WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 HOUR AND created_at < TIMESTAMP '{AS_OF}'""")


def _curve_sql(col):
    return f"""
SELECT x, lead(x) OVER (ORDER BY x) AS x_next,
       sum(ref) OVER (ORDER BY x) / sum(ref) OVER () AS Fr, sum(cur) OVER (ORDER BY x) / sum(cur) OVER () AS Fc,
       sum(ref) OVER () AS n_ref, sum(cur) OVER () AS n_cur
FROM (SELECT CAST({col} AS DOUBLE) AS x, count(*) FILTER (WHERE win = 'ref') AS ref,
             count(*) FILTER (WHERE win = 'cur') AS cur FROM tg WHERE {col} IS NOT NULL GROUP BY 1) t"""


@register("d1_ks_statistic", with_ctes(" UNION ALL ".join(f"""
SELECT '{c}' AS column, max(abs(Fr - Fc)) AS statistic, CAST(max(n_ref) AS BIGINT) AS n_ref,
       CAST(max(n_cur) AS BIGINT) AS n_cur FROM ({_curve_sql(c)}) c""" for c in ["amount", "final_score"]),
                                       "decision_log", extra=[_TAG]), ops="D1 W9")
def d1_ks_statistic(spark, sf):
    t = tagged(spark, sf)
    return D.ks_statistic(t, "amount").unionByName(D.ks_statistic(t, "final_score"))


@register("d4_wasserstein", with_ctes(f"""
SELECT 'amount' AS column,
       round(sum(coalesce(x_next - x, 0) * abs(Fr - Fc))
             / (SELECT stddev_pop(amount) FROM tg WHERE win = 'ref'), 6) AS statistic
FROM ({_curve_sql('amount')}) c""", "decision_log", extra=[_TAG]), ops="D4")
def d4_wasserstein(spark, sf):
    return D.wasserstein_norm(tagged(spark, sf), "amount")


def _counts_sql(cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) FILTER (WHERE win = 'ref') AS ref, "
        f"count(*) FILTER (WHERE win = 'cur') AS cur FROM tg WHERE {c} IS NOT NULL GROUP BY 2" for c in cols)


@register("d2_chi2_statistic", with_ctes(f"""
SELECT "column", n_ref, n_cur, k,
       round(sum(CASE WHEN e > 0 THEN (cur - e) * (cur - e) / e WHEN cur > 0 THEN 'inf'::DOUBLE ELSE 0 END), 6)
       AS statistic
FROM (SELECT c.*, t.n_ref, t.n_cur, t.k,
             CAST(c.ref AS DOUBLE) * CAST(t.n_cur AS DOUBLE) / CAST(t.n_ref AS DOUBLE) AS e
      FROM cnt c JOIN (SELECT "column", CAST(sum(ref) AS BIGINT) AS n_ref, CAST(sum(cur) AS BIGINT) AS n_cur,
                              count(*) AS k FROM cnt GROUP BY 1) t ON c.column = t.column) j
GROUP BY "column", n_ref, n_cur, k""", "decision_log",
                                         extra=[_TAG, ("cnt", _counts_sql(["country", "decision"]))]), ops="D2")
def d2_chi2_statistic(spark, sf):
    return D.chi2_statistic(D.window_counts(tagged(spark, sf), ["country", "decision"]))


@register("d3_z_statistic", with_ctes("""
SELECT c.column, t.n_ref, t.n_cur,
       round(CASE WHEN se > 0 THEN (p1 - p2) / se ELSE 0 END, 6) AS statistic
FROM (SELECT c.*, CAST(c.ref AS DOUBLE) / t.n_ref AS p1, CAST(c.cur AS DOUBLE) / t.n_cur AS p2,
             sqrt(((c.ref + c.cur) / (t.n_ref + t.n_cur)) * (1.0 - (c.ref + c.cur) / (t.n_ref + t.n_cur))
                  * (1.0 / t.n_ref + 1.0 / t.n_cur)) AS se
      FROM cnt c JOIN (SELECT "column", CAST(sum(ref) AS BIGINT) AS n_ref, CAST(sum(cur) AS BIGINT) AS n_cur,
                              min(value) AS first FROM cnt GROUP BY 1) t
        ON c.column = t.column AND c.value = t.first) c
JOIN (SELECT "column", CAST(sum(ref) AS BIGINT) AS n_ref, CAST(sum(cur) AS BIGINT) AS n_cur FROM cnt GROUP BY 1) t
  ON c.column = t.column""", "decision_log", extra=[_TAG, ("cnt", _counts_sql(["channel"]))]), ops="D3")
def d3_z_statistic(spark, sf):
    return D.z_statistic(D.window_counts(tagged(spark, sf), ["channel"]))


@register("d5_js_distance", with_ctes(f"""
SELECT "column", round(sqrt(greatest(sum(p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2, 0)), 6)
       AS statistic
FROM (SELECT "column", p / sum(p) OVER (PARTITION BY "column") AS p, q / sum(q) OVER (PARTITION BY "column") AS q
      FROM (SELECT c.column,
                   CASE WHEN ref > 0 THEN CAST(ref AS DOUBLE) / n_ref ELSE {D.JS_ZERO} END AS p,
                   CASE WHEN cur > 0 THEN CAST(cur AS DOUBLE) / n_cur ELSE {D.JS_ZERO} END AS q
            FROM cnt c JOIN (SELECT "column", sum(ref) AS n_ref, sum(cur) AS n_cur FROM cnt GROUP BY 1) t
              ON c.column = t.column) a) b
GROUP BY 1""", "decision_log", extra=[_TAG, ("cnt", _counts_sql(["country", "decision", "channel"]))]),
          ops="D5")
def d5_js_distance(spark, sf):
    return D.js_distance(D.window_counts(tagged(spark, sf), ["country", "decision", "channel"]))


@register("d8_drift_status", with_ctes("""
SELECT count(*) FILTER (WHERE win = 'ref') AS ref_rows, count(*) FILTER (WHERE win = 'cur') AS cur_rows,
       CASE WHEN count(*) FILTER (WHERE win = 'ref') = 0 AND count(*) FILTER (WHERE win = 'cur') >= 200
            THEN 'fallback_split'
            WHEN count(*) FILTER (WHERE win = 'ref') < 200 OR count(*) FILTER (WHERE win = 'cur') < 200
            THEN 'insufficient_data' ELSE 'ok' END AS status
FROM tg""", "decision_log", extra=[_TAG]), ops="D8")
def d8_drift_status(spark, sf):
    return D.drift_status(tagged(spark, sf))


@register("u3_fallback_split", with_ctes("""
SELECT win, count(*) AS n, min(created_at) AS first_at, max(created_at) AS last_at FROM fb GROUP BY win""",
                                         "decision_log", extra=[
    ("cur1", f"""SELECT event_id, created_at, row_number() OVER (ORDER BY created_at, event_id) AS rn
FROM decision_log WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AND created_at < TIMESTAMP '{AS_OF}'"""),
    ("fb", """SELECT created_at, CASE WHEN rn - 1 < CAST(floor(0.6 * (SELECT count(*) FROM cur1)) AS BIGINT)
THEN 'ref' ELSE 'cur' END AS win FROM cur1""")]), ops="U3 D8")
def u3_fallback_split(spark, sf):
    d = X.decision_log(spark, sf)
    # only the current hour exists: the reference window (the 6 h before) is cut away
    t = d.where(P.in_window("created_at", AS_OF, 1)).withColumn("win", F.lit("cur"))
    s = D.fallback_split(t, order="created_at")
    return s.groupBy("win").agg(F.count(F.lit(1)).alias("n"), F.min("created_at").alias("first_at"),
                                F.max("created_at").alias("last_at"))


#: columns of the three reports: report, column, its SQL, whether it is a number
_REPORTED = ([("input_drift", c, c, True) for c in ("amount", "drift_phase")] + [("input_drift", c, c, False) for c in ("country", "channel")]
             + [("feature_drift", c, f"f_{c}", True) for c in FB.FEATURE_NUMERIC]
             + [("prediction_drift", "final_score", "final_score", True), ("prediction_drift", "decision", "decision", False)])


def _gamma_q_sql(a, x):
    return (f"CASE WHEN {x} <= 0 THEN 1.0 WHEN {x} > {D.TAIL} THEN 0.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, 1500), "
            f"lambda n: exp(-({x}) + ({a} + n) * ln({x}) - lgamma({a} + n + 1))))) END")


def _report_ctes(tests: bool) -> list[tuple[str, str]]:
    """The drift reports over ``tg`` as DuckDB views, ending in ``rep`` (report, column, method, statistic, p_value, drifted)."""
    vals = " UNION ALL ".join(f"SELECT win, '{r}' AS report, '{c}' AS \"column\", CAST({sql} AS VARCHAR) AS value, "
                              f"{f'CAST({sql} AS DOUBLE)' if number else 'CAST(NULL AS DOUBLE)'} AS x FROM tg" for r, c, sql, number in _REPORTED)
    names = ", ".join(f"('{r}', '{c}')" for r, c, _, _ in _REPORTED)
    ks = ("list_sum(list_transform(range(1, 101), lambda i: (CASE WHEN i % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * i * i * lam * lam)))")
    if tests:
        method = "CASE WHEN kind = 'num' THEN 'ks' WHEN k = 2 THEN 'z' ELSE 'chisquare' END"
        stat = "CASE WHEN kind = 'num' THEN ks WHEN k = 2 THEN z ELSE chi2 END"
        p = (f"CASE method WHEN 'ks' THEN CASE WHEN lam < 1e-3 THEN 1.0 ELSE least(greatest({ks}, 0.0), 1.0) END "
             f"WHEN 'z' THEN {_gamma_q_sql('0.5', 's * s / 2')} ELSE CASE WHEN k < 2 THEN 1.0 ELSE {_gamma_q_sql('((k - 1) / 2)', 's / 2')} END END")
        drifted = f"p_value < {C.DRIFT_P_VALUE}"
    else:
        method = "CASE WHEN kind = 'num' THEN 'wasserstein' ELSE 'jensenshannon' END"
        stat = "CASE WHEN kind = 'num' THEN wasserstein ELSE js END"
        p, drifted = "CAST(NULL AS DOUBLE)", f"statistic >= {C.DRIFT_DISTANCE}"
    return [
        _TAG, ("vals", vals), ("names", f"SELECT * FROM (VALUES {names}) v(report, \"column\")"),
        ("cnt", """SELECT "column", value, x, CAST(count(*) FILTER (WHERE win = 'ref') AS DOUBLE) AS ref,
CAST(count(*) FILTER (WHERE win = 'cur') AS DOUBLE) AS cur FROM vals WHERE value IS NOT NULL GROUP BY 1, 2, 3"""),
        ("summ", """SELECT "column", sum(ref) AS n_ref, sum(cur) AS n_cur, count(*) AS k, sum(ref * x) / sum(ref) AS mean, min(value) AS first,
CASE WHEN count(x) > 0 AND count(*) > 5 THEN 'num' ELSE 'cat' END AS kind FROM cnt GROUP BY 1"""),
        ("curve", """SELECT c.column, c.x, c.ref, s.mean, s.n_ref, lead(c.x) OVER w AS x_next,
abs(sum(c.ref) OVER w / s.n_ref - sum(c.cur) OVER w / s.n_cur) AS gap
FROM cnt c JOIN summ s ON c.column = s.column AND s.kind = 'num' WINDOW w AS (PARTITION BY c.column ORDER BY c.x)"""),
        ("nstat", """SELECT "column", ks, round(CASE WHEN sd > 0 THEN w / sd ELSE w END, 6) AS wasserstein FROM (
SELECT "column", max(gap) AS ks, sum(coalesce(x_next - x, 0) * gap) AS w, sqrt(sum(ref * (x - mean) * (x - mean)) / max(n_ref)) AS sd FROM curve GROUP BY 1) t"""),
        ("cstat", f"""SELECT "column", round(sum(CASE WHEN e > 0 THEN (cur - e) * (cur - e) / e WHEN cur > 0 THEN 'inf'::DOUBLE ELSE 0 END), 6) AS chi2,
round(max(z), 6) AS z, round(sqrt(greatest(sum(p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2, 0)), 6) AS js FROM (
  SELECT *, p0 / sum(p0) OVER g AS p, q0 / sum(q0) OVER g AS q FROM (
    SELECT c.column, c.cur, c.ref * s.n_cur / s.n_ref AS e,
      CASE WHEN c.ref > 0 THEN c.ref / s.n_ref ELSE {D.JS_ZERO} END AS p0, CASE WHEN c.cur > 0 THEN c.cur / s.n_cur ELSE {D.JS_ZERO} END AS q0,
      CASE WHEN c.value = s.first THEN CASE WHEN (c.ref + c.cur) < (s.n_ref + s.n_cur) THEN (c.ref / s.n_ref - c.cur / s.n_cur)
        / sqrt(((c.ref + c.cur) / (s.n_ref + s.n_cur)) * (1.0 - (c.ref + c.cur) / (s.n_ref + s.n_cur)) * (1.0 / s.n_ref + 1.0 / s.n_cur)) ELSE 0 END END AS z
    FROM cnt c JOIN summ s ON c.column = s.column AND s.kind = 'cat') a WINDOW g AS (PARTITION BY "column")) b GROUP BY 1"""),
        ("rep0", f"""SELECT n.report, n.column, k, {method} AS method, coalesce({stat}, 0) AS s,
(sqrt(n_ref * n_cur / (n_ref + n_cur)) + 0.12 + 0.11 / sqrt(n_ref * n_cur / (n_ref + n_cur))) * ks AS lam
FROM names n LEFT JOIN summ USING ("column") LEFT JOIN nstat USING ("column") LEFT JOIN cstat USING ("column")"""),
        ("rep", f"""SELECT report, "column", method, statistic, p_value, {drifted} AS drifted FROM (
SELECT *, s AS statistic, {p} AS p_value FROM rep0) x WHERE (SELECT least(count(*) FILTER (WHERE win = 'ref'), count(*) FILTER (WHERE win = 'cur')) FROM tg) >= {C.MIN_ROWS_DRIFT}"""),
    ]


_REPORT_SQL = 'SELECT report, "column", method, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, drifted FROM rep'


def _report(spark, sf, method):
    r = FB.all_reports(FB.drift_reports(X.decision_log(spark, sf), AS_OF, method=method))
    return r.withColumn("statistic", F.round("statistic", 6)).withColumn("p_value", F.round("p_value", 6))


@register("d7_drift_report", with_ctes(_REPORT_SQL, "decision_log", extra=_report_ctes(False)), ops="D4 D5 D7")
def d7_drift_report(spark, sf):
    return _report(spark, sf, "distances")


@register("d7_drift_tests", with_ctes(_REPORT_SQL, "decision_log", extra=_report_ctes(True)), ops="D1 D2 D3 D7")
def d7_drift_tests(spark, sf):
    return _report(spark, sf, "tests")


_DATASET_SQL = f"""
SELECT report, count(*) AS columns, count(*) FILTER (drifted) AS drifted_columns, count(*) FILTER (drifted) / count(*) AS drift_share,
       count(*) FILTER (drifted) / count(*) >= {C.DRIFT_SHARE} AS dataset_drift FROM rep GROUP BY 1"""


@register("d6_dataset_drift", with_ctes(_DATASET_SQL, "decision_log", extra=_report_ctes(False)), ops="D6 F3")
def d6_dataset_drift(spark, sf):
    reps = FB.drift_reports(X.decision_log(spark, sf), AS_OF)
    return FB.all_reports({name: D.dataset_drift(r) for name, r in reps.items()})


@register("f3_drift_detected", with_ctes(f"SELECT bool_or(dataset_drift) AS drift_detected FROM ({_DATASET_SQL}) d",
                                         "decision_log", extra=_report_ctes(False)), ops="F3")
def f3_drift_detected(spark, sf):
    return FB.drift_detected(FB.drift_reports(X.decision_log(spark, sf), AS_OF))


# ------------------------------------------------------------------ feedback
_CAND = ("cand", f"""
SELECT d.event_id, d.created_at, d.amount, d.channel, d.drift_phase, v.payload
FROM decision_log d LEFT JOIN txn_validated v ON d.event_id = v.event_id
WHERE d.event_id IS NOT NULL AND d.created_at <= TIMESTAMP '{AS_OF_L}' - INTERVAL 5 MINUTE
  AND NOT EXISTS (SELECT 1 FROM txn_labels l WHERE l.event_id = d.event_id)
ORDER BY d.created_at, d.event_id LIMIT 500""")


@register("f1_label_batch", with_ctes(f"""
SELECT event_id, coalesce({_PL}, {proxy_sql('event_id', 'drift_phase', 'amount', 'channel')}) AS label,
       CASE WHEN {_PL} IS NOT NULL THEN '{C.GROUND_TRUTH_SOURCE}' ELSE '{C.PROXY_SOURCE}' END AS label_source
FROM (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY created_at) = 1) c""",
                                      "decision_log", "txn_validated", "txn_labels", extra=[_CAND]),
          ops="F1 T1 J3 J4 P4 P8 S11 ST12")
def f1_label_batch(spark, sf):
    return FB.label_batch(X.decision_log(spark, sf), X.txn_validated(spark, sf), X.txn_labels(spark, sf),
                          AS_OF_L)


@register("a22_label_summary", with_ctes(f"""
SELECT TIMESTAMP '{AS_OF_L}' - INTERVAL 5 MINUTE AS cutoff, 500 AS requested, count(*) AS found,
       count(DISTINCT event_id) AS inserted FROM cand""",
                                         "decision_log", "txn_validated", "txn_labels", extra=[_CAND]), ops="A22 F1")
def a22_label_summary(spark, sf):
    return FB.label_summary(X.decision_log(spark, sf), X.txn_validated(spark, sf), X.txn_labels(spark, sf),
                            AS_OF_L)


_OVERALL_SQL = f"""
SELECT rows, {prf_sql()},
       CASE WHEN rows >= 200 AND classes >= 2 THEN 'ok' ELSE 'insufficient_data' END AS status,
       CASE WHEN rows >= 200 AND classes >= 2 THEN 'ok' ELSE 'insufficient labeled data' END AS reason
FROM (SELECT count(*) AS rows, count(DISTINCT true_label) AS classes,
             {conf_sql('true_label', 'CAST(final_score >= 0.7 AS INTEGER)')} FROM pr) a"""


@register("f2_health", with_ctes(f"""
SELECT CASE WHEN status = 'ok' THEN true END AS perf_ok, reason, rows FROM ({_OVERALL_SQL}) o""",
                                 "decision_log", "txn_labels", extra=[_PERF_IN]), ops="F2 A21")
def f2_health(spark, sf):
    overall, _ = FB.evaluate_performance(X.decision_log(spark, sf), X.txn_labels(spark, sf), AS_OF_L)
    return FB.health(overall)


@register("f2_latest_only", with_ctes(f"""
SELECT count(*) AS rows FROM (SELECT d.event_id FROM
  (SELECT event_id, max(created_at) AS created_at FROM decision_log GROUP BY 1) d
  JOIN txn_labels l ON d.event_id = l.event_id
  WHERE l.labeled_at >= TIMESTAMP '{AS_OF_L}' - INTERVAL 24 HOUR AND l.labeled_at < TIMESTAMP '{AS_OF_L}') x""",
                                      "decision_log", "txn_labels"), ops="F2 W8")
def f2_latest_only(spark, sf):
    rows = FB.performance_rows(X.decision_log(spark, sf), X.txn_labels(spark, sf), AS_OF_L, latest=True)
    return rows.agg(F.count(F.lit(1)).alias("rows"))


@register("f4_retrain_trigger", with_ctes(f"""
SELECT status = 'ok' AND rows >= 500 AND (f1 < 0.6 OR precision < 0.5) AS triggered,
       CASE WHEN status <> 'ok' THEN 'insufficient_perf_data' WHEN rows < 500 THEN 'min_labeled_rows_not_met'
            WHEN f1 < 0.6 OR precision < 0.5 THEN 'perf_floor_breached' ELSE 'ok' END AS reason,
       rows, f1, precision, false AS drift_detected, 500 AS min_labeled_rows
FROM ({_OVERALL_SQL}) o""", "decision_log", "txn_labels", extra=[_PERF_IN]), ops="F4")
def f4_retrain_trigger(spark, sf):
    overall, _ = FB.evaluate_performance(X.decision_log(spark, sf), X.txn_labels(spark, sf), AS_OF_L)
    return FB.retrain_trigger(overall, False)


@register("f4_retrain_trigger_drift", with_ctes(f"""
SELECT status = 'ok' AND rows >= 500 AS triggered,
       CASE WHEN status <> 'ok' THEN 'insufficient_perf_data' WHEN rows < 500 THEN 'min_labeled_rows_not_met'
            ELSE 'drift_detected' END AS reason,
       rows, f1, precision, true AS drift_detected, 500 AS min_labeled_rows
FROM ({_OVERALL_SQL}) o""", "decision_log", "txn_labels", extra=[_PERF_IN]), ops="F4")
def f4_retrain_trigger_drift(spark, sf):
    overall, _ = FB.evaluate_performance(X.decision_log(spark, sf), X.txn_labels(spark, sf), AS_OF_L)
    return FB.retrain_trigger(overall, True)


@register("f5_feedback_loop", ops="F5")
def f5_feedback_loop(spark, sf):
    # labels, evaluation, drift and candidate all read these: each is made and written once
    v = write_scratch(X.txn_validated(spark, sf), "validated")
    d = write_scratch(X.decision_log(spark, sf, validated=v), "decisions")
    lab = X.txn_labels(spark, sf, validated=v)
    drift = FB.drift_detected(FB.drift_reports(d, AS_OF))
    _, _, trig, _ = FB.feedback_loop(d, v, lab, AS_OF_L, drift)
    return trig


@register("f6_monitoring_run", ops="F6 A1 A20 D7 M14")
def f6_monitoring_run(spark, sf):
    from .q_metrics import slice_input
    from .q_models import _tree_model, window_frame
    model, _, _ = _tree_model(spark, sf)
    v = X.validated_features(spark, sf)
    return FB.monitoring_run(slice_input(spark, sf, features=v), X.decision_log(spark, sf, features=v), AS_OF, model, window_frame(spark, sf))
