"""Label status (P7), retrain trigger reasons (F4), performance guard (A21), decision distribution."""

from riskspark.functions import scalar as P
from riskspark.operators import metrics as A
from riskspark.plans import feedback as FB


def test_label_status_missing_and_ok(spark):
    none = spark.createDataFrame([("1", None), ("2", None)], "event_id string, label int")
    got = {(r["label"], r["label_status"]) for r in P.label_status(none).collect()}
    assert got == {(0, "missing")}
    some = spark.createDataFrame([("1", 1), ("2", None)], "event_id string, label int")
    got = sorted((r["label"], r["label_status"]) for r in P.label_status(some).collect())
    assert got == [(0, "ok"), (1, "ok")]


def _overall(spark, rows, status, f1, precision):
    return spark.createDataFrame([(rows, status, f1, precision)], "rows long, status string, f1 double, precision double")


def test_retrain_trigger_reasons(spark):
    cases = [
        ((100, "insufficient_data", 0.0, 0.0), False, (False, "insufficient_perf_data")),
        ((300, "ok", 0.9, 0.9), False, (False, "min_labeled_rows_not_met")),
        ((900, "ok", 0.5, 0.9), False, (True, "perf_floor_breached")),
        ((900, "ok", 0.9, 0.4), False, (True, "perf_floor_breached")),
        ((900, "ok", 0.9, 0.9), False, (False, "ok")),
        ((900, "ok", 0.9, 0.9), True, (True, "drift_detected")),
        ((900, "ok", 0.5, 0.4), True, (True, "drift_detected")),
    ]
    for args, drift, want in cases:
        r = FB.retrain_trigger(_overall(spark, *args), drift).first()
        assert (r["triggered"], r["reason"]) == want, (args, drift)


def test_performance_guard(spark):
    df = spark.createDataFrame([(0.9, 1)] * 50 + [(0.1, 0)] * 50, "final_score double, true_label int")
    r = A.performance(df, 0.7).first()
    assert r["status"] == "insufficient_data" and r["rows"] == 100 and r["auc"] is None
    one = spark.createDataFrame([(0.9, 1)] * 300, "final_score double, true_label int")
    assert A.performance(one, 0.7).first()["status"] == "insufficient_data"


def test_decision_distribution(spark):
    df = spark.createDataFrame([("block",), ("approve",), ("approve",), ("review",)], "decision string")
    got = {r["decision"]: (r["count"], r["share"]) for r in A.decision_distribution(df).collect()}
    assert got == {"block": (1, 0.25), "approve": (2, 0.5), "review": (1, 0.25)}
