"""Bucketed prefix kernel vs pandas; AUC vs brute-force pair counting; AP / F1 / precision@k."""

import random

import pandas as pd
from pyspark.sql import functions as F

from riskspark.operators import metrics as A
from riskspark.operators.prefix import cumulative, global_rank


def _scores(spark, n=600, seed=7):
    rnd = random.Random(seed)
    rows = [(str(i), round(rnd.random(), 2), int(rnd.random() < 0.3)) for i in range(n)]  # many ties
    return spark.createDataFrame(rows, "event_id string, score double, label int"), rows


def test_cumulative_matches_pandas(spark):
    df, rows = _scores(spark)
    got = cumulative(df, "score", ["label"], n_buckets=16).select("score", "cum_label").distinct().toPandas()
    pdf = pd.DataFrame(rows, columns=["id", "score", "label"]).groupby("score")["label"].sum().cumsum()
    for _, r in got.iterrows():
        assert r["cum_label"] == pdf.loc[r["score"]]


def test_global_rank_is_permutation(spark):
    df, rows = _scores(spark)
    r = global_rank(df, ["score", "event_id"], n_buckets=8).orderBy("_rank").collect()
    assert [x["_rank"] for x in r] == list(range(len(rows)))
    expect = sorted(rows, key=lambda t: (t[1], t[0]))
    assert [x["event_id"] for x in r] == [t[0] for t in expect]


def test_auc_brute_force(spark):
    df, rows = _scores(spark, 300)
    pos = [s for _, s, y in rows if y == 1]
    neg = [s for _, s, y in rows if y == 0]
    num = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    auc = A.roc_auc(df, "score", "label").first()["auc"]
    assert abs(auc - num / (len(pos) * len(neg))) < 1e-12


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([("1", 0.2, 1), ("2", 0.4, 1)], "event_id string, score double, label int")
    assert A.roc_auc(df, "score", "label").first()["auc"] is None


def test_average_precision_and_best_f1(spark):
    df, rows = _scores(spark, 200)
    pdf = pd.DataFrame(rows, columns=["id", "s", "y"])
    P = pdf.y.sum()
    ap, best, best_t = 0.0, -1.0, None
    for s in sorted(pdf.s.unique()):
        sel = pdf[pdf.s >= s]
        tp, fp = sel.y.sum(), (1 - sel.y).sum()
        prec, rec = tp / (tp + fp), tp / P
        ap += pdf[pdf.s == s].y.sum() / P * prec
        f1 = 2 * prec * rec / (prec + rec + 1e-12)
        if f1 > best:
            best, best_t = f1, s
    assert abs(A.pr_auc(df, "score", "label").first()["pr_auc"] - ap) < 1e-8
    assert A.best_f1_threshold(df, "score", "label").first()["threshold"] == best_t


def test_zero_division_slices(spark):
    df = spark.createDataFrame([("US", 0.1, 0, "approve"), ("US", 0.2, 0, "approve")],
                               "country string, final_score double, label int, decision string")
    r = A.slice_metrics(df, dims=["country"]).first()
    assert (r["precision"], r["recall"], r["f1"], r["count"]) == (0.0, 0.0, 0.0, 2)


def test_precision_at_k(spark):
    df, rows = _scores(spark, 100)
    k = max(1, int(100 * 0.05))
    top = sorted(rows, key=lambda t: (-t[1], t[0]))[:k]
    got = A.precision_at(df, 0.05, "score", "label").first()["precision_at"]
    assert abs(got - sum(t[2] for t in top) / k) < 1e-12


def test_auc_beyond_bigint(spark):
    """Counts whose products leave the bigint range."""
    import riskspark.operators.metrics as A

    big = 4_000_000_000
    t = spark.createDataFrame([(0.1, 0, big), (0.5, big // 2, 0), (0.9, big // 2, 0)], "s double, pos long, neg long")
    original = A.score_table
    A.score_table = lambda df, score, label: df
    try:
        assert A.roc_auc(t, "s", "pos").first()["auc"] == 1.0
    finally:
        A.score_table = original


def test_one_class_and_no_rows(spark):
    import riskspark.operators.metrics as A

    for rows in ([(0.1, 0, "a"), (0.4, 0, "b")], [(0.1, 1, "a")], []):
        d = spark.createDataFrame(rows, "score double, label int, event_id string")
        ap = A.pr_auc(d, "score").first()["pr_auc"]
        assert ap == (1.0 if rows and rows[0][1] else 0.0)
        assert A.roc_auc(d, "score").first()["auc"] is None


def test_precision_at_with_hot_scores(spark):
    import riskspark.operators.metrics as A

    rows = [(0.5, i % 4 == 0, f"e{i:04d}") for i in range(300)] + [(0.9, 1, f"x{i}") for i in range(5)] + [(0.1, 0, f"y{i}") for i in range(95)]
    d = spark.createDataFrame([(s, int(v), e) for s, v, e in rows], "final_score double, label int, event_id string")
    top = sorted(rows, key=lambda r: (-r[0], r[2]))[:40]
    assert abs(A.precision_at(d, 0.1).first()["precision_at"] - sum(r[1] for r in top) / 40) < 1e-12


def test_metrics_are_null_below_the_guard(spark):
    import riskspark.operators.metrics as A

    d = spark.createDataFrame([(0.9, 1), (0.1, 0)], "final_score double, true_label int")
    r = A.performance(d).first()
    assert r["status"] == "insufficient_data" and r["f1"] is None and r["auc"] is None and r["rows"] == 2


def test_drift_with_empty_windows_and_methods(spark):
    import riskspark.operators.drift as D

    both = [(w, float(i % 17 + (w == "cur")), str(i % 3)) for i in range(60) for w in ("ref", "cur")]
    schema = "win string, x double, k string"
    for rows in ([], [("cur", 1.0, "a")], [("ref", 1.0, "a")]):
        d = spark.createDataFrame(rows, schema)
        assert D.drift_report(d, ["x"], ["k"]).count() == 0
        assert D.ks_statistic(d, "x").first()["statistic"] is None
        counts = D.window_counts(d, ["k"])
        for f in (D.chi2_statistic, D.z_statistic, D.js_distance):
            f(counts).collect()
    d = spark.createDataFrame(both, schema)
    assert {r.method for r in D.drift_report(d, ["x"], ["k"], method="tests").collect()} == {"ks", "chisquare"}
    assert {r.method for r in D.drift_report(d, ["x"], ["k"], method="distances").collect()} == {"wasserstein", "jensenshannon"}
    assert D.drift_report(d, ["x"], ["k"], min_rows=200).count() == 0


def test_unknown_rules_and_extra_columns(spark):
    import pytest

    import riskspark.functions.expectations as V

    with pytest.raises(ValueError, match="unique"):
        V.suite_from_json({"expectations": [{"type": "expect_column_values_to_be_unique", "kwargs": {"column": "x"}}]})
    d = spark.createDataFrame([(1, 2)], "a int, b int")

    def valid(columns, **kw):
        suite = V.suite_from_json({"expectations": [{"type": "expect_table_columns_to_match_set", "kwargs": {"column_set": columns, **kw}}]})
        return V.validate(d, suite).first()["is_valid"]

    assert valid(["a", "b"]) and not valid(["a"]) and not valid(["a", "b", "c"]) and valid(["a"], exact_match=False)
    assert V.validation_report(d, V.suite_from_json({"expectations": [
        {"type": "expect_column_values_to_be_between", "kwargs": {"column": "a", "min_value": 5}}]})).first()["unexpected"] == 1


def test_forest_sample_is_bounded_and_spread(spark):
    from pyspark.sql import functions as F

    from riskspark.operators.iforest import _sample

    d = spark.range(40000).select(F.col("id").alias("event_id"), F.col("id").cast("double").alias("x"))
    per = {r["tree"]: r["n"] for r in _sample(d, ["x"], "event_id", 10, 256, 1).groupBy("tree").agg(F.count("*").alias("n")).collect()}
    assert len(per) == 10 and all(256 <= n <= 450 for n in per.values())


def test_split_mode_is_the_callers_choice(spark):
    from riskspark.operators.windows import time_split

    d = spark.createDataFrame([(str(i), i, i % 2) for i in range(10)], "event_id string, event_ts long, label int")
    got = {r.event_id: r.split for r in time_split(d, "event_ts").collect()}
    assert [got[str(i)] for i in range(10)] == ["train"] * 8 + ["test"] * 2
    assert time_split(d, "event_ts", label="label", mode="stratified").count() == 10
