"""As-of join edges (J1), drift statistics (D1-D5), isolation forest (M5), tree attribution."""

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from riskspark.operators import drift as D
from riskspark.operators.joins import asof_join, insert_ignore


def test_asof_ttl_and_ties(spark):
    t0 = datetime(2024, 1, 1)
    feats = spark.createDataFrame([
        (1, t0, t0 + timedelta(seconds=1), 1.0),
        (1, t0, t0 + timedelta(seconds=2), 2.0),            # same ts, newer created wins
        (1, t0 + timedelta(days=5), t0 + timedelta(days=5), 5.0),
        (2, t0, t0, 9.0),
    ], "user_id long, event_ts timestamp_ntz, validated_at timestamp_ntz, f double")
    ents = spark.createDataFrame([
        ("a", 1, t0), ("b", 1, t0 + timedelta(days=4)), ("c", 1, t0 + timedelta(days=5)),
        ("d", 2, t0 + timedelta(days=90)), ("e", 2, t0 + timedelta(days=90, microseconds=1)),
        ("f", 3, t0), ("g", 1, t0 - timedelta(seconds=1)),
    ], "eid string, user_id long, event_ts timestamp_ntz")
    got = {r["eid"]: r["f"] for r in asof_join(ents, feats, "user_id", bucket="1 day").collect()}
    assert got == {"a": 2.0, "b": 2.0, "c": 5.0, "d": 9.0, "e": None, "f": None, "g": None}


def test_insert_ignore_first_write(spark):
    target = spark.createDataFrame([("1",)], "event_id string")
    batch = spark.createDataFrame([("1", 1), ("2", 5), ("2", 3), ("3", 9)], "event_id string, t int")
    got = sorted((r[0], r[1]) for r in insert_ignore(target, batch, "event_id", ["t"]).collect())
    assert got == [("2", 3), ("3", 9)]


def test_ks_and_wasserstein_brute_force(spark):
    rnd = np.random.default_rng(1)
    ref = rnd.normal(0, 1, 300).round(2)
    cur = rnd.normal(0.5, 1, 200).round(2)
    rows = [("ref", float(x)) for x in ref] + [("cur", float(x)) for x in cur]
    df = spark.createDataFrame(rows, "win string, x double")
    xs = np.unique(np.concatenate([ref, cur]))
    fr = np.searchsorted(np.sort(ref), xs, side="right") / len(ref)
    fc = np.searchsorted(np.sort(cur), xs, side="right") / len(cur)
    ks = D.ks_statistic(df, "x").first()["statistic"]
    assert abs(ks - np.max(np.abs(fr - fc))) < 1e-12
    w = np.sum(np.diff(xs) * np.abs(fr - fc)[:-1]) / np.std(ref)
    assert abs(D.wasserstein_norm(df, "x").first()["statistic"] - round(w, 6)) < 1e-6


def test_pvalues():
    assert abs(D.chi2_pvalue(3.841458820694124, 1) - 0.05) < 1e-6
    assert abs(D.z_pvalue(1.959963984540054) - 0.05) < 1e-9
    assert D.ks_pvalue(0.0, 100, 100) == 1.0


def test_drift_report_methods(spark):
    rows = [("ref" if i < 400 else "cur", float(i % 50), ["a", "b"][i % 2], i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, "win string, x double, c string, k int")
    rep = {r["column"]: r for r in D.drift_report(df, ["x", "k"], ["c"]).collect()}
    assert rep["x"]["method"] == "ks" and rep["c"]["method"] == "z" and rep["k"]["method"] == "chisquare"
    big = D.drift_report(df, ["x"], ["c"], small=10)
    assert {r["method"] for r in big.collect()} == {"wasserstein", "jensenshannon"}


def test_isolation_forest_risk(spark):
    from riskspark.operators.iforest import score_iforest, train_iforest
    rnd = np.random.default_rng(3)
    rows = [(str(i), float(x), float(y)) for i, (x, y) in enumerate(rnd.normal(0, 1, (500, 2)))]
    rows.append(("outlier", 12.0, -12.0))
    df = spark.createDataFrame(rows, "event_id string, a double, b double")
    model = train_iforest(df, ["a", "b"], trees=50, psi=64)
    s = {r["event_id"]: r["anomaly_score"] for r in score_iforest(df, model).collect()}
    assert all(0.0 <= v <= 1.0 for v in s.values())
    assert s["outlier"] >= max(v for k, v in s.items() if k != "outlier") - 1e-9


def test_tree_attribution_additive(spark):
    from pyspark.ml.functions import vector_to_array
    from riskspark.operators.attribution import attribute_trees
    from riskspark.operators.models import assemble, train_gbt
    rnd = np.random.default_rng(5)
    rows = [(str(i), float(a), float(b), int(a + b > 0)) for i, (a, b) in enumerate(rnd.normal(0, 1, (300, 2)))]
    df = spark.createDataFrame(rows, "event_id string, a double, b double, label int")
    model = train_gbt(df, ["a", "b"], max_iter=5, depth=3)
    attr = attribute_trees(df, model, ["a", "b"]).groupBy("event_id").agg(F.sum("contribution").alias("s"))
    raw = model.transform(assemble(df, ["a", "b"])).select(
        "event_id", vector_to_array("rawPrediction")[1].alias("margin"))
    bad = attr.join(raw, "event_id").where(F.abs(F.col("s") - F.col("margin")) > 1e-9).count()
    assert bad == 0
