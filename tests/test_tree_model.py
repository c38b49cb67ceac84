"""Tree tables: margins against Spark ML, Shapley values against all coalitions, stream-safe scoring without models."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import iforest as IF
from riskspark.operators import scoring as SC
from riskspark.operators import tree_model as TM
from riskspark.session import scratch_path


def grow(rng, depth, n_features, cover, tree, nodes):
    i = len(nodes)
    nodes.append(None)
    if depth == 0 or rng.random() < 0.15:
        nodes[i] = (tree, i, -1, 0.0, -1, -1, rng.uniform(-1, 1), float(cover))
        return i
    a = rng.randrange(0, cover + 1)
    f, th = rng.randrange(n_features), rng.choice([-1.0, 0.0, 0.5, 1.0])
    left, right = grow(rng, depth - 1, n_features, a, tree, nodes), grow(rng, depth - 1, n_features, cover - a, tree, nodes)
    nodes[i] = (tree, i, f, th, left, right, 0.0, float(cover))
    return i


def random_model(seed, trees=4, depth=5, n_features=4):
    rng, nodes = random.Random(seed), []
    for t in range(trees):
        own = []
        grow(rng, depth, n_features, 200, t, own)
        nodes += own
    return TM.TreeModel([f"f{i}" for i in range(n_features)], nodes)


def expected(forest, tree, node, row, known):
    """Value of a tree when only the known features are given: others follow the training covers."""
    f = int(forest.feature[tree, node])
    if f < 0:
        return forest.value[tree, node]
    a, b = int(forest.left[tree, node]), int(forest.right[tree, node])
    if f in known:
        return expected(forest, tree, a if row[f] <= forest.threshold[tree, node] else b, row, known)
    total = forest.cover[tree, node]
    if not total:
        return 0.0
    return sum(forest.cover[tree, c] / total * expected(forest, tree, c, row, known) for c in (a, b))


@pytest.mark.parametrize("seed", range(6))
def test_shap_is_the_shapley_value_over_all_coalitions(seed):
    model = random_model(seed)
    forest, n = TM.Forest(model), len(model.features)
    x = np.random.default_rng(seed).choice([-1.0, -0.5, 0.0, 0.5, 0.7, 1.0, 2.0], (12, n))
    got = forest.shap(x)
    assert np.allclose(got.sum(axis=1) + forest.base, forest.margin(x), atol=1e-12)
    for row, phi in zip(x, got):
        def v(s):
            return sum(expected(forest, t, 0, row, s) for t in range(len(forest.feature)))
        for d in range(n):
            others = [j for j in range(n) if j != d]
            want = sum(math.factorial(len(s)) * math.factorial(n - 1 - len(s)) / math.factorial(n) * (v({*s, d}) - v(set(s)))
                       for k in range(n) for s in itertools.combinations(others, k))
            assert abs(want - phi[d]) < 1e-10


@pytest.fixture(scope="module")
def fitted(spark):
    from riskspark.operators.models import train_gbt

    rnd = np.random.default_rng(5)
    rows = [(str(i), float(a), float(b), "xyz"[i % 3], int(a + b + (i % 3) > 1), "ref" if i % 4 else "cur")
            for i, (a, b) in enumerate(rnd.normal(0, 1, (400, 2)))]
    df = spark.createDataFrame(rows, "event_id string, a double, b double, kind string, label int, win string").withColumn(
        "kind=x", (F.col("kind") == "x").cast("int"))
    feats = ["a", "b", "kind=x"]
    ml = train_gbt(df, feats, max_iter=6, depth=3)
    path = scratch_path(spark, "tree-model-test")
    TM.from_spark_ml(ml, feats, spark, f"{path}/ml", {"champion_type": "gbt"}).save(spark, f"{path}/champion")
    return df, ml, TM.TreeModel.load(spark, f"{path}/champion")


def test_saved_model_scores_like_spark_ml(spark, fitted):
    from pyspark.ml.functions import vector_to_array

    from riskspark.operators.models import assemble
    df, ml, model = fitted
    want = ml.transform(assemble(df, model.features)).select(
        "event_id", vector_to_array("probability")[1].alias("p"), vector_to_array("rawPrediction")[1].alias("m"))
    got = TM.score_trees(df.drop("kind=x"), model, "score", "margin").join(want, "event_id")   # one-hot from ``kind``
    assert got.where((F.abs(F.col("score") - F.col("p")) > 1e-9) | (F.abs(F.col("margin") - F.col("m")) > 1e-9)).count() == 0
    assert got.count() == 400 and model.about["champion_ref"].endswith("champion")


def test_importances_and_top_contributions(spark, fitted):
    df, _, model = fitted
    long = TM.shap_long(df, model).where("feature <> '__base__'")
    want = {r.feature: r.v for r in long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("v")).collect()}
    got = {r.feature: r.importance for r in TM.importance(df.repartition(5), model).collect()}
    assert got.keys() == want.keys() and all(abs(got[f] - want[f]) < 1e-12 for f in want)
    drift = {r.feature: r.drift for r in TM.importance_drift(df, model).collect()}
    by = long.join(df.select("event_id", "win"), "event_id").groupBy("feature", "win").agg(F.avg(F.abs("contribution")).alias("v")).collect()
    mean = {(r.feature, r.win): r.v for r in by}
    assert all(abs(drift[f] - (mean[f, "cur"] - mean[f, "ref"])) < 1e-12 for f in drift)
    per_event = {}
    for r in long.collect():
        per_event.setdefault(r.event_id, []).append((-abs(r.contribution), r.feature, r.contribution))
    for r in TM.top_contributions(df, model, 2).collect():
        best = [x for x in sorted(per_event[r.event_id]) if x[2] != 0][:2]
        assert [(t["feature"], t["contribution"]) for t in r.top_contributors] == [(f, c) for _, f, c in best]
        assert all((t["direction"] == "increased_risk") == (t["contribution"] > 0) for t in r.top_contributors)


def test_no_rows_and_no_models(spark, fitted):
    df, _, model = fitted
    assert TM.score_trees(df.limit(0), model).count() == 0 and TM.importance(df.limit(0), model).count() == 0
    assert TM.shap_vectors(df.limit(0), model).count() == 0
    e = spark.createDataFrame([("1", 5, 6, 7, 8, 9000.0, None, None, None, 1, 0, 0), ("2", 6, 6, 7, 8, None, "US", "web", 1, 0, 0, 0)],
                              "event_id string, user_id long, merchant_id long, device_id long, ip_id long, amount double, country string, "
                              "channel string, drift_phase int, geo_mismatch int, is_new_device int, is_new_ip int").withColumn(
                                  "event_ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    snaps = {"user_id": spark.createDataFrame([(5, 3.0)], "user_id long, user_txn_count_5m double")}
    none = {r.event_id: r for r in SC.score_events(e, snaps).collect()}
    assert none["1"].final_score == 0.95 and none["1"].decision == "block" and none["1"].country == "US"
    assert none["1"].fallbacks == {"rules_only": True, "champion_missing": True, "anomaly_missing": True, "feast_failed": False}
    assert none["2"].fallbacks["feast_failed"] and none["2"].features == {} and none["1"].features == {"user_txn_count_5m": 3.0}
    assert none["1"].scores.champion is None and none["1"].latency_ms.champion is None and none["2"].amount == 0.0
    c = random_model(1)
    c.features = ["amount", "country=US", "drift_phase", "missing"]
    forest = IF.train_iforest(e.unionByName(e), ["amount"], "event_id", trees=3, psi=4)
    path = IF.save_iforest(spark, forest, scratch_path(spark, "forest-test"))
    both = {r.event_id: r for r in SC.score_events(e, snaps, c, IF.load_iforest(spark, path)).collect()}
    f = TM.Forest(c)
    x = np.array([[9000.0, 1, 0, 0], [0.0, 1, 1, 0]])
    assert np.allclose([both[k].scores.champion for k in "12"], f.score(f.margin(x)))
    assert all(0 <= both[k].scores.anomaly <= 1 and not both[k].fallbacks["rules_only"] for k in "12")
    assert SC.score_models(e, None, None).columns == [*e.columns, *SC.MODEL_COLUMNS]
