"""Validated rows and their features are made once per query; streams land in files that follow the rows, in the order of time."""

import numpy as np
from pyspark.sql import functions as F
from test_tree_model import random_model
from test_work_once import _events, _plan

from riskspark.operators import models as MD
from riskspark.operators import tree_model as TM
from riskspark.operators import windows as W
from riskspark.plans import q_drift as QD
from riskspark.plans import q_models as QM
from riskspark.plans import q_stream as QS
from riskspark.sources import fixtures as X


def _counted(monkeypatch, of, name, calls):
    make = getattr(of, name)
    monkeypatch.setattr(of, name, lambda *a, **k: calls.append(name) or make(*a, **k))


def _small_models(monkeypatch):
    fit = MD.train_gbt
    monkeypatch.setattr(MD, "train_gbt", lambda df, features, label="label", **asked: fit(df, features, label, max_iter=2, depth=2))


def test_explanation_and_reports_compute_features_once(spark, tmp_path, monkeypatch):
    """champion frame, decisions, slices, windows and explanation read one table of features."""
    sf, calls = _events(spark, tmp_path), []
    _small_models(monkeypatch)
    _counted(monkeypatch, X, "txn_validated", calls)
    for module in (W, QM.TR):
        _counted(monkeypatch, module, "velocity_features", calls)
    explained = QM.m16_explain(spark, sf)
    report = QD.f6_monitoring_run(spark, sf)
    assert sorted(calls) == ["txn_validated", "velocity_features"]
    assert "events.parquet" not in _plan(explained)
    n = X.txn_validated(spark, sf).count()
    assert explained.count() == n > 0 and {r.report for r in report.select("report").distinct().collect()} == {"slices", "drift", "attribution"}
    # what is read from the table is what the operators compute
    log = lambda **k: X.decision_log(spark, sf, **k).select("event_id", "created_at", "final_score", "decision", "features")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(log()) == rows(log(features=X.validated_features(spark, sf)))


def test_changed_input_has_other_features(spark, tmp_path):
    sf = _events(spark, tmp_path)
    n = X.validated_features(spark, sf).count()
    spark.read.parquet(f"{sf}/events.parquet").where("event_id < 100").localCheckpoint().write.mode("overwrite").parquet(f"{sf}/events.parquet")
    assert 0 < X.validated_features(spark, sf).count() == X.txn_validated(spark, sf).count() < n


def test_scored_stream_lands_files_by_rows(spark, tmp_path, monkeypatch):
    """a task scores ``ROWS_PER_FILE`` rows; the stream and the batch read the same snapshots."""
    sf, calls, landed = _events(spark, tmp_path), [], []
    _small_models(monkeypatch)
    monkeypatch.setattr(QS, "ROWS_PER_FILE", 20)
    land = QS._land_table
    monkeypatch.setattr(QS, "_land_table", lambda *a: landed.append(land(*a)) or landed[-1])
    _counted(monkeypatch, X, "txn_validated", calls)
    row = QS.st10_stream_equals_batch(spark, sf).first()
    assert calls == ["txn_validated"] and row.differ == 0 and row.n == X.txn_validated(spark, sf).count()
    assert len(spark.read.parquet(landed[0][0]).inputFiles()) == -(-row.n // 20) > 4
    one = QS.st10_score_stream(spark, sf)
    assert one.count() == row.n and one.columns == ["event_id", "final_score", "decision", "scores", "fallbacks", "feast_failed"]


def test_shadow_answers_leave_the_state(spark, tmp_path, monkeypatch):
    """slices arrive in the order of time, so ten minutes of lateness do and no pair is lost."""
    sf, delays, start = _events(spark, tmp_path), [], QS.ST.shadow_totals_stream
    monkeypatch.setattr(QS.ST, "shadow_totals_stream", lambda *a, **k: delays.append(k["delay"]) or start(*a, **k))
    want = QS.st9_shadow_totals(spark, sf).orderBy("le").collect()
    monkeypatch.setattr(QS, "ROWS_PER_SLICE", 40)
    monkeypatch.setattr(QS, "ROWS_PER_FILE", 10)
    assert QS.st9_shadow_totals(spark, sf).orderBy("le").collect() == want
    pairs = X.txn_validated(spark, sf).where("cast(event_id as bigint) % 5 <> 0").count()
    assert want[0].pairs == pairs > 0 and delays == ["10 minutes"] * 2
    # all rows at one instant cannot be cut: several files of a slice are then no order
    spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")) \
        .localCheckpoint().write.mode("overwrite").parquet(f"{sf}/events.parquet")
    assert QS.st9_shadow_totals(spark, sf).first().pairs == pairs


def test_files_out_of_order_are_noticed(spark, tmp_path):
    path, t = str(tmp_path / "land"), "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id)"
    for lo, hi in ((0, 10), (20, 30), (10, 20)):
        spark.range(lo, hi).selectExpr("id", f"{t} as at").coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    assert not QS._arrives_in_order(spark, path, schema, "at", 1) and QS._arrives_in_order(spark, path, schema, "at", 3)


def test_margin_walks_places_of_thresholds():
    """bit for bit the sum of the leaves that a walk over the thresholds themselves reaches."""
    x = np.random.default_rng(5).choice([-1.0, -0.5, 0.0, 0.5, 0.7, 1.0, 2.0, np.nan, np.inf, -np.inf], (5000, 4))
    for seed in range(4):
        f = TM.Forest(random_model(seed, trees=9))
        leaf = np.zeros((len(x), len(f.feature)))
        for i, row in enumerate(x):
            for t in range(len(f.feature)):
                node = 0
                while f.feature[t, node] >= 0:
                    node = (f.left if row[f.feature[t, node]] <= f.threshold[t, node] else f.right)[t, node]
                leaf[i, t] = f.value[t, node]
        assert np.array_equal(f.margin(x), leaf.sum(axis=1))


def test_top_contributions_keep_the_asked_columns_only(spark):
    """the workers send back the key and the k entries."""
    model = random_model(2)
    df = spark.createDataFrame([(str(i), float(i % 3 - 1), float(i % 5 - 2), 0.5, 1.0, "text") for i in range(60)],
                               "event_id string, f0 double, f1 double, f2 double, f3 double, other string")
    got = TM.top_contributions(df, model, 2, keep=["event_id"])
    assert got.columns == ["event_id", "top_contributors"]
    assert sorted(map(str, got.collect())) == sorted(map(str, TM.top_contributions(df, model, 2).select(*got.columns).collect()))
    assert got.schema["top_contributors"].dataType.simpleString() == TM.CONTRIBUTORS
