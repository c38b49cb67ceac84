"""F5 trains and saves a candidate when the trigger fires, and only then."""

import functools

from conftest import SF_SMALL
from pyspark.ml.classification import GBTClassificationModel

from riskspark.operators import models as MD
from riskspark.plans import feedback as FB
from riskspark.plans import q_drift as Q
from riskspark.sources import fixtures as X


def test_candidate_is_trained_when_triggered(spark, monkeypatch):
    # a small ensemble only in this test: the query trains the library's default
    monkeypatch.setattr(MD, "train_gbt", functools.partial(MD.train_gbt, max_iter=3, depth=2))
    d, v, lab = X.decision_log(spark, SF_SMALL), X.txn_validated(spark, SF_SMALL), X.txn_labels(spark, SF_SMALL)
    for fires in (True, False):
        monkeypatch.setattr(FB, "retrain_trigger", lambda overall, drift: overall.sparkSession.createDataFrame(
            [(fires, "drift_detected")], "triggered boolean, reason string"))
        new, _, trig, path = FB.feedback_loop(d, v, lab, Q.AS_OF_L)
        row = trig.first()
        assert row["candidate_status"] == ("trained" if fires else "no_action")
        assert (path is not None) == fires and (row["candidate_rows"] is not None) == fires
        if fires:
            assert 0 < row["candidate_rows"] <= lab.count() + new.count()
            assert GBTClassificationModel.load(f"{path}/model").getNumTrees == 3
            assert spark.read.parquet(f"{path}/features").count() > len(FB.FEATURE_NUMERIC)
