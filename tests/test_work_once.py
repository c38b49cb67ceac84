"""Inputs that several steps read are made once."""

import datetime

from pyspark.sql import functions as F


def _events(spark, path):
    t0 = datetime.datetime(2024, 1, 5)
    rows = [(i, t0 + datetime.timedelta(minutes=17 * i), i % 5, "click", float(i % 90 + 1), '{"k": %d}' % (i % 4)) for i in range(400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{path}/events.parquet")
    return str(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_training_frame_validates_its_rows_once(spark, tmp_path, monkeypatch):
    from riskspark import session
    from riskspark.plans import training as TR
    from riskspark.sources import fixtures as X

    sf, written, write = _events(spark, tmp_path), [], session.write_scratch
    monkeypatch.setattr(session, "write_scratch", lambda df, name: written.append(name) or write(df, name))
    frame = TR.training_frame(X.txn_validated(spark, sf))
    assert written[0] == "validated"
    assert "events.parquet" not in _plan(frame)
    assert frame.count() == X.txn_validated(spark, sf).count() > 0


def test_snapshots_are_plain_tables(spark, tmp_path):
    from riskspark.plans.q_joins import _snapshots

    snaps = _snapshots(spark, _events(spark, tmp_path))
    assert len(snaps) == 4
    for key, s in snaps.items():
        assert "Window" not in _plan(s) and "Aggregate" not in _plan(s)
        assert s.count() == s.select(key).distinct().count()


def test_rescored_decisions_and_slices_compute_features_once(spark, tmp_path):
    from riskspark.plans import q_metrics as Q
    from riskspark.sources import fixtures as X

    sf = _events(spark, tmp_path)
    log = X.decision_log(spark, sf)
    assert "events.parquet" not in _plan(log)
    assert "Union" not in log._jdf.queryExecution().optimizedPlan().toString()
    once = X.decision_log(spark, sf, rescored=False)
    key = lambda df: sorted((r.event_id, r.created_at) for r in df.select("event_id", "created_at").collect())
    again = [(e, t + datetime.timedelta(minutes=1)) for e, t in key(once) if int(e) % 37 == 0]
    assert again and key(log) == sorted(key(once) + again)
    assert "events.parquet" not in _plan(Q.slice_input(spark, sf))
