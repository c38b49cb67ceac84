"""Merged as-of join (J1, M13) against brute force, plan shapes, and class splits without a task per class."""

import hashlib
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskspark.operators.joins import historical_features
from riskspark.operators.ml_prep import stratified_split

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


def _brute(ents, feats, i, ttl):
    """Newest (time, created) at or before the entity's time; ``i`` is the key's position."""
    out = []
    for e in ents:
        fit = [f for f in feats if f[0] is not None and f[1] is not None and f[0] == e[1 + i] and e[3] is not None
               and e[3] - ttl <= f[1] <= e[3]]
        out.append(max(fit, key=lambda f: (f[1], f[2]))[3] if fit else None)
    return out


@pytest.mark.parametrize("bucket", ["1 day", "2 hours"])
def test_merged_asof_equals_brute_force(spark, bucket):
    rnd = random.Random(5)
    when = lambda: T0 + timedelta(minutes=rnd.randrange(6000))
    # user 1 holds a third of all rows; nulls in keys and times, repeated rows
    user = lambda: 1 if rnd.random() < 0.34 else rnd.choice([2, 3, 4, None])
    ents = [(str(i), user(), rnd.choice(["a", "b", None]), None if i % 40 == 0 else when(), i) for i in range(300)]
    ents += ents[:20]
    uf = [(user(), when() if rnd.random() < 0.97 else None, T0 + timedelta(seconds=i), float(i)) for i in range(250)]
    uf += [(u, t, c + timedelta(days=1), v + 0.5) for u, t, c, v in uf[:40]]       # same instant, created later
    mf = [(rnd.choice(["a", "c"]), when(), T0 + timedelta(seconds=i), f"x{i}") for i in range(60)]
    e = spark.createDataFrame(ents, "event_id string, user_id long, shop string, event_ts timestamp_ntz, _t int")
    u = spark.createDataFrame(uf, "user_id long, event_ts timestamp_ntz, validated_at timestamp_ntz, score double")
    m = spark.createDataFrame(mf, "shop string, event_ts timestamp_ntz, validated_at timestamp_ntz, tag string")
    got = historical_features(e, {"user_id": u, "shop": m}, ttl="20 hours", bucket=bucket, feature_lists={"user_id": ["score"], "shop": ["tag"]})
    assert got.columns == ["event_id", "user_id", "shop", "event_ts", "_t", "score", "tag"]
    ttl = timedelta(hours=20)
    want = sorted(zip([x[0] for x in ents], _brute(ents, uf, 0, ttl), _brute(ents, mf, 1, ttl)), key=str)
    assert sorted(((r.event_id, r.score, r.tag) for r in got.collect()), key=str) == want
    none = historical_features(e, {"user_id": u.limit(0), "shop": m.limit(0)}, feature_lists={"user_id": ["score"], "shop": ["tag"]})
    assert none.where("score is null and tag is null").count() == len(ents)
    assert historical_features(e.limit(0), {"user_id": u}, feature_lists={"user_id": ["score"]}).count() == 0


@pytest.mark.parametrize("name,most,windows", [("m13_training_frame", 10, 2), ("j1_asof", 4, 2)])
def test_exchanges_and_windows(spark, name, most, windows):
    """One ordered window along the buckets and one over the carries, whatever the number of views."""
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"(?<![a-zA-Z])Exchange ", plan)) <= most, plan
    assert len(re.findall(r"- Window \[", plan)) <= windows, plan


def test_split_takes_the_exact_share_of_every_class(spark):
    rows = [(str(i), None if i % 10 == 9 else ("big" if i % 10 else "small"), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "event_id string, label string, _rank int")
    got = {r.event_id for r in stratified_split(df, "label", 0.8, 7).where("split = 'train'").collect()}
    for c in (None, "big", "small"):
        ids = sorted((r[0] for r in rows if r[1] == c), key=lambda x: (hashlib.sha256(f"7:{x}".encode()).hexdigest(), x))
        assert [x in got for x in ids] == [i < int(0.8 * len(ids)) for i in range(len(ids))]
    # the ranks are taken in parts of a class
    plan = stratified_split(df, "label", 0.8, 7)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(label#\d+, _part#\d+", plan) and "CartesianProduct" not in plan
    assert stratified_split(df.limit(0), "label").count() == 0
    assert stratified_split(df, "label", 0.8, 7).columns == ["event_id", "label", "_rank", "split"]
