"""Rules model, ensemble branches, tiers, labels."""

import hashlib

from pyspark.sql import functions as F

from riskspark.functions import scalar as P
from riskspark.operators.scoring import ensemble, fallback_flags, rules_score


def test_rules_levels(spark):
    rows = [(6000.0, 1, 0, 0, 0, 0.0), (2000.0, 0, 1, 0, 0, 0.0), (6000.0, 0, 0, 0, 0, 0.0),
            (10.0, 0, 0, 0, 6, 0.0), (10.0, 0, 0, 0, 0, 2600.0), (10.0, 0, 0, 0, 0, 0.0)]
    df = spark.createDataFrame(rows, "amount double, geo_mismatch int, is_new_device int, is_new_ip int, "
                                     "user_txn_count_5m long, user_amount_sum_1h double")
    got = [r[0] for r in df.select(rules_score(df)).collect()]
    assert got == [0.95, 0.75, 0.05, 0.75, 0.75, 0.05]


def test_rules_missing_columns_are_zero(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert df.select(rules_score(df)).first()[0] == 0.05


def test_ensemble_branches(spark):
    df = spark.createDataFrame([(0.1, 0.5, 0.9), (0.1, 0.5, None), (0.1, None, 0.9), (0.3, None, None),
                                (0.95, 0.1, 0.1)], "r double, c double, a double")
    got = [round(r[0], 12) for r in df.select(ensemble("r", "c", "a")).collect()]
    assert got == [round(0.6 * 0.5 + 0.4 * 0.9, 12), round(0.8 * 0.5 + 0.2 * 0.1, 12),
                   round(0.7 * 0.9 + 0.3 * 0.1, 12), 0.3, 0.95]
    flags = df.select(fallback_flags("c", "a").alias("f")).collect()
    assert flags[3]["f"]["rules_only"] and not flags[0]["f"]["rules_only"]


def test_decide_tiers(spark):
    df = spark.createDataFrame([(0.92,), (0.8,), (0.55,), (0.5499,)], "s double")
    assert [r[0] for r in df.select(P.decide("s")).collect()] == ["block", "review", "step_up", "approve"]


def test_proxy_label_hash(spark):
    ids = [str(i) for i in range(0, 500, 7)]
    df = spark.createDataFrame([(i, 0, 0.0, "web") for i in ids], "e string, d int, a double, c string")
    got = {r["e"]: r["j"] for r in df.select("e", P._hex_mod100(F.sha2("e", 256)).alias("j")).collect()}
    for i in ids:
        assert got[i] == int(hashlib.sha256(i.encode()).hexdigest(), 16) % 100


def test_failure_reason(spark):
    df = spark.createDataFrame([(["b", "a", "b"], True), ([], False)], "f array<string>, s boolean")
    got = [r[0] for r in df.select(P.failure_reason("f", "s")).collect()]
    assert got == ["validation_failed: a, b; volume_spike", "validation_failed"]


def test_parse_time():
    from datetime import datetime
    now = datetime(2024, 1, 1, 12, 0, 0)
    assert P.parse_time("now-2h", now=now) == datetime(2024, 1, 1, 10, 0, 0)
    assert P.parse_time("2024-01-01T10:00:00Z") == datetime(2024, 1, 1, 10, 0, 0)
    assert P.parse_time("2024-01-01T12:00:00+02:00") == datetime(2024, 1, 1, 10, 0, 0)
