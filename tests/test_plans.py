"""Plan checks: no unpartitioned windows, pruned scans, skew-safe shapes."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
WINDOWED = ["w1_w5_velocity", "j1_asof", "v16_volume_spike", "a6_roc_auc", "w10_time_split", "a9_precision_at_5p",
            "d1_ks_statistic", "a16_latency_summary", "m12_stratified_split"]


# a window whose spec starts with an ordering (no partition expressions) runs in one task
GLOBAL = re.compile(r"windowspecdefinition\([\w.`]+#\d+L? (ASC|DESC)")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", WINDOWED)
def test_no_unpartitioned_window(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert not GLOBAL.search(plan), plan


def test_column_pruning_reaches_scan(spark):
    df = E.queries()["s1_s2_read_columns"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    m = re.search(r"ReadSchema: struct<([^>]*)>", plan)
    assert m and set(x.split(":")[0] for x in m.group(1).split(",")) == {"user_id", "event_id", "value"}


def test_velocity_partitions_by_key_and_time_bucket(spark):
    plan = _plan(E.queries()["w1_w5_velocity"](spark, SF))
    assert re.search(r"hashpartitioning\(_key#\d+L?, _b#\d+L?", plan)


def test_detector_sees_a_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert GLOBAL.search(_plan(df))
