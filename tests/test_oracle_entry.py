"""Driver contract: entry() smoke, every oracle query runs and matches Spark on the smallest scale."""

import pytest

import __spark_entry__ as E

FAST = ["fx_decision_log", "w1_w5_velocity", "m1_rules", "v13_validate_messages", "v14_validation_report",
        "j1_asof", "j8_online_features", "a1_slice_metrics", "a5_performance", "a6_roc_auc", "a8_best_f1_threshold",
        "d1_ks_statistic", "d5_js_distance", "f1_label_batch", "m13_training_frame", "st11_velocity_stream",
        "v16_volume_spike", "p8_proxy_label", "u5_reconcile", "w10_time_split"]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "final_score" in df.columns and "decision" in df.columns


def test_every_query_has_operator_ids():
    from riskspark.plans.catalog import OPERATORS, QUERIES
    q = E.queries()
    assert len(q) >= 100
    assert set(QUERIES) <= set(q)
    assert all(OPERATORS[k] for k in QUERIES)
    assert set(E.oracle_sql()) <= set(q)


@pytest.mark.parametrize("name", FAST)
def test_oracle_match_small(spark, name):
    from tools.oracle_check import compare
    res = compare(spark, "/root/testdata/sf0.001", [name], verbose=False)
    assert res[name][0] == "ok", res[name]


def test_scratch_folders_of_two_applications_differ(spark):
    """Process id and call count may be the same in two containers: the names must differ all the same."""
    from riskspark.session import scratch_path
    names = {scratch_path(spark, "t") for _ in range(5)}
    assert len(names) == 5 and all(spark.sparkContext.applicationId in n for n in names)
