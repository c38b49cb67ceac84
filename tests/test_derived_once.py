"""Derived columns are computed once a row; joins come before rows are multiplied by features."""

from test_work_once import _events


def test_validation_computes_derived_columns_once(spark, tmp_path):
    from riskspark.session import apply_runtime_conf
    from riskspark.sources import fixtures as X

    apply_runtime_conf(spark)
    v = X.txn_validated(spark, _events(spark, tmp_path))
    plan = v._jdf.queryExecution().optimizedPlan()
    assert "Generate inline" in plan.toString()
    filters = [x for x in plan.toString().split("\n") if "Filter " in x]
    assert filters and not any("element_at" in x for x in filters)


def test_importance_drift_joins_before_it_unpivots(spark, tmp_path):
    from riskspark.plans import q_models as Q

    plan = Q.a20_importance_drift(spark, _events(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    # the plan is printed from the result down: the join stands below the generator that makes a row per feature
    assert plan.index("Generate stack") < plan.index("Join Inner")
