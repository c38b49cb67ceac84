"""M2, M14, M15 and M16 share one fitted model of the library's default size."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from riskspark.operators import models as MD
from riskspark.plans import q_models as Q


def test_default_ensemble_fitted_once(spark, monkeypatch):
    calls, fit = [], MD.train_gbt

    def small(df, features, label="label", **asked):
        calls.append(asked)                                  # what the queries ask for; trained small to keep the test short
        return fit(df, features, label, max_iter=3, depth=2)

    monkeypatch.setattr(MD, "train_gbt", small)
    monkeypatch.setattr(Q, "_CHAMPIONS", {}, raising=False)
    scored = Q.m2_train_gbt(spark, SF_SMALL)
    attributed = Q.m14_tree_attribution(spark, SF_SMALL)
    importances = Q.m15_feature_importances(spark, SF_SMALL)
    assert calls == [{}]
    n = scored.count()
    assert n > 0 and attributed.where("feature = '__base__'").count() == n
    feats = {r["feature"] for r in importances.collect()}
    assert {r["feature"] for r in attributed.select("feature").distinct().collect()} == feats | {"__base__"}
    top = Q.m16_explain(spark, SF_SMALL).select(F.explode("top_contributors.feature").alias("feature")).distinct()
    assert {r["feature"] for r in top.collect()} <= feats and calls == [{}]


def test_weighted_variant_fits_its_two_models_only(spark, monkeypatch):
    """The check of the class weights needs the frame, not the champion of up to 400 trees."""
    calls, fit = [], MD.train_gbt

    def small(df, features, label="label", weight=None, **asked):
        calls.append((weight, asked))
        return fit(df, features, label, weight=weight, max_iter=2, depth=2)

    monkeypatch.setattr(MD, "train_gbt", small)
    monkeypatch.setattr(Q, "_CHAMPIONS", {})
    row = Q.m2_weighted_checks(spark, SF_SMALL).first()
    assert calls == [(None, {"max_iter": 10}), ("weight", {"max_iter": 10})]
    assert row["n"] > 0 and row["outside"] == 0
