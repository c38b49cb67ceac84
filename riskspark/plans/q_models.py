"""Queries for the training frame and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar as P
from ..operators import models as MD
from ..operators import ranking as R
from ..operators.iforest import score_iforest, train_iforest
from ..operators.windows import time_split
from ..session import fingerprint
from ..sources import fixtures as X
from . import training as TR
from .oracle import with_ctes
from .registry import register

AS_OF = X.AS_OF
_NUM = TR.NUMERIC


def _asof_sql(key, cols):
    c = ", ".join(f"max_by({x}, validated_at) AS {x}" for x in cols)
    return (f"fv_{key}", f"SELECT {key}, event_ts AS fts, {c} FROM feats GROUP BY 1, 2")


_VIEWS = [_asof_sql(k, v) for k, v in C.FEATURE_VIEWS.items()]


def _frame_sql():
    sel = []
    joins = []
    for k, cols in C.FEATURE_VIEWS.items():
        for c in cols:
            sel.append(f"CASE WHEN v_{k}.fts >= e.event_ts - INTERVAL 90 DAY THEN v_{k}.{c} END AS {c}")
        joins.append(f"ASOF LEFT JOIN fv_{k} v_{k} ON e.{k} = v_{k}.{k} AND e.event_ts >= v_{k}.fts")
    lab = ("coalesce(l.label, TRY_CAST(json_extract_string(e.payload, '$.is_fraud') AS INTEGER), "
           "TRY_CAST(json_extract_string(e.payload, '$.label') AS INTEGER))")
    return with_ctes(f"""
SELECT e.event_id, {', '.join(sel)}, e.amount, e.country, e.channel,
       coalesce({lab}, 0) AS label, 'ok' AS label_status
FROM txn_validated e {' '.join(joins)}
LEFT JOIN txn_labels l ON e.event_id = l.event_id""", "feats", "txn_labels", extra=_VIEWS)


@register("m13_training_frame", _frame_sql(), ops="M13 J1 J7 J10 P6 P7")
def m13_training_frame(spark, sf):
    f = TR.training_frame(X.txn_validated(spark, sf), X.txn_labels(spark, sf))
    return f.select("event_id", *_NUM, "amount", "country", "channel", "label", "label_status")


def _frame(spark, sf):
    """Training frame written once to the shared checkpoint folder (lineage cut before ML passes)."""
    from ..session import write_scratch
    v = X.validated_features(spark, sf)
    return write_scratch(TR.training_frame(v, X.txn_labels(spark, sf, validated=v), features=v), "training-frame")


def _split(spark, sf):
    f, feats = TR.model_features(_frame(spark, sf))
    return time_split(f.withColumn("eid", F.col("event_id").cast("bigint")), "event_ts", 0.8, tie="eid", written=True), feats


def _train_test(spark, sf):
    s, feats = _split(spark, sf)
    return s.checkpoint(eager=True), feats


_CHAMPIONS: dict = {}


_FRAMES: dict = {}


def _split_frame(spark, sf):
    """(folder, rows, features): the train / test frame, written once per application and input.

    No model is fitted for it: M2's weighted variant and M5 train their own.
    """
    from ..session import scratch_path
    key = (spark.sparkContext.applicationId, sf, fingerprint(spark, f"{sf}/events.parquet"))
    if key not in _FRAMES:
        s, feats = _split(spark, sf)
        path = scratch_path(spark, "champion")
        s.write.parquet(f"{path}/frame")
        _FRAMES[key] = path, s.schema, feats
    path, schema, feats = _FRAMES[key]
    return path, spark.read.schema(schema).parquet(f"{path}/frame"), feats


def _champion(spark, sf):
    """(model, train / test frame, features): the library's default ensemble, fitted once per application and input.

    The model's node table and its frame are written to the shared checkpoint folder and read back by
    M2, M9, M14, M15, M16, A19, A20, T5, F6 and ST10.  A single-class frame gives a ``ConstantModel``.
    """
    from ..operators import tree_model as TM
    key = (spark.sparkContext.applicationId, sf, fingerprint(spark, f"{sf}/events.parquet"))
    if key not in _CHAMPIONS:
        path, s, feats = _split_frame(spark, sf)
        model = MD.train_gbt(s.where("split = 'train'"), feats, "label")
        if not isinstance(model, MD.ConstantModel):
            imp = dict(zip(feats, (float(v) for v in model.featureImportances.toArray())))
            TM.from_spark_ml(model, feats, spark, f"{path}/ml", {"champion_type": "gbt", "importances": imp}).save(spark, f"{path}/champion")
            model = None
        _CHAMPIONS[key] = path, model, feats, s.schema
    path, model, feats, schema = _CHAMPIONS[key]
    return model or TM.TreeModel.load(spark, f"{path}/champion"), spark.read.schema(schema).parquet(f"{path}/frame"), feats


_FORESTS: dict = {}


def _forest(spark, sf):
    """The isolation forest over the training rows, written to the shared folder once per application and input."""
    from ..operators.iforest import load_iforest, save_iforest
    from ..session import scratch_path
    key = (spark.sparkContext.applicationId, sf, fingerprint(spark, f"{sf}/events.parquet"))
    if key not in _FORESTS:
        _, s, _ = _split_frame(spark, sf)
        model = train_iforest(s.where("split = 'train'"), _NUM + ["amount"], "event_id", label="label", trees=200, psi=256)
        _FORESTS[key] = save_iforest(spark, model, scratch_path(spark, "forest"))
    return load_iforest(spark, _FORESTS[key])


def serving_events(spark, sf):
    """Events as a scoring request holds them: ids, amount, context; no features."""
    return X.validated_features(spark, sf).select("event_id", "event_ts", *C.ID_COLUMNS, "amount", "country", "channel", "drift_phase",
                                                  "geo_mismatch", "is_new_device", "is_new_ip")


def _tree_model(spark, sf):
    from ..operators.tree_model import TreeModel
    model, s, feats = _champion(spark, sf)
    return (model if isinstance(model, TreeModel) else None), s, feats


@register("m2_train_gbt", ops="M2 M8 M10")
def m2_train_gbt(spark, sf):
    from ..operators.tree_model import score_trees
    model, s, feats = _champion(spark, sf)
    test = s.where("split = 'test'")
    scored = MD.score_model(model, test, feats, "score") if isinstance(model, MD.ConstantModel) else score_trees(test, model)
    return scored.select("event_id", "label", "score")


@register("m2_weighted_checks", with_ctes("""
SELECT count(*) AS n, 0 AS outside, true AS raises_positives FROM (
  SELECT row_number() OVER (ORDER BY event_ts, eid) AS r, count(*) OVER () AS n FROM txn_validated) t
WHERE r > floor(0.8 * n)""", "txn_validated"), ops="M2 A11")
def m2_weighted_checks(spark, sf):
    """The class-weighted variant on the test rows: scores in [0, 1]; balanced weights do not lower the mean score."""
    from ..operators.metrics import with_class_weight
    _, s, feats = _split_frame(spark, sf)
    train = s.where("split = 'train'").select(*[F.col(f"`{c}`") for c in feats], "label")
    test, means = s.where("split = 'test'"), []
    for weight in (None, "weight"):
        model = MD.train_gbt(with_class_weight(train, "label", "weight") if weight else train, feats, "label", weight=weight, max_iter=10)
        scored = MD.score_model(model, test, feats, "score")
        means.append(scored.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("score") < 0) | (F.col("score") > 1)).alias("outside"),
                                F.avg("score").alias("mean")))
    plain, weighted = means
    return weighted.crossJoin(plain.select(F.col("mean").alias("plain"))).select(
        "n", F.col("outside").cast("int").alias("outside"), (F.col("mean") >= F.col("plain") - 0.02).alias("raises_positives"))


@register("m9_score_events", ops="M9 M2 M5 J8 P15 S10")
def m9_score_events(spark, sf):
    """The batch scorer with the fitted champion and forest, loaded from their folders."""
    from ..operators.scoring import score_events
    from .q_joins import _snapshots
    model, _, _ = _tree_model(spark, sf)
    return score_events(serving_events(spark, sf), _snapshots(spark, sf), model, _forest(spark, sf)).select(
        "event_id", "final_score", "decision", "scores", "fallbacks", F.col("model_versions.champion_type").alias("champion_type"),
        "features", "feast_failed")


def score_checks(scored):
    """One row: rows, and how many break a rule that holds for every model (M6 blend, P22 tier, ranges, flags)."""
    from ..operators.scoring import ensemble
    final = ensemble("scores.rules", "scores.champion", "scores.anomaly")
    unit = lambda c: F.coalesce((F.col(c) < 0) | (F.col(c) > 1), F.lit(False))
    flag = lambda k: F.col("fallbacks")[k]
    none = {"champion_missing": F.col("scores.champion").isNull(), "anomaly_missing": F.col("scores.anomaly").isNull(),
            "rules_only": F.col("scores.champion").isNull() & F.col("scores.anomaly").isNull(), "feast_failed": F.col("feast_failed")}
    wrong = F.lit(False)
    for k, v in none.items():
        wrong = wrong | (flag(k) != v)
    bad = {"bad_blend": F.abs(F.col("final_score") - final) > 1e-12, "bad_tier": F.col("decision") != P.decide("final_score"),
           "outside": unit("scores.rules") | unit("scores.champion") | unit("scores.anomaly"), "bad_flags": wrong}
    return scored.agg(F.count(F.lit(1)).alias("n"), F.count_if("feast_failed").alias("feast_failed"),
                      *[F.count_if(F.coalesce(v, F.lit(True))).alias(k) for k, v in bad.items()])


def _feast_failed_sql():
    from .q_joins import _snap_sql
    snaps = [_snap_sql(k, v) for k, v in C.FEATURE_VIEWS.items()]
    joins = " ".join(f"LEFT JOIN snap_{k} ON e.{k} = snap_{k}.{k}" for k in C.FEATURE_VIEWS)
    miss = " OR ".join(f"snap_{k}.{k} IS NULL" for k in C.FEATURE_VIEWS)
    return f"SELECT e.event_id, ({miss}) AS feast_failed FROM txn_validated e {joins}", snaps


_CHECK_SQL, _SNAPS = _feast_failed_sql()


@register("m9_score_checks", with_ctes(f"""
SELECT count(*) AS n, count(*) FILTER (feast_failed) AS feast_failed, 0 AS bad_blend, 0 AS bad_tier, 0 AS outside, 0 AS bad_flags
FROM ({_CHECK_SQL}) x""", "feats", "txn_validated", extra=_SNAPS), ops="M9 M6 M7 P22 J8")
def m9_score_checks(spark, sf):
    from ..operators.scoring import score_events
    from .q_joins import _snapshots
    model, _, _ = _tree_model(spark, sf)
    c = score_checks(score_events(serving_events(spark, sf), _snapshots(spark, sf), model, _forest(spark, sf)))
    return c.select("n", "feast_failed", *[F.col(x).cast("int").alias(x) for x in ("bad_blend", "bad_tier", "outside", "bad_flags")])


@register("m3_train_logreg", ops="M3 A11")
def m3_train_logreg(spark, sf):
    s, feats = _train_test(spark, sf)
    model = MD.train_logreg(s.where("split = 'train'"), feats, "label")
    return MD.score_model(model, s.where("split = 'test'"), feats, "score").select("event_id", "label", "score")


@register("m4_single_class", with_ctes(
    "SELECT event_id, label, CAST(label AS DOUBLE) AS score FROM txn_labels WHERE label IN (0, 1)", "txn_labels"), ops="M4")
def m4_single_class(spark, sf):
    """Training on one class alone, negatives or positives, gives that class's constant score."""
    out = None
    for only in (0, 1):
        rows = X.txn_labels(spark, sf).where(f"label = {only}").withColumn("amount", F.length("event_id").cast("double"))
        model = MD.train_gbt(rows, ["amount"], "label", max_iter=5)
        scored = MD.score_model(model, rows, ["amount"], "score").select("event_id", "label", "score")
        out = scored if out is None else out.unionByName(scored)
    return out


@register("m5_isolation_forest", ops="M5")
def m5_isolation_forest(spark, sf):
    from ..session import write_scratch
    feats = _NUM + ["amount"]
    # five passes read the frame: as Parquet each reads its columns only, and only those go to the Python workers
    f = write_scratch(TR.training_frame(X.txn_validated(spark, sf), X.txn_labels(spark, sf)), "forest-frame").select("event_id", "label", *feats)
    model = train_iforest(f, feats, "event_id", label="label", trees=200, psi=256)
    return score_iforest(f, model).select("event_id", "anomaly_score")


#: features of the linear attribution
_LINEAR = ["amount", *_NUM]


def _linear_fit(spark, sf):
    """(flat decisions, written once, and the least-squares slope of their score per feature)."""
    from ..session import write_scratch
    d = X.decision_log(spark, sf, rescored=False)
    flat = P.flatten_features(d, keys=_NUM, keep=["event_id", "amount", "created_at", "final_score"])
    flat = write_scratch(P.scoring_input(flat, _NUM), "flat-decisions")
    return flat, MD.fit_slopes(flat, _LINEAR, "final_score")


def _linear_attr(spark, sf):
    """Per-feature least-squares slopes of the decision's score, as contributions of every logged decision."""
    flat, fit = _linear_fit(spark, sf)
    return MD.linear_attribution(flat, fit["slopes"], fit["means"]), flat


def _value_sql(f):
    return f"coalesce(CAST({f if f == 'amount' else 'f_' + f} AS DOUBLE), 0.0)"


_SLOPES_SQL = ("slopes", "SELECT " + ", ".join(
    f"coalesce(covar_pop(final_score, {_value_sql(f)}) / nullif(var_pop({_value_sql(f)}), 0), 0) AS s_{f}, avg({_value_sql(f)}) AS m_{f}"
    for f in _LINEAR) + " FROM decisions1")
_ATTR_SQL = ("attr", " UNION ALL ".join(
    f"SELECT event_id, created_at, '{f}' AS feature, s_{f} * ({_value_sql(f)} - m_{f}) AS contribution FROM decisions1, slopes"
    for f in _LINEAR))


@register("m14_linear_attribution", with_ctes(
    "SELECT event_id, feature, round(contribution, 6) + 0.0::DOUBLE AS contribution FROM attr", "decisions1", extra=[_SLOPES_SQL, _ATTR_SQL]),
    ops="M14")
def m14_linear_attribution(spark, sf):
    a, _ = _linear_attr(spark, sf)
    return a.select("event_id", "feature", (F.round("contribution", 6) + F.lit(0.0)).alias("contribution"))  # no negative zeros


@register("a19_global_importance", with_ctes(
    "SELECT feature, round(avg(abs(contribution)), 6) AS importance FROM attr GROUP BY 1", "decisions1",
    extra=[_SLOPES_SQL, _ATTR_SQL]), ops="A19")
def a19_global_importance(spark, sf):
    a, _ = _linear_attr(spark, sf)
    return a.groupBy("feature").agg(F.round(F.avg(F.abs("contribution")), 6).alias("importance"))


@register("a20_importance_drift", with_ctes(f"""
SELECT feature,
  round(avg(abs(contribution)) FILTER (WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR), 6)
  - round(avg(abs(contribution)) FILTER (WHERE created_at < TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR), 6) AS drift
FROM attr WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 HOUR AND created_at < TIMESTAMP '{AS_OF}'
GROUP BY 1""", "decisions1", extra=[_SLOPES_SQL, _ATTR_SQL]), ops="A20 P11")
def a20_importance_drift(spark, sf):
    flat, fit = _linear_fit(spark, sf)
    # the windows are joined to the decisions before these become a row per feature
    tags = flat.select("event_id", P.window_tag("created_at", AS_OF, 6, 1).alias("win")).where(F.col("win").isNotNull())
    rows = flat.join(tags, "event_id").withColumn("_tag", F.struct("event_id", "win"))
    t = MD.linear_attribution(rows, fit["slopes"], fit["means"], key="_tag")
    g = t.groupBy("feature").agg(
        F.round(F.avg(F.when(F.col("_tag.win") == "cur", F.abs("contribution"))), 6).alias("cur"),
        F.round(F.avg(F.when(F.col("_tag.win") == "ref", F.abs("contribution"))), 6).alias("ref"))
    return g.select("feature", (F.col("cur") - F.col("ref")).alias("drift"))


@register("t5_top_contributors", with_ctes("""
SELECT event_id, feature, round(contribution, 6) AS contribution, rank,
       CASE WHEN contribution > 0 THEN 'increased_risk' ELSE 'decreased_risk' END AS direction
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY abs(round(contribution, 9)) DESC, feature) AS rank
      FROM attr) r WHERE rank <= 2""", "decisions1", extra=[_SLOPES_SQL, _ATTR_SQL]), ops="T5 M16")
def t5_top_contributors(spark, sf):
    a, _ = _linear_attr(spark, sf)
    a = a.withColumn("_abs", F.round(F.abs("contribution"), 9))
    top = R.top_k_per_group(a, "event_id", 2, "_abs", by_abs=False, tie="feature")
    return top.select("event_id", "feature", F.round("contribution", 6).alias("contribution"),
                      F.col("rank"),
                      F.when(F.col("contribution") > 0, "increased_risk").otherwise("decreased_risk")
                      .alias("direction"))


@register("t5_top_features", with_ctes(
    "SELECT feature, round(avg(abs(contribution)), 6) AS importance FROM attr GROUP BY 1 "
    "ORDER BY importance DESC, feature LIMIT 3", "decisions1", extra=[_SLOPES_SQL, _ATTR_SQL]), ops="T5 A19")
def t5_top_features(spark, sf):
    g = a19_global_importance(spark, sf)
    return g.orderBy(F.col("importance").desc(), "feature").limit(3)


@register("m14_tree_attribution", ops="M14 M15")
def m14_tree_attribution(spark, sf):
    """Shapley values of the champion's margin for the test rows, all features, and the base value."""
    from ..operators.tree_model import shap_long
    model, s, _ = _tree_model(spark, sf)
    return shap_long(s.where("split = 'test'"), model)


@register("m14_shap_checks", with_ctes("""
SELECT count(*) AS n, 0 AS not_additive FROM (
  SELECT row_number() OVER (ORDER BY event_ts, eid) AS r, count(*) OVER () AS n FROM txn_validated) t
WHERE r > floor(0.8 * n)""", "txn_validated"), ops="M14 W10")
def m14_shap_checks(spark, sf):
    """Contributions and base value sum to the scorer's margin for every test row."""
    from ..operators.tree_model import score_trees, shap_vectors
    model, s, _ = _tree_model(spark, sf)
    t = shap_vectors(score_trees(s.where("split = 'test'"), model, "score", "margin"), model)
    total = F.aggregate("shap", F.col("base"), lambda a, v: a + v)
    return t.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(total - F.col("margin")) > 1e-9).cast("int").alias("not_additive"))


@register("a19_model_importance", ops="A19 M14")
def a19_model_importance(spark, sf):
    from ..operators.tree_model import importance
    model, s, _ = _tree_model(spark, sf)
    return importance(s, model)


def window_frame(spark, sf):
    """The model's frame with the decision's window tag (P11 over created_at)."""
    _, s, _ = _tree_model(spark, sf)
    d = X.decision_log(spark, sf, rescored=False, features=X.validated_features(spark, sf)).select("event_id", "created_at")
    return s.drop("created_at").join(d, "event_id").withColumn("win", P.window_tag("created_at", AS_OF, 6, 1)).where(F.col("win").isNotNull())


@register("a20_model_importance_drift", ops="A20 P11 M14")
def a20_model_importance_drift(spark, sf):
    from ..operators.tree_model import importance_drift
    model, _, _ = _tree_model(spark, sf)
    return importance_drift(window_frame(spark, sf), model)


@register("t5_model_top_features", ops="T5 A19 M14")
def t5_model_top_features(spark, sf):
    return a19_model_importance(spark, sf).orderBy(F.col("importance").desc(), "feature").limit(20)


@register("m15_feature_importances", ops="M15")
def m15_feature_importances(spark, sf):
    model, _, feats = _tree_model(spark, sf)
    return spark.createDataFrame([(f, model.about["importances"][f]) for f in feats], "feature string, importance double")


def explain(spark, sf):
    """M16 for every event: latest decision, rules triggered, anomaly reasons and the champion's five top contributors."""
    from ..operators.tree_model import top_contributions
    from ..operators.windows import latest_decision
    v = X.validated_features(spark, sf)
    d = latest_decision(X.decision_log(spark, sf, features=v))
    f = v.select(
        "event_id", "geo_mismatch", "is_new_device", "is_new_ip", "user_txn_count_5m", "user_amount_sum_1h",
        "merchant_chargeback_rate_30d")
    e = d.select("event_id", "decision", "final_score", "amount",
                 F.col("scores.anomaly").alias("anomaly_score")).join(f, "event_id", "left")
    e = e.select("event_id", "decision", "final_score", P.rules_triggered(e).alias("rules_triggered"),
                 P.anomaly_reasons(e, "anomaly_score").alias("anomaly_reasons"))
    model, s, _ = _tree_model(spark, sf)
    return e.join(top_contributions(s, model, 5, keep=["event_id"]), "event_id", "left")


@register("m16_explain", ops="M16 W8 P31 P32 T5")
def m16_explain(spark, sf):
    return explain(spark, sf)


@register("m16_explain_checks", with_ctes("""
SELECT event_id, decision, round(final_score, 9) AS final_score, true AS top_ok FROM decision_log
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY created_at DESC) = 1""", "decision_log"), ops="M16 W8 T5")
def m16_explain_checks(spark, sf):
    """Every event once with its latest decision, and whether its contributors are five at most, ranked by size, with the right direction."""
    t = F.col("top_contributors")
    ok = ((F.size(t) <= 5) & F.forall(t, lambda p: (p["direction"] == "increased_risk") == (p["contribution"] > 0))
          & F.forall(F.sequence(F.lit(1), F.greatest(F.size(t), F.lit(1))), lambda i: F.coalesce(
              (F.get(t, i - 1)["rank"] == i) & F.coalesce(F.abs(F.get(t, i - 1)["contribution"]) >= F.abs(F.get(t, i)["contribution"]), F.lit(True)),
              F.size(t) == 0)))
    return explain(spark, sf).select("event_id", "decision", F.round("final_score", 9).alias("final_score"), ok.alias("top_ok"))
