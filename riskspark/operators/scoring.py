"""Scoring operators: rules model (M1), ensemble (M6), fallback flags (M7),
score clamps (M8), decision-log rows (S10) and the batch scoring composition (M9).

All of it is column arithmetic in one projection: the three scorers of the
reference (run on a thread pool per request) become three columns of the same
plan, evaluated by whole-stage codegen with no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar as P


def rules_score(df: DataFrame, thresholds: dict | None = None) -> Column:
    """M1: rules risk in [0, 1]; missing inputs count as 0."""
    t = dict(C.RULE_THRESHOLDS, **(thresholds or {}))

    def num(name):
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)

    amount = num("amount")
    susp = (num("geo_mismatch") + num("is_new_device") + num("is_new_ip")) >= 1
    risk = F.lit(t["base_risk"])
    risk = F.when((amount >= t["very_high_amount"]) & susp, F.lit(t["high_risk"])).otherwise(risk)
    elevated = F.lit(t["elevated_risk"])
    risk = F.when((amount >= t["high_amount"]) & susp, F.greatest(risk, elevated)).otherwise(risk)
    risk = F.when(num("user_txn_count_5m") >= t["velocity_count_5m"], F.greatest(risk, elevated)).otherwise(risk)
    risk = F.when(num("user_amount_sum_1h") >= t["velocity_amount_1h"], F.greatest(risk, elevated)).otherwise(risk)
    risk = F.when(num("merchant_chargeback_rate_30d") >= t["merchant_risk"],
                  F.greatest(risk, elevated)).otherwise(risk)
    return P.clip(risk, 0.0, 1.0)


def score_rules(df: DataFrame, thresholds: dict | None = None, name: str = "rules_score") -> DataFrame:
    return df.withColumn(name, rules_score(df, thresholds))


def ensemble(rules: Column | str, champion: Column | str, anomaly: Column | str) -> Column:
    """M6: blend of the available scores, never below the rules score."""
    r, c, a = [F.col(x) if isinstance(x, str) else x for x in (rules, champion, anomaly)]
    r = F.coalesce(r, F.lit(0.0))
    wb = C.BLEND
    both = F.lit(wb["both"][0]) * c + F.lit(wb["both"][1]) * a
    c_only = F.lit(wb["champion_only"][0]) * c + F.lit(wb["champion_only"][1]) * r
    a_only = F.lit(wb["anomaly_only"][0]) * a + F.lit(wb["anomaly_only"][1]) * r
    return (F.when(c.isNotNull() & a.isNotNull(), F.greatest(r, both))
             .when(c.isNotNull(), F.greatest(r, c_only))
             .when(a.isNotNull(), F.greatest(r, a_only))
             .otherwise(r))


def blend_branch(champion: Column | str, anomaly: Column | str) -> Column:
    c, a = [F.col(x) if isinstance(x, str) else x for x in (champion, anomaly)]
    return (F.when(c.isNotNull() & a.isNotNull(), "both").when(c.isNotNull(), "champion_only")
             .when(a.isNotNull(), "anomaly_only").otherwise("rules_only"))


def fallback_flags(champion: Column | str, anomaly: Column | str,
                   feast_failed: Column | None = None) -> Column:
    """M7: map of fallback flags."""
    c, a = [F.col(x) if isinstance(x, str) else x for x in (champion, anomaly)]
    keys = ["rules_only", "champion_missing", "anomaly_missing"]
    vals = [c.isNull() & a.isNull(), c.isNull(), a.isNull()]
    if feast_failed is not None:
        keys.append("feast_failed")
        vals.append(F.coalesce(feast_failed, F.lit(False)))
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*vals))


def positive_score(c: Column | str, kind: str = "probability") -> Column:
    """M8: positive-class score of a model output.

    ``probability``: vector -> element 1 (a one-element vector -> 0.0);
    ``decision`` / ``prediction``: clamp the raw value to [0, 1].
    """
    from pyspark.ml.functions import vector_to_array

    col = F.col(c) if isinstance(c, str) else c
    if kind == "probability":
        arr = vector_to_array(col)
        return F.when(F.size(arr) > 1, F.element_at(arr, 2)).otherwise(F.lit(0.0))
    return P.clip(col.cast("double"), 0.0, 1.0)


def score_decisions(df: DataFrame, champion: Column | None, anomaly: Column | None,
                    served_by: Column | None = None, created_at: Column | None = None,
                    latency_total: Column | None = None, empty_features: Column | None = None,
                    rescored: Column | None = None, thresholds: dict | None = None,
                    velocity_method: str = "prefix", with_features: bool = True,
                    champion_type: str = "gbt", registry_mode: str = "local",
                    champion_ref: str = "") -> DataFrame:
    """M9: events -> velocity features -> rules / champion / anomaly -> blend -> tier -> log row."""
    from .windows import velocity_features

    f = velocity_features(df, method=velocity_method) if with_features else df
    champion = champion if champion is not None else F.lit(None).cast("double")
    anomaly = anomaly if anomaly is not None else F.lit(None).cast("double")
    f = (f.withColumn("_rules", rules_score(f, thresholds))
          .withColumn("_champ", champion)
          .withColumn("_anom", anomaly))
    final = ensemble("_rules", "_champ", "_anom")
    feat_names = [n for n, _, _ in C.VELOCITY_FEATURES] + C.CONSTANT_FEATURES
    fmap = F.map_from_arrays(F.array(*[F.lit(n) for n in feat_names]),
                             F.array(*[F.col(n).cast("double") for n in feat_names]))
    if empty_features is not None:
        fmap = F.when(empty_features, F.create_map().cast("map<string,double>")).otherwise(fmap)
    out = f.select(
        "event_id", "event_ts", *C.ID_COLUMNS, "amount", "country", "channel",
        F.coalesce(F.col("drift_phase"), F.lit(0)).cast("int").alias("drift_phase"),
        final.alias("final_score"),
        P.decide(final, thresholds).alias("decision"),
        F.struct(F.col("_rules").alias("rules"), F.col("_champ").alias("champion"),
                 F.col("_anom").alias("anomaly")).alias("scores"),
        fallback_flags("_champ", "_anom").alias("fallbacks"),
        F.struct(F.lit(champion_type).alias("champion_type"), F.lit(registry_mode).alias("registry_mode"),
                 P.model_ref(F.lit(champion_ref)).alias("champion_ref")).alias("model_versions"),
        fmap.alias("features"),
        F.struct(F.lit(None).cast("double").alias("rules"), F.lit(None).cast("double").alias("champion"),
                 F.lit(None).cast("double").alias("anomaly"),
                 (latency_total if latency_total is not None else F.lit(None)).cast("double").alias("total")
                 ).alias("latency_ms"),
        (served_by if served_by is not None else F.lit("v1")).alias("served_by"),
        (created_at if created_at is not None else F.col("event_ts")).alias("created_at"),
    )
    if rescored is not None:
        # a second row beside the first one, so the features below are computed once
        times = F.when(rescored, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        out = out.select("*", F.explode(times).alias("_again")).withColumn(
            "created_at", F.when(F.col("_again") == 1, F.col("created_at") + F.expr("INTERVAL 1 MINUTE")).otherwise(F.col("created_at"))).drop("_again")
    return out


def score_models(df: DataFrame, champion=None, forest: dict | None = None) -> DataFrame:
    """Adds ``champion_score``, ``anomaly_score`` and the milliseconds per row of both, in one Arrow pass.

    ``champion``: a ``TreeModel``; ``forest``: a fitted isolation forest (M5).  A missing model's columns are null.
    Both node tables are bounded by their parameters and go to the workers once.
    Works on a batch and on a stream.
    """
    import time

    from pyspark.sql.types import DoubleType, StructType

    from . import iforest as IF
    from . import tree_model as TM

    names, ctx = df.columns, df.sparkSession.sparkContext
    feats = [champion.features if champion else [], forest["features"] if forest else []]
    x = TM.model_inputs(TM.model_inputs(df, feats[0], "_c"), feats[1], "_a")
    bc = ctx.broadcast((champion, forest))

    def run(batches):
        import pyarrow as pa

        champ, iso = bc.value
        trees, cpsi = (IF._forest_arrays(iso), IF.c_factor(iso["psi"])) if iso else (None, 0.0)
        walk = IF._forest_steps(trees, len(feats[1])) if iso else None
        for b in batches:
            k, out = len(names), []
            t0 = time.perf_counter()
            if champ:
                f = TM._forest(champ)
                out.append(f.score(f.margin(TM._matrix(b, k, len(feats[0])))))
            t1 = time.perf_counter()
            if iso:
                out.append(IF.risk(IF.raw_scores(trees, TM._matrix(b, k + len(feats[0]), len(feats[1])), cpsi, walk), iso))
            t2 = time.perf_counter()
            ms = [1000 * t / max(1, b.num_rows) for t in (t1 - t0, t2 - t1)]
            none = pa.nulls(b.num_rows, pa.float64())
            scores = [pa.array(out.pop(0)) if m else none for m in (champ, iso)]
            spent = [pa.array([v] * b.num_rows, pa.float64()) if m else none for m, v in zip((champ, iso), ms)]
            yield pa.record_batch([*b.columns[:k], *scores, *spent], names=[*names, *MODEL_COLUMNS])

    schema = StructType([df.schema[c] for c in names])
    for c in MODEL_COLUMNS:
        schema = schema.add(c, DoubleType())
    return x.mapInArrow(run, schema)


MODEL_COLUMNS = ["champion_score", "anomaly_score", "champion_ms", "anomaly_ms"]


def score_events(events: DataFrame, snapshots: dict[str, DataFrame], champion=None, forest: dict | None = None,
                 served_by: str = "v1", created_at: Column | None = None, thresholds: dict | None = None,
                 registry_mode: str = "local") -> DataFrame:
    """M9 / ST10: events (batch or stream) -> feature snapshots (J8) -> three scores -> blend -> tier -> decision-log row.

    The scoring input takes the reference's defaults (P15) for missing context; features without a snapshot are 0
    for the models and absent from the logged feature map.  Flags: champion_missing, anomaly_missing,
    rules_only, feast_failed.  ``model_versions`` names the champion's type and the folder it was loaded from.
    """
    from .joins import online_features

    f = online_features(events, snapshots)
    feats = [c for s in snapshots.values() for c in s.columns if c not in snapshots and c in f.columns]
    # the features as found go through the workers as numbers; they become a map behind them, where one is asked for
    f = P.scoring_input(f.select("*", *[F.col(c).cast("double").alias(f"_given{i}") for i, c in enumerate(feats)]))
    f = score_models(f.withColumn("_rules", rules_score(f, thresholds)), champion, forest)
    given = F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in feats]), F.array(*[F.col(f"_given{i}") for i in range(len(feats))])),
                         lambda k, v: v.isNotNull())
    final = ensemble("_rules", "champion_score", "anomaly_score")
    about = champion.about if champion else {}
    text = lambda v: F.lit(v).cast("string")
    return f.select(
        "event_id", "event_ts", *C.ID_COLUMNS, "amount", "country", "channel", F.col("drift_phase").cast("int").alias("drift_phase"),
        final.alias("final_score"), P.decide(final, thresholds).alias("decision"),
        F.struct(F.col("_rules").alias("rules"), F.col("champion_score").alias("champion"), F.col("anomaly_score").alias("anomaly")).alias("scores"),
        fallback_flags("champion_score", "anomaly_score", F.col("feast_failed")).alias("fallbacks"),
        F.struct(text(about.get("champion_type")).alias("champion_type"), text(registry_mode).alias("registry_mode"),
                 P.model_ref(text(about.get("champion_ref"))).alias("champion_ref")).alias("model_versions"),
        given.alias("features"),
        F.struct(F.lit(0.0).alias("rules"), F.col("champion_ms").alias("champion"), F.col("anomaly_ms").alias("anomaly"),
                 (F.coalesce("champion_ms", F.lit(0.0)) + F.coalesce("anomaly_ms", F.lit(0.0))).alias("total")).alias("latency_ms"),
        F.lit(served_by).alias("served_by"), (created_at if created_at is not None else F.col("event_ts")).alias("created_at"), "feast_failed")


def to_decision_log(df: DataFrame, now=None) -> DataFrame:
    """The 18 inserted columns of a decision-log row with the reference's defaults applied.

    Absent or null: drift_phase 0, final_score 0.0, decision 'unknown', served_by 'v1', event_ts the current time;
    the JSON columns are an empty map or a struct of nulls.
    """
    def c(name, default):
        return F.coalesce(F.col(name), default) if name in df.columns else default

    def doc(names, kind):
        return F.struct(*[F.lit(None).cast(kind).alias(n) for n in names])

    now_col = P.ts_lit(P.parse_time(now or "now"))
    return df.select(
        c("event_id", F.lit(None).cast("string")).alias("event_id"),
        c("event_ts", now_col).alias("event_ts"),
        *[c(k, F.lit(None).cast("bigint")).alias(k) for k in C.ID_COLUMNS],
        c("amount", F.lit(None).cast("double")).alias("amount"),
        c("country", F.lit(None).cast("string")).alias("country"),
        c("channel", F.lit(None).cast("string")).alias("channel"),
        c("drift_phase", F.lit(0)).cast("int").alias("drift_phase"),
        c("final_score", F.lit(0.0)).cast("double").alias("final_score"),
        c("decision", F.lit("unknown")).alias("decision"),
        c("scores", doc(["rules", "champion", "anomaly"], "double")).alias("scores"),
        c("fallbacks", F.create_map().cast("map<string,boolean>")).alias("fallbacks"),
        c("model_versions", doc(["champion_type", "registry_mode", "champion_ref"], "string")).alias("model_versions"),
        c("features", F.create_map().cast("map<string,double>")).alias("features"),
        c("latency_ms", doc(["rules", "champion", "anomaly", "total"], "double")).alias("latency_ms"),
        c("served_by", F.lit("v1")).alias("served_by"),
    )
