"""Model operators: supervised training (M2-M4), champion choice (M11),
feature importances (M15), linear attribution (M14, linear path).

Training uses Spark ML estimators (distributed tree / gradient computation on
executors); scoring is ``model.transform`` -- a projection that stays in the
same plan as the rules and ensemble columns.  The isolation forest (M5) and
tree attribution (M14, tree path) live in ``iforest.py`` / ``attribution.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def choose_champion(metrics: DataFrame, fpr_max: float = C.CHAMPION_MAX_FPR, model_col: str = "model",
                    order_col: str | None = None) -> DataFrame:
    """Among models with fpr <= fpr_max (or all, if none qualifies) the max pr_auc; first on ties."""
    m = metrics.withColumn("_elig", F.col("fpr") <= F.lit(fpr_max))
    any_elig = m.agg(F.max(F.col("_elig").cast("int"))).scalar()
    cand = m.where(F.col("_elig") | (F.coalesce(any_elig, F.lit(0)) == 0))
    order = F.col(order_col) if order_col else F.lit(0)
    return cand.agg(F.max_by(F.col(model_col), F.struct(F.col("pr_auc"), -order)).alias("champion"))


def assemble(df: DataFrame, features: list[str], out: str = "features_vec") -> DataFrame:
    """Feature columns -> ML vector (nulls -> 0)."""
    from pyspark.ml.feature import VectorAssembler

    filled = df.select("*", *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"_v{i}")
                              for i, c in enumerate(features)])
    va = VectorAssembler(inputCols=[f"_v{i}" for i in range(len(features))], outputCol=out, handleInvalid="keep")
    return va.transform(filled).drop(*[f"_v{i}" for i in range(len(features))])


def train_gbt(df: DataFrame, features: list[str], label: str = "label", weight: str | None = None,
              max_iter: int = 400, step: float = 0.05, depth: int = 6, subsample: float = 0.8,
              colsample: str = "0.8", seed: int = 42, validation: float = 0.2, tolerance: float = 0.01):
    """M2 (+M4): gradient-boosted trees; a single-class label gives a constant-prior model.

    ``validation`` is the share of rows (by a hash of their values, the same on every run) that is held out to
    end the boosting once a further tree lowers its error by less than ``tolerance``; 0 always grows ``max_iter``
    trees.  The assembled features are written once (Parquet, shared folder) and read by all rounds.
    """
    from pyspark.ml.classification import GBTClassifier

    from ..session import scratch_path

    held = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in features]), F.lit(10_000)) < F.lit(int(validation * 10_000))
    d = df.withColumn("_held", held)
    classes = d.agg(F.countDistinct(label).alias("k"), F.avg(F.col(label).cast("double")).alias("p"), F.count_if("_held").alias("held"),
                    F.countDistinct(F.when(~F.col("_held"), F.col(label))).alias("k_train")).first()
    if classes["k"] < 2:
        return ConstantModel(float(classes["p"] or 0.0))
    gbt = GBTClassifier(featuresCol="features_vec", labelCol=label, maxIter=max_iter, stepSize=step,
                        maxDepth=depth, subsamplingRate=subsample, featureSubsetStrategy=colsample, seed=seed)
    if weight:
        gbt = gbt.setWeightCol(weight)
    x = assemble(d.withColumn(label, F.col(label).cast("double")), features).select("features_vec", label, "_held", *([weight] if weight else []))
    path = scratch_path(df.sparkSession, "gbt-input")
    x.write.parquet(path)
    x = df.sparkSession.read.schema(x.schema).parquet(path)
    if validation and classes["held"] and classes["k_train"] > 1:
        gbt = gbt.copy({gbt.validationIndicatorCol: "_held", gbt.validationTol: tolerance})
    return gbt.fit(x)


def train_logreg(df: DataFrame, features: list[str], label: str = "label", weight: str | None = "weight"):
    """M3: class-weighted logistic regression (weights from A11 when ``weight`` is missing)."""
    from pyspark.ml.classification import LogisticRegression

    from .metrics import with_class_weight

    d = df if (weight is None or weight in df.columns) else with_class_weight(df, label, weight)
    lr = LogisticRegression(featuresCol="features_vec", labelCol=label, maxIter=100)
    if weight:
        lr = lr.setWeightCol(weight)
    return lr.fit(assemble(d.withColumn(label, F.col(label).cast("double")), features))


class ConstantModel:
    """M4: prior-only model for single-class training data (positive score = prior, or 0)."""

    def __init__(self, prior: float):
        self.prior = prior

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("score", F.lit(self.prior if self.prior in (0.0, 1.0) else 0.0))


def score_model(model, df: DataFrame, features: list[str], out: str = "score") -> DataFrame:
    """Positive-class score column from a fitted model (M8 clamp for non-probability outputs)."""
    from .scoring import positive_score

    if isinstance(model, ConstantModel):
        return model.transform(df).withColumnRenamed("score", out)
    t = model.transform(assemble(df, features))
    if "probability" in t.columns:
        t = t.withColumn(out, positive_score("probability"))
    else:
        t = t.withColumn(out, positive_score("prediction", kind="prediction"))
    return t.drop("features_vec", "rawPrediction", "probability", "prediction")


def feature_importances(model, features: list[str], spark) -> DataFrame:
    """Model importances as a DataFrame (driver holds only the feature list)."""
    imp = model.featureImportances.toArray().tolist() if hasattr(model, "featureImportances") else \
        [abs(x) for x in model.coefficients.toArray().tolist()]
    return spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")


def fit_slopes(df: DataFrame, features: list[str], target: str) -> dict:
    """Least-squares slope of the target on each feature alone (0 for a constant one) and the feature means, in one aggregate."""
    x = {f: F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in features}
    y = F.col(target)
    row = df.agg(*[F.covar_pop(y, c).alias(f"c{i}") for i, c in enumerate(x.values())],
                 *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(x.values())],
                 *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x.values())]).first()
    return {"slopes": {f: (row[f"c{i}"] or 0.0) / row[f"v{i}"] if row[f"v{i}"] else 0.0 for i, f in enumerate(features)},
            "means": {f: row[f"m{i}"] or 0.0 for i, f in enumerate(features)}}


def linear_attribution(df: DataFrame, coefs: dict[str, float], means: dict[str, float] | DataFrame,
                       key: str = "event_id") -> DataFrame:
    """M14 (linear path): contribution = coef * (x - mean), long form ``(event_id, feature, contribution)``.

    Pure column arithmetic + one ``stack`` -- no Python per row.
    """
    feats = list(coefs)
    if isinstance(means, DataFrame):
        row = means.first().asDict()
        means = {f: float(row[f]) for f in feats}
    pairs = ", ".join(f"'{f}', `_c{i}`" for i, f in enumerate(feats))
    wide = df.select(key, *[(F.lit(float(coefs[f])) * (F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0))
                                                      - F.lit(float(means[f])))).alias(f"_c{i}")
                            for i, f in enumerate(feats)])
    return wide.selectExpr(key, f"stack({len(feats)}, {pairs}) as (feature, contribution)")
