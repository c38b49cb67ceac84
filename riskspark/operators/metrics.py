"""Aggregations and model metrics.

* Slice metrics are one aggregation over an ``unpivot`` of the slice
  dimensions (U1): one scan, map-side partial aggregation, one small shuffle --
  instead of one pass per dimension.
* Ranking metrics (ROC AUC, average precision, best-F1 threshold) first
  collapse the data to one row per distinct score (``groupBy(score)`` with
  partial aggregation: a hot score value costs nothing), then take prefix sums
  with the bucketed kernel of ``prefix.py`` -- never a window without
  ``partitionBy``.
* Ratios of integer counts are single IEEE divisions; averages of doubles are
  rounded to 6 places (summation order differs between engines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .prefix import cumulative, global_rank


def _div(a: Column, b: Column) -> Column:
    """a / b as double, 0 when b == 0 (zero_division = 0)."""
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """precision, recall, F1 from counts (F1 = 2tp / (2tp + fp + fn))."""
    return [_div(tp, tp + fp).alias("precision"), _div(tp, tp + fn).alias("recall"),
            _div(2 * tp, 2 * tp + fp + fn).alias("f1")]


def confusion_aggs(label: Column, pred: Column) -> list[Column]:
    """A4: tp / fp / tn / fn as count_if aggregates."""
    return [F.count_if((label == 1) & (pred == 1)).alias("tp"), F.count_if((label == 0) & (pred == 1)).alias("fp"),
            F.count_if((label == 0) & (pred == 0)).alias("tn"), F.count_if((label == 1) & (pred == 0)).alias("fn")]


def slice_metrics(df: DataFrame, dims=None, t: float = C.SLICE_THRESHOLD, label: str = "label",
                  score: str = "final_score", decision: str | None = "decision",
                  with_scores: bool = True) -> DataFrame:
    """A1/A3 (+U1): per (dimension, value): [avg score, block rate,] precision, recall, F1, count.

    Null dimension values are dropped (as a group-by would).
    """
    dims = dims or C.SLICE_DIMS
    keep = [score, label] + ([decision] if decision and with_scores else [])
    base = df.select(*keep, *[F.col(d).cast("string").alias(d) for d in dims])
    long = base.unpivot(keep, dims, "slice", "value").where(F.col("value").isNotNull())
    lab = F.coalesce(F.col(label).cast("int"), F.lit(0))
    pred = (F.col(score) >= F.lit(float(t))).cast("int")
    aggs = confusion_aggs(lab, pred) + [F.count(F.lit(1)).alias("count")]
    if with_scores:
        aggs += [F.round(F.avg(score), 6).alias("avg_score"),
                 _div(F.count_if(F.col(decision) == "block"), F.count(F.lit(1))).alias("block_rate")]
    g = long.groupBy("slice", "value").agg(*aggs)
    cols = ["slice", "value"] + (["avg_score", "block_rate"] if with_scores else [])
    return g.select(*cols, *prf(F.col("tp"), F.col("fp"), F.col("fn")), "count")


def performance(df: DataFrame, t: float = C.PERF_THRESHOLD, label: str = "true_label",
                score: str = "final_score", min_rows: int = C.MIN_ROWS_PERF,
                with_auc: bool = True) -> DataFrame:
    """A4/A5/A21 (+A6): one-row overall record with the insufficient-data guard."""
    lab = F.col(label).cast("int")
    pred = (F.col(score) >= F.lit(float(t))).cast("int")
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(lab).alias("_classes"),
                 *confusion_aggs(lab, pred))
    out = row.select("rows", F.lit(float(t)).alias("threshold"),
                     *prf(F.col("tp"), F.col("fp"), F.col("fn")), "tp", "fp", "tn", "fn",
                     ((F.col("rows") >= min_rows) & (F.col("_classes") >= 2)).alias("_ok"))
    if with_auc:
        auc = roc_auc(df, score, label)
        out = out.withColumn("auc", auc.select("auc").scalar())
    # below the guard there is no metric, only the row count and the reason
    for c in ["precision", "recall", "f1", "tp", "fp", "tn", "fn"] + (["auc"] if with_auc else []):
        out = out.withColumn(c, F.when(F.col("_ok"), F.col(c)))
    status = F.when(F.col("_ok"), "ok").otherwise("insufficient_data")
    return out.withColumn("status", status).withColumn(
        "reason", F.when(F.col("_ok"), "ok").otherwise("insufficient labeled data")).drop("_ok")


def score_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """Distinct scores with positive / negative counts (partial aggregation)."""
    lab = F.col(label).cast("int")
    return (df.where(F.col(score).isNotNull() & lab.isNotNull())
              .groupBy(F.col(score).alias("s"))
              .agg(F.count_if(lab == 1).alias("pos"), F.count_if(lab == 0).alias("neg")))


def roc_auc(df: DataFrame, score: str = "final_score", label: str = "label",
            one_class: float | None = None) -> DataFrame:
    """ROC AUC with ties counted 1/2; one class -> ``one_class`` (null by default).

    AUC = sum_s neg_s * (pos above s + pos_s / 2) / (P * N), exact in DECIMAL(38,0)
    (the products leave the bigint range from about 3e9 rows of each class).
    """
    st = cumulative(score_table(df, score, label), "s", ["pos", "neg"])
    neg, pos = F.col("neg").cast("decimal(19,0)"), F.col("pos").cast("decimal(19,0)")
    above = (F.col("cum_total_pos") - F.col("cum_pos")).cast("decimal(19,0)")
    agg = st.agg(F.sum((neg * (above + above + pos)).cast("decimal(38,0)")).alias("num"),
                 F.sum("pos").cast("decimal(19,0)").alias("P"), F.sum("neg").cast("decimal(19,0)").alias("N"))
    val = F.when((F.col("P") > 0) & (F.col("N") > 0),
                 F.col("num").cast("double") / (F.col("P") * F.col("N") * 2).cast("double"))
    if one_class is not None:
        val = F.coalesce(val, F.lit(float(one_class)))
    return agg.select(val.alias("auc"))


def pr_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score (descending): tp / fp at threshold ``>= s``, precision, recall."""
    # one ascending pass: tp(s) = positives with score >= s = P - cum_pos(s) + pos(s)
    st = cumulative(score_table(df, score, label), "s", ["pos", "neg"])
    P = F.col("cum_total_pos")
    tp = P - F.col("cum_pos") + F.col("pos")
    fp = F.col("cum_total_neg") - F.col("cum_neg") + F.col("neg")
    return st.select("s", "pos", "neg", tp.alias("tp"), fp.alias("fp"), P.alias("P"),
                     _div(tp, tp + fp).alias("precision"), _div(tp, P).alias("recall"))


def pr_auc(df: DataFrame, score: str = "final_score", label: str = "label") -> DataFrame:
    """Average precision = sum over thresholds of (recall step) * precision; 0.0 without positives or rows."""
    t = pr_table(df, score, label)
    step = F.try_divide(F.col("pos").cast("double"), F.col("P").cast("double")) * F.col("precision")
    return t.agg(F.coalesce(F.round(F.sum(step), 9), F.lit(0.0)).alias("pr_auc"))


def best_f1_threshold(df: DataFrame, score: str = "final_score", label: str = "label") -> DataFrame:
    """Threshold with the highest F1 = 2PR / (P + R + 1e-12); first (lowest) on ties; .5 if none."""
    t = pr_table(df, score, label).withColumn(
        "f1", (F.lit(2.0) * F.col("precision") * F.col("recall"))
        / (F.col("precision") + F.col("recall") + F.lit(1e-12)))
    best = t.agg(F.max_by(F.struct("s", "f1"), F.struct(F.col("f1"), -F.col("s"))).alias("b"))
    return best.select(F.coalesce(F.col("b.s"), F.lit(0.5)).alias("threshold"), F.col("b.f1").alias("f1"))


def precision_at(df: DataFrame, frac: float = 0.05, score: str = "final_score", label: str = "label",
                 tie: str = "event_id") -> DataFrame:
    """Mean label of the top k = max(1, floor(frac * n)) scores (ties by ``tie``).

    Whole scores above the k-th come from the table of distinct scores (partial
    aggregation, so a hot score is one row); only the rows of the boundary score
    are ranked, by ``tie``.
    """
    n = df.count()
    k = max(1, int(n * frac))
    lab = F.col(label).cast("double")
    per = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(lab), F.lit(0.0)).alias("hit"), F.count(lab).alias("known"))
    c = cumulative(per.where("s is not null"), "s", ["n", "hit", "known"], descending=True)
    above = c.where(F.col("cum_n") <= k).agg(F.sum("n").alias("n"), F.sum("hit").alias("hit"), F.sum("known").alias("known")).first()
    edge = c.where((F.col("cum_n") > k) & (F.col("cum_n") - F.col("n") < k)).agg(F.max("s")).first()[0]
    hit, known, taken = above["hit"] or 0.0, above["known"] or 0, above["n"] or 0
    if edge is None or taken >= k:
        return df.sparkSession.range(1).select(F.lit(hit / known if known else None).cast("double").alias("precision_at"))
    ranked = global_rank(df.where(F.col(score).cast("double") == F.lit(edge)), [tie])
    rest = ranked.where(F.col("_rank") < k - taken)
    return rest.agg(F.try_divide(F.coalesce(F.sum(lab), F.lit(0.0)) + F.lit(hit), F.count(lab) + F.lit(known)).alias("precision_at"))


def fpr(df: DataFrame, t: float, score: str = "final_score", label: str = "label") -> DataFrame:
    """A10: false-positive rate at threshold (0 when there are no negatives)."""
    lab = F.col(label).cast("int")
    return df.agg(_div(F.count_if((lab == 0) & (F.col(score) >= t)), F.count_if(lab == 0)).alias("fpr"))


def evaluate_scores(df: DataFrame, t: float, score: str = "score", label: str = "label",
                    tie: str = "event_id") -> DataFrame:
    """roc_auc, pr_auc, precision, recall, f1, precision_at_5p, fpr in one row.

    The input is persisted for the handful of passes (confusion counts, one
    distinct-score table, one ranked top-k) and released once the one-row record
    is computed.
    """
    spark = df.sparkSession
    d = df.select(score, label, tie).persist()
    try:
        lab = F.col(label).cast("int")
        pred = (F.col(score) >= F.lit(float(t))).cast("int")
        base = d.agg(*confusion_aggs(lab, pred)).select(
            *prf(F.col("tp"), F.col("fp"), F.col("fn")),
            _div(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr")).first()
        auc = roc_auc(d, score, label).first()["auc"]
        ap = pr_auc(d, score, label).first()["pr_auc"]
        p5 = precision_at(d, 0.05, score, label, tie).first()["precision_at"]
    finally:
        d.unpersist()
    row = (float(auc or 0.0), float(ap or 0.0), base["precision"], base["recall"], base["f1"],
           None if p5 is None else float(p5), base["fpr"])
    return spark.createDataFrame([row], "roc_auc double, pr_auc double, precision double, recall double, "
                                        "f1 double, precision_at_5p double, fpr double")


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Positives, negatives, scale_pos_weight (1.0 without positives)."""
    lab = F.col(label).cast("int")
    return df.agg(F.count_if(lab == 1).alias("positives"), F.count_if(lab == 0).alias("negatives")).withColumn(
        "scale_pos_weight", F.when(F.col("positives") > 0, F.col("negatives") / F.col("positives"))
        .otherwise(F.lit(1.0)))


def with_class_weight(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Per-row weight: scale_pos_weight for positives, 1 for negatives (scalar subquery)."""
    spw = class_balance(df, label).select("scale_pos_weight").scalar()
    return df.withColumn(name, F.when(F.col(label).cast("int") == 1, spw).otherwise(F.lit(1.0)))


def fingerprint(df: DataFrame, ts: str, features: list[str]) -> DataFrame:
    """Rows, min / max timestamp, feature list and its hash."""
    from ..functions.scalar import feature_hash_text
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")) \
        .withColumn("features", F.lit(",".join(features))) \
        .withColumn("feature_hash", F.lit(feature_hash_text(features)))


def compare_models(df: DataFrame, decision: str | None = None, key: str = "served_by") -> DataFrame:
    """Per model: count, avg score, block / review / step_up rates, by count desc."""
    d = df if decision is None else df.where(F.col("decision") == decision)
    n = F.count(F.lit(1))
    g = d.groupBy(F.col(key).alias("_k")).agg(
        n.alias("count"), F.round(F.avg("final_score"), 6).alias("avg_score"),
        _div(F.count_if(F.col("decision") == "block"), n).alias("block_rate"),
        _div(F.count_if(F.col("decision") == "review"), n).alias("review_rate"),
        _div(F.count_if(F.col("decision") == "step_up"), n).alias("step_up_rate"))
    return g.select(F.coalesce(F.col("_k"), F.lit("unknown")).alias("model"), "count", "avg_score",
                    "block_rate", "review_rate", "step_up_rate").orderBy(F.col("count").desc(), "model")


def compare_models_labeled(df: DataFrame, t: float = C.PERF_THRESHOLD, key: str = "served_by") -> DataFrame:
    """Per model precision / recall at ``t`` on labeled rows."""
    lab = F.col("label").cast("int")
    pred = (F.col("final_score") >= F.lit(float(t))).cast("int")
    g = df.groupBy(F.coalesce(F.col(key), F.lit("unknown")).alias("model")).agg(
        *confusion_aggs(lab, pred), F.count(F.lit(1)).alias("count"))
    return g.select("model", _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    _div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), "count")


def decision_distribution(df: DataFrame) -> DataFrame:
    """Count per tier and share of the total (total via scalar subquery, max(1, n))."""
    total = df.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    return df.groupBy("decision").agg(F.count(F.lit(1)).alias("count")).withColumn(
        "share", F.col("count").cast("double") / total.cast("double"))


def latency_summary(df: DataFrame, col: str = "latency_total", q: float = 0.95,
                    exact: bool = True) -> DataFrame:
    """Average and p95 (value at sorted index floor(q * n)).

    ``exact`` finds the value in the running counts of the distinct values (a
    value of a third of all rows is one row); ``exact=False`` uses
    ``percentile_approx`` (one pass, bounded memory) for very large tables.
    """
    d = df.where(F.col(col).isNotNull())
    avg = F.round(F.avg(col), 6).alias("avg_ms")
    if not exact:
        return d.agg(avg, F.percentile_approx(col, q).alias("p95_ms"))
    n = d.count()
    idx = min(max(n - 1, 0), int(q * n))
    c = cumulative(d.groupBy(F.col(col).alias("x")).agg(F.count(F.lit(1)).alias("n")), "x", ["n"])
    p = c.where(F.col("cum_n") > idx).agg(F.min("x")).scalar()
    return d.agg(avg).withColumn("p95_ms", p)


def serving_counters(df: DataFrame) -> DataFrame:
    """Requests, fallback counts by type, feature-lookup and model failures (long form)."""
    n = df.agg(F.count(F.lit(1)).alias("value")).select(F.lit("requests").alias("counter"), "value")
    fb = (df.select(F.explode(F.map_keys(F.map_filter("fallbacks", lambda k, v: F.coalesce(v, F.lit(False)))))
                    .alias("k"))
            .groupBy(F.concat(F.lit("fallback:"), F.col("k")).alias("counter")).agg(F.count(F.lit(1)).alias("value")))
    return n.unionByName(fb)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table (one aggregate each, union)."""
    out = None
    for name, d in tables.items():
        r = d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = r if out is None else out.unionByName(r)
    return out
