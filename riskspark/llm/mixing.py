"""Mixing sources to target token weights by entropy balancing (DataFrame functions only).

Every document i of source s gets a rate ``r_i`` (expected copies).  Among all
rates that meet the token constraint ``sum r_i * size_i = target_s`` with
``0 <= r_i <= CAP`` the balanced ones minimise the relative entropy to the flat
rate 1, ``sum r_i log r_i - r_i + 1``; the convex dual has one multiplier per
source and the solution is the exponential tilt ``r_i = min(CAP, exp(lambda_s *
z_i))``, ``z_i = size_i / (token-weighted mean size of s)``.  Newton iterations
on the dual gradient ``g_s(lambda) = sum size_i r_i - target_s`` run for all
sources at once: one join + aggregate per iteration over the (source, size)
histogram, kept inside a bracket (a step that leaves it is replaced by the
bracket's middle).  The histogram has one row per distinct size of a source, so
the iterations do not grow with the number of documents or of copies.

Rounding: going from the largest size class to the smallest, each class takes
the whole number of copies nearest to its expected tokens plus the tokens still
owed; what is left passes on, so a source ends within about half of its smallest
document of the target.  Inside a class the copies are dealt by rank of a hash
of the document (ranks per hash bucket plus bucket offsets, so a class that
holds a third of all rows is spread over the buckets).

Edge cases: null text has size 0 and takes 0; a null source is its own source,
last in code point order; documents of size 0 take 0 copies; an empty table
gives an empty result; repeated rows are separate documents; extra columns of
the input are ignored.  Reruns give the same result (no random numbers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskspark.llm.common import materialize, ws_word_count

CAP = 3
BUCKETS = 64
MAX_ITERATIONS = 40
#: relative token error of a source at which its iteration stops
TOLERANCE = 1e-7


def source_targets(sizes: DataFrame, weights=(1, 2, 3), cap: int = CAP) -> DataFrame:
    """Target words per source: water-filling of the total by weight below ``cap`` x size.

    ``sizes``: source, source_size.  Sources in code point order (null last)
    weigh ``weights`` in turn.  A source that would get more than ``cap`` times
    its size is set to that; the rest is shared again.  In order of cap / weight
    the saturated sources come first, so the whole recursion is one running sum:
    source k is saturated if its cap is at most its share of what the sources
    before it leave.  One row per source goes through the ordered windows.
    """
    one = W.partitionBy(F.lit(1))
    n = len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("k") - 1, F.lit(n)) + 1).cast("int"))
    order = W.partitionBy(F.lit(1)).orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    s = (sizes.select("source", F.col("source_size").cast("long").alias("source_size"))
         .withColumn("k", F.row_number().over(order)).withColumn("w", w)
         .withColumn("cap", F.lit(float(cap)) * F.col("source_size")))
    fill = W.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("w"), "k")
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(one).cast("double"))
         .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("left_w", F.sum("w").over(one) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
         .withColumn("share", (F.col("total") - F.col("capped")) / F.col("left_w"))
         .withColumn("full", F.col("cap") <= F.col("share") * F.col("w")))
    # the level of the first source that is not saturated holds for all after it
    level = F.first(F.when(~F.col("full"), F.col("share")), ignorenulls=True).over(
        fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return (s.withColumn("level", level)
            .select("source", "source_size",
                    F.when(F.col("full") | F.col("level").isNull(), F.col("cap"))
                    .otherwise(F.least("cap", F.col("level") * F.col("w"))).alias("target")))


def tilt_rates(hist: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """Balanced rate of every (source, size) class: source, size, n, rate, target, source_size.

    ``hist``: source, size > 0, n.  ``targets``: source, source_size, target.
    """
    size, n = F.col("size").cast("double"), F.col("n").cast("double")
    h = hist.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    scale = hist.groupBy(F.col("source").alias("_s")).agg(
        (F.sum(size * size * n) / F.sum(size * n)).alias("mean"), F.max(size).alias("big"), F.min(size).alias("small"))
    h = materialize(h.join(scale, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
                    .withColumn("z", size / F.col("mean")), "mix-hist")
    # bracket: at lo all rates are (numerically) 0, at hi all are at the cap
    state = (scale.join(targets, F.col("_s").eqNullSafe(F.col("source"))).select(
        F.col("_s").alias("source"),
        (F.log("target") - F.log("source_size")).alias("lam"),
        (F.lit(-60.0) * F.col("mean") / F.col("small")).alias("lo"),
        (F.log(F.lit(float(cap))) * F.col("mean") / F.col("small")).alias("hi"),
        F.lit(False).alias("done")))
    state = materialize(state, "mix-state")
    for _ in range(MAX_ITERATIONS):
        lam = state.withColumnRenamed("source", "_s")
        r = F.least(F.exp(F.col("lam") * F.col("z")), F.lit(float(cap)))
        g = (h.join(lam, F.col("source").eqNullSafe(F.col("_s")))
             .groupBy("source").agg(
                 F.first("lam").alias("lam"), F.first("lo").alias("lo"), F.first("hi").alias("hi"),
                 F.first("done").alias("was"), F.first("target").alias("target"),
                 F.first("source_size").alias("source_size"),
                 F.sum(n * size * r).alias("got"),
                 F.sum(F.when(r < cap, n * size * F.col("z") * r).otherwise(0.0)).alias("slope")))
        over = F.col("got") > F.col("target")
        done = F.col("was") | (F.abs(F.col("got") - F.col("target")) <= TOLERANCE * F.col("target")) | (
            F.col("target") >= cap * F.col("source_size") * (1 - 1e-9))
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - (F.col("got") - F.col("target")) / F.col("slope")
        inside = (F.col("slope") > 0) & (step > F.col("lo")) & (step < F.col("hi"))
        state = materialize(
            g.withColumn("done", done).withColumn("lo", lo).withColumn("hi", hi)
            .select("source", F.when(F.col("done"), F.col("lam")).when(inside, step)
                    .otherwise((F.col("lo") + F.col("hi")) / 2).alias("lam"), "lo", "hi", "done"), "mix-state")
        if state.filter(~F.col("done")).isEmpty():
            break
    lam = state.select(F.col("source").alias("_s"), "lam")
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-9)
    return (h.join(lam, F.col("source").eqNullSafe(F.col("_s")))
            .select("source", "size", "n", "target", "source_size",
                    F.when(full, F.lit(float(cap))).otherwise(
                        F.least(F.exp(F.col("lam") * F.col("z")), F.lit(float(cap)))).alias("rate")))


def class_copies(rates: DataFrame, cap: int = CAP) -> DataFrame:
    """Whole copies per (source, size) class, tokens owed carried from large sizes to small.

    One source's classes go through one fold; their number is that of distinct
    document sizes, not of documents.
    """
    folded = F.aggregate(
        F.reverse(F.array_sort(F.collect_list(F.struct("size", "n", "rate")))),
        F.struct(F.lit(0.0).alias("owed"),
                 F.array().cast("array<struct<size:bigint,copies:bigint>>").alias("out")),
        lambda acc, x: _take(acc, x, cap), lambda acc: acc["out"])
    return (rates.groupBy("source").agg(folded.alias("out"))
            .select("source", F.explode("out").alias("c"))
            .select("source", "c.size", "c.copies"))


def _take(acc, x, cap: int):
    want = acc["owed"] + x["n"] * x["rate"] * x["size"]
    m = F.least(F.greatest(F.round(want / x["size"]), F.lit(0.0)), F.lit(float(cap)) * x["n"]).cast("long")
    return F.struct((want - m * x["size"]).alias("owed"),
                    F.concat(acc["out"], F.array(F.struct(x["size"].alias("size"), m.alias("copies")))).alias("out"))


def mix_sources(docs: DataFrame, weights=(1, 2, 3), cap: int = CAP) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken for every document."""
    sized = materialize(docs.select("doc_id", "source", ws_word_count(F.col("text")).alias("size")), "mix-sizes")
    hist = materialize(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-classes")
    per_source = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = materialize(source_targets(per_source, weights, cap), "mix-targets")
    rates = materialize(tilt_rates(hist.filter("size > 0"), targets.filter("target > 0"), cap), "mix-rates")
    copies = class_copies(rates, cap)
    # rank inside a class: per hash bucket, plus the offset of the bucket
    key = F.xxhash64("doc_id", "source")
    ranked = sized.withColumn("b", F.pmod(key, F.lit(BUCKETS)).cast("int")).withColumn("h", key)
    offsets = (ranked.groupBy("source", "size", "b").agg(F.count(F.lit(1)).alias("nb"))
               .withColumn("before", F.sum("nb").over(
                   W.partitionBy("source", "size").orderBy("b").rowsBetween(W.unboundedPreceding, 0)) - F.col("nb"))
               .select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("b").alias("_b"), "before"))
    classes = (hist.join(copies.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "copies"),
                         F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")), "left").drop("_s", "_z")
               .join(targets.select(F.col("source").alias("_s"), "source_size", "target"),
                     F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
               .join(rates.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "rate"),
                     F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")), "left").drop("_s", "_z"))
    per_bucket = offsets.join(classes, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")))
    per_bucket = per_bucket.select("_s", "_z", "_b", "before", "n", "source_size", "target",
                                   F.coalesce("copies", F.lit(0)).alias("m"), F.coalesce("rate", F.lit(0.0)).alias("rate"))
    rank = F.row_number().over(W.partitionBy("source", "size", "b").orderBy("h", "doc_id")) - 1
    out = (ranked.withColumn("i", rank)
           .join(per_bucket, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))
                 & (F.col("b") == F.col("_b"))))
    n_copies = (F.expr("m div n") + F.when(F.col("before") + F.col("i") < F.expr("m % n"), 1).otherwise(0)).cast("long")
    return (out.withColumn("copies", n_copies)
            .select("doc_id", "source", "size", "source_size", "target", "rate", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))
