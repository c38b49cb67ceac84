"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme-value statistics.

Tokens are runs of letters and digits (A-Z lower-cased).  A token's features are
itself and its byte prefixes of ``PREFIXES`` bytes, so an unseen ending of a known stem
still scores.  The fit counts every feature in distinct three-token contexts of
toxic and other labelled documents (copies of a document add nothing) and takes
the log-odds ratio under a Dirichlet prior, less one standard error; a token
scores the best of its features, capped, less a drift that makes ordinary text
lose score on average.

All maximal-scoring segments of a document (Ruzzo and Tompa) come from one
linear scan over its alternating runs of positive and negative tokens.  Under
ordinary text a segment of score S in n tokens is expected ``E = K n exp(-lambda
S)`` times (extreme-value statistics): lambda solves mean(exp(lambda s)) = 1 over tokens
of non-toxic documents, K is the Gumbel location of their best segments.  Segments with
E below ``SIGNIFICANT`` are passages; the document score is a Platt-calibrated
function of the evidence sum of its segments, fitted on sample documents that
the log-odds have not seen.

Edge cases: null, empty or token-free text has no segment and gets the lowest
score; without labels of both classes every score is the prior; repeated rows
are scored separately; an empty table gives an empty result; other columns than
doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import textops as T
from riskspark.llm.common import arrow_batches
from riskspark.llm.labelled import labelled_sample, platt, sigmoid

#: labelled rows per class used for the fit
SAMPLE = 3000
PREFIXES = (4, 5, 6)
PRIOR, CAP, FLOOR, DRIFT = 0.5, 6.0, -1.0, 0.75
SIGNIFICANT = 0.01
#: features seen in fewer distinct contexts are left out of the table
LEAST_CONTEXTS = 3
TOKEN = np.zeros(256, bool)
TOKEN[48:58] = TOKEN[65:91] = TOKEN[97:123] = True
TOKEN[128:] = True
BLOOM = 20


def token_features(data, offsets):
    """Feature hashes of every token, one row per token: (features, text index, start, end)."""
    s, e, t = T.spans(TOKEN[data], offsets)
    folded = T.FOLD[data]
    cols = [T.hashes(folded, s, e)]
    for k in PREFIXES:
        cols.append(T.mix(T.hashes(folded, s, np.minimum(s + k, e)) + np.uint64(k)))
    return np.stack(cols, 1) if len(s) else np.zeros((0, 1 + len(PREFIXES)), np.uint64), t, s, e


def _contexts(batches):
    """Sample rows to one row per token: context hash, class, features."""
    import pyarrow as pa

    for b in batches:
        y = b.column(0).to_numpy(zero_copy_only=False)
        for i, j, data, offs in T.chunks(b.column(1)):
            f, t, _, _ = token_features(data, offs)
            if not len(f):
                continue
            w = f[:, 0]
            same = t[1:] == t[:-1]
            before, after = np.zeros_like(w), np.zeros_like(w)
            before[1:][same], after[:-1][same] = w[:-1][same], w[1:][same]
            ctx = T.mix(before * T.MIX1 + w) + T.mix(after * T.MIX2 + np.uint64(5))
            n = f.shape[1]
            yield pa.record_batch([
                pa.array(ctx.view(np.int64)), pa.array(y[i:j][t], pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1) * n, pa.int32()), pa.array(f.ravel().view(np.int64)))],
                names=["ctx", "y", "features"])


def fit_lexicon(sample: DataFrame) -> dict:
    """Feature hash -> score, from distinct contexts of the sample."""
    rows = (sample.select("y", "text").mapInArrow(_contexts, "ctx long, y int, features array<long>")
            .dropDuplicates(["ctx", "y"]))
    counts = (rows.select("y", F.explode("features").alias("f")).groupBy("f")
              .agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("other"))
              .filter(F.col("toxic") + F.col("other") >= LEAST_CONTEXTS).toArrow())
    key = counts.column("f").to_numpy().view(np.uint64)
    a, b = counts.column("toxic").to_numpy().astype(float), counts.column("other").to_numpy().astype(float)
    if not len(key):
        return {"key": key, "score": np.zeros(0)}
    na, nb = a.sum() + 1, b.sum() + 1
    prior = PRIOR * 2                       # Dirichlet mass per feature, split by the share of each class
    pa_, pb = prior * na / (na + nb), prior * nb / (na + nb)
    odds = np.log((a + pa_) / na) - np.log((b + pb) / nb)
    score = odds - np.sqrt(1 / (a + pa_) + 1 / (b + pb)) * np.minimum(1.0, 3.0 / np.sqrt(a + b))
    score = np.clip(score, FLOOR, CAP)
    o = np.argsort(key)
    return {"key": key[o], "score": score[o]}


def token_scores(lexicon: dict, features: np.ndarray) -> np.ndarray:
    """Score of every token: its best known feature, less the drift."""
    n, k = features.shape
    best = np.full(n, -np.inf)
    key, score = lexicon["key"], lexicon["score"]
    if len(key):
        bloom = np.zeros(1 << BLOOM, bool)
        bloom[(key >> np.uint64(64 - BLOOM)).astype(np.int64)] = True
        for c in range(k):
            f = features[:, c]
            at = np.flatnonzero(bloom[(f >> np.uint64(64 - BLOOM)).astype(np.int64)])
            p = np.minimum(np.searchsorted(key, f[at]), len(key) - 1)
            hit = key[p] == f[at]
            at = at[hit]
            best[at] = np.maximum(best[at], score[p[hit]])
    best[np.isinf(best)] = 0.0
    return best - DRIFT


def maximal_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of one document, in order, in linear time."""
    positive = score > 0
    if not positive.any():
        return []
    cut = np.flatnonzero(np.append(True, positive[1:] != positive[:-1]))
    total = np.add.reduceat(score, cut)
    ends = np.append(cut[1:], len(score)) - 1
    stack: list[list] = []                  # [sum left of it, sum through it, first, last, best earlier index with smaller left]
    run = 0.0
    for x, first, last in zip(total.tolist(), cut.tolist(), ends.tolist()):
        if x <= 0:
            run += x
            continue
        seg = [run, run + x, first, last, -1]
        run += x
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= seg[0]:
                j = stack[j][4]
            seg[4] = j
            if j < 0 or stack[j][1] >= seg[1]:
                stack.append(seg)
                break
            seg = [stack[j][0], seg[1], stack[j][2], seg[3], -1]
            del stack[j:]
    return [(s[2], s[3], s[1] - s[0]) for s in stack]


def _per_text(model, data, offsets):
    """For every text of a chunk: segments, token count, and the tokens' byte spans."""
    f, t, s, e = token_features(data, offsets)
    score = token_scores(model["lexicon"], f)
    n = len(offsets) - 1
    first = np.searchsorted(t, np.arange(n + 1))
    some = np.flatnonzero(np.bincount(t[score > 0], minlength=n)) if len(t) else []
    found = [[] for _ in range(n)]
    for k in some:
        found[k] = maximal_segments(score[first[k]:first[k + 1]])
    return found, np.diff(first), first, s, e, score


def evidence(segments, tokens: int, model) -> float:
    """Sum of -log E over the segments that beat chance (E < 1); the best segment's -log E if none does."""
    if not segments or tokens == 0:
        return -np.log(max(model["K"], 1e-12) * max(tokens, 1) + 1)
    logs = [model["lambda"] * x - np.log(model["K"] * tokens) for _, _, x in segments]
    good = [v for v in logs if v > 0]
    return float(sum(good)) if good else float(max(logs))


def fit(sample: DataFrame) -> dict:
    """Lexicon on 7 of 10 sample documents; lambda, K and the Platt curve on the others."""
    part = F.pmod(F.col("key"), F.lit(10))
    model = {"lexicon": fit_lexicon(sample.filter(part < 7)), "lambda": 1.0, "K": 0.1, "a": 1.0, "b": 0.0}
    rest = sample.filter(part >= 7).select("y", "weight", "key", "text").mapInArrow(
        _summaries(model), "y int, weight double, key long, n long, segments array<double>, hist array<long>").toPandas()
    rest = rest.sort_values("key")
    y = rest.y.to_numpy(float)
    if not len(y) or y.min() == y.max():
        p = float((rest.y * rest.weight).sum() / max(rest.weight.sum(), 1e-9)) if len(y) else 0.5
        return {**model, "a": 0.0, "b": float(np.log((p + 1e-3) / (1 - p + 1e-3)))}
    null = rest[rest.y == 0]
    hist = np.sum(np.stack([np.asarray(x) for x in null["hist"]]), 0).astype(float)
    p = hist / max(hist.sum(), 1)
    lo, hi = 1e-3, 5.0                      # lambda: mean(exp(lambda s)) = 1, s on the histogram's grid
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * GRID, 500))).sum() < 1 else (lo, mid)
    model["lambda"] = lam = max(0.2, min(lo, 3.0))
    best = np.array([max(s) if len(s) else 0.0 for s in null.segments])
    x = lam * best - np.log(np.maximum(null.n.to_numpy(float), 1))
    model["K"] = float(1 / np.mean(np.exp(-np.clip(x, -50, 50))))
    z = np.array([evidence([(0, 0, v) for v in s], n, model) for s, n in zip(rest.segments, rest.n)])
    a, b = platt(np.clip(z, -20, 60), y, rest.weight.to_numpy())
    return {**model, "a": a, "b": b}


GRID = np.linspace(FLOOR - DRIFT, CAP - DRIFT, 256)


def _summaries(model):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for i, j, data, offs in T.chunks(b.column(3)):
                found, n, first, _, _, score = _per_text(model, data, offs)
                cell = np.clip(np.rint((score - GRID[0]) / (GRID[1] - GRID[0])), 0, 255).astype(np.int64)
                hist = [np.bincount(cell[first[k]:first[k + 1]], minlength=256) for k in range(j - i)]
                yield pa.record_batch([b.column(c).slice(i, j - i) for c in range(3)]
                                      + [pa.array(n, pa.int64()), pa.array([[x for _, _, x in s] for s in found], pa.list_(pa.float64())),
                                         pa.array(hist, pa.list_(pa.int64()))],
                                      names=["y", "weight", "key", "n", "segments", "hist"])
    return run


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, predicted, passages (byte start, byte end, score, E-value) for every document."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e", pa.float64())]))
        for b in batches:
            m = shared.value
            for i, j, data, offs in T.chunks(b.column(1)):
                found, n, first, s, e, _ = _per_text(m, data, offs)
                z = np.array([evidence(x, c, m) for x, c in zip(found, n)])
                score = sigmoid(m["a"] * np.clip(z, -20, 60) + m["b"])
                passages = []
                for k, segs in enumerate(found):
                    rows = []
                    for a, z_, x in segs:
                        ev = float(m["K"] * n[k] * np.exp(-m["lambda"] * x))
                        if ev < SIGNIFICANT:
                            rows.append({"start": int(s[first[k] + a] - offs[k]), "end": int(e[first[k] + z_] - offs[k]), "score": x, "e": ev})
                    passages.append(rows)
                yield pa.record_batch([b.column(0).slice(i, j - i), pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                                       pa.array(passages, kind)], names=["doc_id", "score", "predicted", "passages"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int, passages array<struct<start:long,end:long,score:double,e:double>>")


def toxic_documents(docs: DataFrame, labels: DataFrame, train=None, per_class: int = SAMPLE) -> DataFrame:
    arrow_batches(docs.sparkSession)
    return score_documents(docs, fit(labelled_sample(docs, labels, "toxic", per_class, train)))
