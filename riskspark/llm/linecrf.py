"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad.  A line's features are shape counts
(character classes, words, repetition, being a copy of an earlier line) and the
same features of the line before and after it; the chain adds start and
transition weights.  Labelled documents give their label to their lines; the
weights maximise the conditional likelihood of the label chains (Adam on the
gradient from forward-backward).  A document's raw score is the mean marginal
probability of ``good`` weighted by line length, Platt-calibrated on sample
documents that the fit has not seen.

Edge cases: null or empty text is one empty line and gets that line's score;
blank lines are lines; without labels of both classes every score is the prior;
repeated rows are scored separately; an empty table gives an empty result;
other columns than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import textops as T
from riskspark.llm.common import arrow_batches
from riskspark.llm.labelled import labelled_sample, platt, sigmoid

#: labelled rows per class used for the fit
SAMPLE = 1500
EPOCHS, RATE, L2 = 150, 0.05, 1e-3
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b".,;:", b"!?",
           b"#*$%&", b"|<>", b"()[]{}\"'`", b"=+-_/\\@^~", bytes(range(128, 256))]
CLASS_OF = np.zeros(256, np.uint8)
for _k, _c in enumerate(CLASSES):
    CLASS_OF[list(_c)] = _k + 1
N_CLASSES = len(CLASSES) + 1
N_LINE = N_CLASSES + 9


def line_features(data, offsets):
    """(features, text index, length) of every line of a chunk; lines are what stands between line feeds."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    s = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    e = np.sort(np.concatenate([breaks, offsets[1:]]))
    per = 1 + np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1])
    t = np.repeat(np.arange(n), per)
    size = (e - s).astype(float)
    cols = []
    kind = CLASS_OF[data]
    for k in range(N_CLASSES):
        total = np.concatenate([[0], np.cumsum(kind == k, dtype=np.int64)])
        cols.append((total[e] - total[s]) / np.maximum(size, 1))
    h, wt, ws, we = T.words(data, offsets, fold=False)
    a, b = np.searchsorted(ws, s), np.searchsorted(ws, e)
    words = (b - a).astype(float)
    line_of = np.repeat(np.arange(len(s)), b - a)
    same = np.zeros(len(h))
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (line_of[1:] == line_of[:-1])
    distinct = np.bincount(T.distinct(h, line_of)[1], minlength=len(s)) if len(h) else np.zeros(len(s))
    chars = np.bincount(line_of, (we - ws).astype(float), minlength=len(s))
    lh, g = T.hashes(data, s, e), np.zeros(len(s), bool)
    o = np.lexsort((np.arange(len(s)), lh, t))
    g[o[1:]] = (lh[o][1:] == lh[o][:-1]) & (t[o][1:] == t[o][:-1])
    last = data[np.maximum(e - 1, 0)] if len(data) else np.zeros(len(s), np.uint8)
    cols += [np.log1p(size), np.log1p(words), chars / np.maximum(words, 1) / 10, np.bincount(line_of, same, minlength=len(s)) / np.maximum(words, 1),
             distinct / np.maximum(words, 1), (g & (words > 0)).astype(float), ((size > 0) & (last == 46)).astype(float),
             (size == 0).astype(float), (words == 1).astype(float)]
    return np.stack(cols, 1), t, np.maximum(size, 1)


def with_neighbours(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Features of a line, of the line before and of the line after (0 outside the text), and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    if len(x) > 1:
        same = (t[1:] == t[:-1])[:, None]
        before[1:], after[:-1] = x[:-1] * same, x[1:] * same
    return np.concatenate([x, before, after, np.ones((len(x), 1))], 1)


def chains(t: np.ndarray):
    """Step lists for chains of lines: for step k the line indices that are k-th in their text."""
    if not len(t):
        return []
    first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
    size = np.diff(np.append(first, len(t)))
    o = np.argsort(-size, kind="stable")
    first, size = first[o], size[o]
    return [first[:np.searchsorted(-size, -k, "left")] + k for k in range(int(size[0]))]


def forward_backward(odds: np.ndarray, t: np.ndarray, start: np.ndarray, trans: np.ndarray):
    """Marginals P(good) per line and the expected transition counts (2 x 2) of all chains.

    ``odds``: emission log-odds of good; ``start``: log weights of (bad, good); ``trans``: log weights.
    """
    steps = chains(t)
    emit = np.stack([sigmoid(-odds), sigmoid(odds)], 1) + 1e-12
    a = np.exp(trans - trans.max())
    f, bwd = np.empty_like(emit), np.ones_like(emit)
    for k, at in enumerate(steps):
        v = emit[at] * (np.exp(start) if k == 0 else f[at - 1] @ a)
        f[at] = v / v.sum(1, keepdims=True)
    pair = np.zeros((2, 2))
    for at in reversed(steps[1:]):
        w = emit[at] * bwd[at]
        joint = f[at - 1][:, :, None] * a * w[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        pair += joint.sum(0)
        v = w @ a.T
        bwd[at - 1] = v / v.sum(1, keepdims=True)
    m = f * bwd
    return m[:, 1] / m.sum(1), pair


def doc_scores(model: dict, x: np.ndarray, t: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Length-weighted mean marginal of good for texts 0..n-1."""
    z = with_neighbours((x - model["mean"]) / model["std"], t)
    good, _ = forward_backward(z @ model["w"], t, model["start"], model["trans"])
    return np.bincount(t, good * length, minlength=n) / np.maximum(np.bincount(t, length, minlength=n), 1e-9)


def _features_of_sample(batches):
    import pyarrow as pa

    for b in batches:
        for i, j, data, offs in T.chunks(b.column(3)):
            x, t, length = line_features(data, offs)
            cut = np.searchsorted(t, np.arange(j - i + 1))
            width = x.shape[1]
            yield pa.record_batch([b.column(c).slice(i, j - i) for c in range(3)] + [
                pa.ListArray.from_arrays(pa.array(cut * width, pa.int32()), pa.array(x.ravel(), pa.float32())),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(length))],
                names=["y", "weight", "key", "x", "length"])


def fit(sample: DataFrame) -> dict:
    tab = sample.select("y", "weight", "key", "text").mapInArrow(
        _features_of_sample, "y int, weight double, key long, x array<float>, length array<double>").toArrow()
    tab = tab.take(np.argsort(tab.column("key").to_numpy(), kind="stable"))
    y, weight = tab.column("y").to_numpy().astype(float), tab.column("weight").to_numpy()
    width = N_LINE
    model = {"mean": np.zeros(width), "std": np.ones(width), "w": np.zeros(3 * width + 1), "start": np.zeros(2), "trans": np.zeros((2, 2)), "a": 0.0, "b": 0.0}
    if not len(y) or y.min() == y.max():
        p = float((y * weight).sum() / max(weight.sum(), 1e-9)) if len(y) else 0.5
        return {**model, "b": float(np.log((p + 1e-3) / (1 - p + 1e-3)))}
    lengths = tab.column("length").combine_chunks()
    t = np.repeat(np.arange(len(y)), np.diff(lengths.offsets.to_numpy()))
    x = tab.column("x").combine_chunks().flatten().to_numpy().reshape(-1, width).astype(float)
    length = lengths.flatten().to_numpy()
    held = np.arange(len(y)) % 4 == 3
    use = ~held[t]
    model["mean"], model["std"] = x[use].mean(0), x[use].std(0) + 1e-3
    z = with_neighbours((x - model["mean"]) / model["std"], t)[use]
    tu, yu = t[use], y[t[use]]
    # every class weighs the same, every document as much as any other of its class
    lines = np.bincount(tu, minlength=len(y))
    each = np.where(y == 1, 0.5 / max(1, (y * ~held).sum()), 0.5 / max(1, ((1 - y) * ~held).sum())) / np.maximum(lines, 1)
    c = each[tu]
    seen_pair = np.zeros((2, 2))
    linked = tu[1:] == tu[:-1]
    np.add.at(seen_pair, (yu[:-1][linked].astype(int), yu[1:][linked].astype(int)), 1.0)
    p = np.zeros(z.shape[1] + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for k in range(1, EPOCHS + 1):
        w, trans = p[:-4], p[-4:].reshape(2, 2)
        good, pair = forward_backward(z @ w, tu, np.zeros(2), trans)
        g = np.concatenate([z.T @ (c * (good - yu)) + L2 * w,
                            ((pair - seen_pair) / max(1.0, seen_pair.sum())).ravel() + L2 * p[-4:]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= RATE * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    model["w"], model["trans"] = p[:-4].copy(), p[-4:].reshape(2, 2).copy()
    raw = doc_scores(model, x, t, length, len(y))
    a, b = platt(logit(raw[held]), y[held], weight[held])
    return {**model, "a": a, "b": b}


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def score_documents(docs: DataFrame, model: dict, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted, n_bad (lines more likely bad) for every document."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            m = shared.value
            for i, j, data, offs in T.chunks(b.column(1)):
                x, t, length = line_features(data, offs)
                score = sigmoid(m["a"] * logit(doc_scores(m, x, t, length, j - i)) + m["b"])
                yield pa.record_batch([b.column(0).slice(i, j - i), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                      names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def quality_documents(docs: DataFrame, labels: DataFrame, train=None, per_class: int = SAMPLE) -> DataFrame:
    arrow_batches(docs.sparkSession)
    return score_documents(docs, fit(labelled_sample(docs, labels, "quality", per_class, train)))
