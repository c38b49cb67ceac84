"""Quality rules: base counts of a text, and a calibrated n-gram logistic regression against a fixed threshold.

Model: hashed word unigrams, word bigrams and byte trigrams of the whole text;
the value of an n-gram is its share of the text's n-grams of that group, so the
log-odds of a text are the mean weights of its three groups plus a bias.  It is
fitted (Adam, L2) on at most ``2 * SAMPLE`` labelled rows, calibrated by Platt
scaling on a quarter of them that the fit does not see, weighted back to the
class frequencies of all labels, and scored in Arrow batches over every text.

Edge cases: null or empty text has no words (all counts 0, base_failed, not
kept); without labels of both classes the verdict is the prior alone (kept if
not base_failed); repeated rows are scored separately; an empty table gives an
empty result; only doc_id and text are read, other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import textops as T
from riskspark.llm.common import arrow_batches
from riskspark.llm.labelled import labelled_sample, platt, sigmoid

#: labelled rows per class used for the fit
SAMPLE = 2000
DIM = 1 << 17
#: entries of the sample that one step of the fit has in memory as products
PART = 1 << 20
#: fixed thresholds of the rules
KEEP, MIN_WORDS, MAX_REPEAT_PERCENT = 0.5, 50, 50
EPOCHS, RATE, L2 = 120, 0.5, 1e-6
SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _mark(n: int, at: np.ndarray, width: int) -> np.ndarray:
    """Positions covered by runs of ``width`` that begin at ``at``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + width, n), -1)
    return np.cumsum(edge[:n]) > 0


def repeated(h: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Which entries have an equal (text, hash) entry."""
    o = np.lexsort((h, t))
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = (h[o][1:] == h[o][:-1]) & (t[o][1:] == t[o][:-1])
    out = np.zeros(len(h), bool)
    out[o] = same[:-1] | same[1:]
    return out


def base_counts(data, offsets, h, t, s, e) -> dict[str, np.ndarray]:
    """The five counts of every text in a chunk; words are (hash, text, start, end)."""
    n = len(offsets) - 1

    def per_text(values):
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    g, gt, head = T.shingles(h, t, n, 3)
    rep = _mark(len(h), head[repeated(g, gt)], 3) if len(g) else np.zeros(0, bool)
    # lines with a word: spans between line feeds that hold a word start
    ls, le, lt = T.spans(data != 10, offsets)
    worded = np.searchsorted(s, le) > np.searchsorted(s, ls)
    lh, lt = T.hashes(data, ls[worded], le[worded]), lt[worded]
    uniq = np.bincount(T.distinct(lh, lt)[1], minlength=n)
    return {"n_words": np.bincount(t, minlength=n), "word_chars": per_text(~T.SPACE[data] & ((data & 0xC0) != 0x80)),
            "n_symbols": per_text(SYMBOLS[data]), "n_dup_lines": np.bincount(lt, minlength=n) - uniq,
            "n_repeat_words": np.bincount(t[rep], minlength=n)}


def ngrams(data, offsets, h, t):
    """The three n-gram groups of a chunk as (hashed index, text)."""
    top = np.uint64(64 - DIM.bit_length() + 1)
    uni = ((h * T.MIX1) >> top).astype(np.int64)
    pair = np.flatnonzero(t[1:] == t[:-1]) if len(t) > 1 else np.zeros(0, np.int64)
    a, b = h[pair], h[pair + 1] if len(pair) else h[:0]
    bi = np.where(a == b, np.uint64(7), T.mix(a * np.uint64(3) + b)) * T.MIX2
    bi = (bi >> top).astype(np.int64)
    if len(data) > 2:
        end = np.zeros(len(data) + 2, bool)
        end[np.maximum(offsets[1:] - 1, 0)] = True
        end[np.maximum(offsets[1:] - 2, 0)] = True
        at = np.flatnonzero(~end[:len(data) - 2])
        d = data.astype(np.uint32)
        code = (d[at] | (d[at + 1] << np.uint32(8)) | (d[at + 2] << np.uint32(16))) * np.uint32(0x9E3779B1)
        tri = (code >> np.uint32(32 - DIM.bit_length() + 1)).astype(np.int64)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[at]
    else:
        tri = owner = np.zeros(0, np.int64)
    return (uni, t), (bi, t[pair]), (tri, owner)


def _featurize(batches):
    """Sample rows to sparse n-gram shares: y, weight, key, index and value lists."""
    import pyarrow as pa

    for b in batches:
        y, weight, key = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("y", "weight", "key"))
        for i, j, data, offs in T.chunks(b.column(b.schema.get_field_index("text"))):
            n = j - i
            h, t, _, _ = T.words(data, offs, fold=False)
            rows, idx, val = [], [], []
            for g, (ix, tx) in enumerate(ngrams(data, offs, h, t)):
                total = np.maximum(np.bincount(tx, minlength=n), 1)
                code, count = np.unique(tx * (3 * DIM) + g * DIM + ix, return_counts=True)
                rows.append(code // (3 * DIM))
                idx.append(code % (3 * DIM))
                val.append(count / total[code // (3 * DIM)])
            r = np.concatenate(rows)
            o = np.argsort(r, kind="stable")
            cut = pa.array(np.searchsorted(r[o], np.arange(n + 1)), pa.int32())
            yield pa.record_batch([
                pa.array(y[i:j], pa.int32()), pa.array(weight[i:j]), pa.array(key[i:j]),
                pa.ListArray.from_arrays(cut, pa.array(np.concatenate(idx)[o], pa.int32())),
                pa.ListArray.from_arrays(cut, pa.array(np.concatenate(val)[o], pa.float32()))],
                names=["y", "weight", "key", "idx", "val"])


def _summed(to, at, val, x, n):
    """Sums of val * x[at] by ``to``, a part at a time, so the products never stand in memory whole."""
    out = np.zeros(n)
    for i in range(0, len(to), PART):
        out += np.bincount(to[i:i + PART], val[i:i + PART] * x[at[i:i + PART]], minlength=n)
    return out


def fit(sample: DataFrame) -> dict:
    """Fit and calibrate on a bounded sample: weights of 3 * DIM n-gram buckets, bias, Platt slope and offset."""
    t = sample.select("y", "weight", "key", "text").mapInArrow(
        _featurize, "y int, weight double, key long, idx array<int>, val array<float>").toArrow()
    o = np.argsort(t.column("key").to_numpy(), kind="stable")
    t = t.take(o)
    y, weight = t.column("y").to_numpy().astype(float), t.column("weight").to_numpy()
    model = {"w": np.zeros(3 * DIM, np.float32), "bias": 4.0, "a": 1.0, "b": 0.0}
    if len(y) == 0 or y.min() == y.max():
        return model
    lists = t.column("idx").combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    idx, val = lists.flatten().to_numpy(), t.column("val").combine_chunks().flatten().to_numpy()
    row = np.repeat(np.arange(len(y), dtype=np.int32), n)
    del t, lists
    held = np.arange(len(y)) % 4 == 3
    balance = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * ~held
    w, bias = np.zeros(3 * DIM), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for k in range(1, EPOCHS + 1):
        p = sigmoid(_summed(row, idx, val, w, len(y)) + bias)
        g = balance * (p - y)                   # 0 for held rows, so no copy of the others is needed
        gw, gb = _summed(idx, row, val, g, len(w)) + L2 * w, g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9 ** k, 1 - 0.99 ** k
        w -= RATE * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        bias -= 0.1 * RATE * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    raw = _summed(row, idx, val, w, len(y)) + bias
    a, b = platt(raw[held], y[held], weight[held])
    return {"w": w.astype(np.float32), "bias": float(bias), "a": a, "b": b}


def score_texts(model: dict, data, offsets, h, t) -> np.ndarray:
    n = len(offsets) - 1
    raw = np.full(n, model["bias"])
    for g, (ix, tx) in enumerate(ngrams(data, offsets, h, t)):
        total = np.maximum(np.bincount(tx, minlength=n), 1)
        raw += np.bincount(tx, model["w"][g * DIM + ix], minlength=n) / total
    return sigmoid(model["a"] * raw + model["b"])


def apply_rules(docs: DataFrame, model: dict, keep: float = KEEP) -> DataFrame:
    """doc_id, the five counts, base_failed, score, kept for every document, in one map over Arrow batches."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids = b.column(0)
            for i, j, data, offs in T.chunks(b.column(1)):
                h, t, s, e = T.words(data, offs, fold=False)
                c = base_counts(data, offs, h, t, s, e)
                failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
                score = score_texts(shared.value, data, offs, h, t)
                yield pa.record_batch(
                    [ids.slice(i, j - i)] + [pa.array(c[k], pa.int64()) for k in COUNTS]
                    + [pa.array(failed), pa.array(score), pa.array(~failed & (score >= keep))],
                    names=["doc_id", *COUNTS, "base_failed", "score", "kept"])

    schema = ("doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def keep_documents(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) that pass the rules, in one map over Arrow batches."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(fit(labelled_sample(docs, labels, "quality", per_class)))
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            good = []
            for _, _, data, offs in T.chunks(b.column(at)):
                h, t, s, e = T.words(data, offs, fold=False)
                c = base_counts(data, offs, h, t, s, e)
                failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
                good.append(~failed & (score_texts(shared.value, data, offs, h, t) >= keep))
            if good:
                yield b.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(run, docs.schema)


def quality_rules(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    arrow_batches(docs.sparkSession)
    return apply_rules(docs, fit(labelled_sample(docs, labels, "quality", per_class)))
