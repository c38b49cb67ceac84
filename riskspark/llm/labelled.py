"""Bounded labelled samples for fitting the classifiers."""

from __future__ import annotations

import binascii

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_column(key, modulus: int):
    """crc32 of a key's text modulo ``modulus`` (null key: null)."""
    return F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(modulus))


def fold_of(key, modulus: int) -> int:
    """The same fold in Python, for tests."""
    return binascii.crc32(str(key).encode()) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, train=None) -> DataFrame:
    """Texts of at most ``per_class`` labelled documents of each class: y, text, weight.

    The rows with the smallest key hash of each class are taken (the same ones on
    every run).  ``weight`` restores the class frequencies of all training
    labels.  The sample's keys (2 x per_class numbers) are broadcast; the bound
    is the parameter.
    """
    lab = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    if train is not None:
        lab = lab.filter(train(F.col("doc_id")))
    size = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for y in (0, 1):
        weight = size.get(y, 0) / max(1, min(size.get(y, 0), per_class))
        part = (lab.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
                .select("doc_id", "y", F.lit(float(weight)).alias("weight")))
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select("doc_id", "text").filter("doc_id is not null")
    return texts.join(F.broadcast(picked), "doc_id").select("y", "weight", "text", F.xxhash64("doc_id").alias("key"))


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, float)))


def platt(logit: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float = 1.0):
    """Slope and offset that turn a raw score into a calibrated log-odds (Newton on the log loss)."""
    a, b = 1.0, 0.0
    if len(y) == 0 or y.min() == y.max():
        return a, b
    weight = weight / weight.mean()
    for _ in range(50):
        p = sigmoid(a * logit + b)
        g, w = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-9)
        ga, gb = (g * logit).sum() + prior * (a - 1), g.sum() + 1e-3 * b
        haa, hab, hbb = (w * logit * logit).sum() + prior, (w * logit).sum(), w.sum() + 1e-3
        det = haa * hbb - hab * hab
        da, db = (ga * hbb - gb * hab) / det, (gb * haa - ga * hab) / det
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -2, 2)
        if abs(da) + abs(db) < 1e-8:
            break
    return float(a), float(b)
