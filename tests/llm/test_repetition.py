"""Periodic runs against trying every period."""

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute as B  # noqa: E402
import numpy as np  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from riskspark.llm import repetition as R  # noqa: E402
from riskspark.llm.queries import QUERIES  # noqa: E402


def kernel(texts):
    word = np.array([hash(x) & 0xFFFFFFFFFFFF for w in texts for x in w], np.uint64)
    text = np.array([k for k, w in enumerate(texts) for _ in w], np.int64)
    begin = np.append(0, np.cumsum([len(w) for w in texts]))
    got = [[] for _ in texts]
    for s, e, q in R.find_runs(word, text).tolist():
        k = int(text[s])
        got[k].append((s - int(begin[k]), e - s, q))
    return got


def noisy(rng):
    """Repetitions of blocks of every size, nested, broken in places, over a small vocabulary."""
    w = []
    for _ in range(rng.randrange(1, 5)):
        block = [rng.choice("abcdefgh"[:rng.randrange(1, 9)]) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40]))]
        part = (block * rng.randrange(1, 12))[:rng.randrange(1, 300)]
        for _ in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = rng.choice("xyz")
        w += part
    return w


def test_runs_by_brute_force():
    rng = random.Random(11)
    for _ in range(120):
        texts = [noisy(rng) for _ in range(rng.randrange(1, 6))] + [[], ["a"] * 23, ["a"] * 24]
        assert kernel(texts) == [B.periodic_runs(w) for w in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=160))
def test_runs_of_two_words(w):
    assert kernel([w]) == [B.periodic_runs(w)]


def test_long_repetitions_stay_cheap():
    """100,000 equal words, and a period of a third of a long text."""
    rng = random.Random(3)
    block = [rng.choice(B.VOCAB) for _ in range(20011)]
    got = kernel([["a"] * 100_000, block * 3, (block + ["x"]) * 2])
    assert got == [[(0, 100_000, 1)], [(0, 60033, 20011)], []]


def test_collision_falls_back_to_the_words(monkeypatch):
    """With a prefix hash that calls everything equal the direct scan of the lag gives the same runs."""
    rng = random.Random(5)
    w = noisy(rng) + [rng.choice("abc") for _ in range(60)] + noisy(rng)
    want = [B.periodic_runs(w)]
    assert kernel([w]) == want
    monkeypatch.setattr(R._Prefix, "common", lambda self, x, y, most, backwards: most.copy())
    assert kernel([w]) == want


def test_documents(spark):
    rng = random.Random(9)
    rows = [(i, t) for i, (_, t, *_) in enumerate(B.corpus())] + [(None, "a b " * 20), (7, "a b " * 20), (7, None)]
    rows += [(1000 + i, "  ".join(noisy(rng))) for i in range(40)]
    d = spark.createDataFrame([(k, t, "x", 5) for k, t in rows], "doc_id long, text string, runs string, n_words int").repartition(3)
    got = sorted((tuple(r) for r in R.run_digest(R.collapse_runs(R.plant_runs(d))).collect()), key=str)
    want = sorted((B.run_digest(k, B.planted_words(k, t)) for k, t in rows), key=str)
    assert got == want
    assert any(r[1] > 1 for r in want)
    plain = R.collapse_runs(d)
    assert plain.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    assert R.run_digest(R.collapse_runs(d.limit(0))).count() == 0


def test_query_on_whole_table(spark):
    got = sorted(tuple(r) for r in QUERIES["op12_frequency_split"](spark, SF_SMALL).collect())
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert got == sorted(B.run_digest(r.doc_id, B.planted_words(r.doc_id, r.text)) for r in docs)
