"""Pair, line and passage operators against brute force over an awkward fixture."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute as B  # noqa: E402
import numpy as np  # noqa: E402
import pytest  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskspark.llm import decontam, lines, ngram_join, passages  # noqa: E402


@pytest.fixture(scope="module")
def rows():
    return B.corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, B.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], B.SCHEMA)


def tuples(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_jaccard_classes(docs, rows):
    assert tuples(ngram_join.jaccard_classes(docs), "doc_id", "n_shingles", "component_id") == B.jaccard_components(rows)


def test_jaccard_chain_without_a_hub(spark):
    """A chain a-b-c-d whose ends do not link is one component; a look-alike under the threshold is not."""
    w = [f"w{i}" for i in range(400)]
    chain = [w[k * 12:k * 12 + 110] for k in range(8)]
    far = w[300:340] + chain[0][:70]
    data = [(10 - i, " ".join(x), None, None, 0, None, None, None, None) for i, x in enumerate([*chain, far])]
    got = tuples(ngram_join.jaccard_classes(spark.createDataFrame(data, B.SCHEMA)), "doc_id", "n_shingles", "component_id")
    assert got == B.jaccard_components(data)
    assert len({c for _, _, c in got}) == 2


def test_one_per_class(docs, rows):
    kept = ngram_join.one_per_class(docs)
    assert kept.columns == docs.columns
    comps = B.jaccard_components(rows)
    want = sorted({c for _, n, c in comps if n} | {d for d, n, _ in comps if not n})
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_null_ids_stay_rows(spark):
    data = [(None, "a b c d e f", None, None, 0, None, None, None, None), (None, "", None, None, 0, None, None, None, None),
            (4, "A B C D E F", None, None, 0, None, None, None, None)]
    d = spark.createDataFrame(data, B.SCHEMA)
    got = sorted(map(str, (tuple(r) for r in ngram_join.jaccard_classes(d).collect())))
    assert got == ["(4, 2, 4)", "(None, 0, None)", "(None, 2, 4)"]
    assert lines.dedup_lines(d).count() == 3


def test_line_dedup(docs, rows):
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in lines.dedup_lines(docs).collect())
    assert got == B.dedup_lines(rows)
    assert lines.dedup_lines(docs, counts=False).columns == docs.columns


def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 20000).astype(np.uint64))
    index = lines.build_index(keys)
    assert sorted(lines.probe_index(index, keys).tolist()) == list(range(len(keys)))
    assert len(lines.probe_index(lines.build_index(keys[:0]), keys[:3])) == 3


def test_contamination(spark, docs, rows):
    hit = rows[60][1].split()
    items = [(1, " ".join(rows[0][1].split()[5:30])), (2, None), (3, "..."), (4, "two words"), (5, "ONE"), (6, "nowhere to be found " * 4),
             (7, " ".join(hit[:10])), (None, "a b c d"), (11, "x x x x x x x x x x x"), (1, "two words")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    for block in (100000, 3):
        got = tuples(decontam.contamination_digest(decontam.contamination(docs, table, block=block)),
                     "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
        assert got == B.contamination(rows, items)
    clean = decontam.clean_documents(docs, table)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [r[0] for r in B.contamination(rows, items) if not r[5]]
    none = decontam.contamination(docs, table.limit(0))
    assert none.filter("contaminated").count() == 0 and none.count() == len(rows)


def test_passages(docs, rows):
    got = passages.repeated_passages(docs).collect()
    text = {r[0]: B.words(r[1]) for r in rows}
    a, b = rows[-3][0], rows[-2][0]                          # the two documents that share a passage of 70 words
    mine = {r.doc_id: r for r in got if r.doc_id in (a, b)}
    assert set(mine) == {a, b} and len({r.rep_id for r in mine.values()}) == 1
    for r in mine.values():
        assert text[r.doc_id][r.start:r.end] == text[r.rep_id][r.rep_start:r.rep_end] and r.end - r.start == 70
    listed = {r.doc_id for r in got}
    copies = {r[0] for r in rows[:52]}
    assert copies <= listed
    long_unique = [r[0] for r in rows if len(B.words(r[1])) > 5000]
    assert not listed & set(long_unique)
    assert all(r.similarity >= 0.75 and r.end - r.start >= 50 for r in got)


def test_compact_windows_by_brute_force():
    rng = np.random.default_rng(3)
    value = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    first = np.array([0, 120, 120, 130, 300])
    got = set(zip(*(x.tolist() for x in passages.compact_windows(value, first, 20))))
    want = set()
    for t in range(4):
        v = value[first[t]:first[t + 1]].tolist()
        for c, x in enumerate(v):
            lo = hi = c
            while lo > 0 and v[lo - 1] > x:
                lo -= 1
            while hi + 1 < len(v) and v[hi + 1] > x:
                hi += 1
            if hi - lo + 1 >= 20:
                want.add((t, lo, c, hi))
    assert got == want


def test_empty_tables(empty, spark):
    items = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    for df in (ngram_join.jaccard_classes(empty), ngram_join.one_per_class(empty), lines.dedup_lines(empty),
               passages.repeated_passages(empty), decontam.contamination(empty, items)):
        assert df.count() == 0
