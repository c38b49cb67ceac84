"""Conversation repair against the plain recursion over every edit."""

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute as B  # noqa: E402
import pytest  # noqa: E402
from conftest import SF_CHECK  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskspark.llm import dialogue as D  # noqa: E402
from riskspark.llm.queries import QUERIES  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string"


def test_trace_of_random_classes():
    """Any sequence of row classes, in one chunk or in several, gives the cheapest and least audit."""
    rng = random.Random(4)
    name = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for _ in range(600):
        classes = "".join(rng.choice(D.CLASSES[:rng.choice([3, 4, 9])]) for _ in range(rng.randrange(1, 12)))
        rows = [(name.get(c.lower(), "user"), f"t{i}", "blank" if c == "x" else "truncated" if c.isupper() else None) for i, c in enumerate(classes)]
        cost, audit, _ = B.cheapest_audit(rows)
        cut = rng.randrange(1, len(classes) + 1)
        a, b = classes[:cut], classes[cut:]
        edits, roles, total = [], [], 0
        behind = D.chunk_map(b)[0] if b else 0
        state = D.exits(a, behind)[0]
        for part, last, s, closes in ((a, behind, 0, not b), (b, 0, state, True)):
            if part:
                e, _, c = D.trace(part, last, s, closes)
                edits += e
                total += c
        assert (total, "".join(edits)) == (cost, audit)


def conversations(rng, n, roles, length=9):
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(rng.randrange(0, length)):
            text = rng.choice(["Yes.", "No!", "Why?", "cut off", "", " \t", None, "Well. \n", "é.", "x" * rng.randrange(1, 5) + "."])
            rows.append((conv, turn, rng.choice(roles), text))
            turn += rng.choice([0, 1, 1, 1, 3]) if length < 100 else 1
    return rows


def tie(spark, rows):
    """The documented order of rows of one turn."""
    pairs = sorted({(r[2], r[3]) for r in rows})
    if not pairs:
        return lambda r: 0
    t = {(r.role, r.text): r.h for r in spark.createDataFrame(pairs, "role string, text string").withColumn("h", F.xxhash64("role", "text")).collect()}
    return lambda r: (t[r[2], r[3]], r[2], r[3])


@pytest.mark.parametrize("chunk, roles, length", [
    (D.CHUNK, ["user", "assistant", "system", "tool", "", None, "u", "Admin"], 9),
    (2, ["user", "assistant", "system", "tool"], 14),
    (3, ["tool"], 60),                                   # never converges: fix-up passes look over doubling stretches
    (4, ["user", "assistant"], 120)])
def test_repair(spark, chunk, roles, length):
    rng = random.Random(chunk)
    rows = conversations(rng, 40 if length < 50 else 8, roles, length)
    if chunk == D.CHUNK:
        rows += [(None, t, r, x) for t, r, x in ((None, "user", "a."), (None, "assistant", "b."), (3, None, None), (1, "user", "a."), (9, "user", "z"))]
        rows += [(77, None, "user", f"{i}.") for i in range(300)] + [(78, None, None, None)] * 3
        rows += [(79, -1000 + 300 * i, "user", "far.") for i in range(4)]
    d = spark.createDataFrame([(*r, "extra", 1) for r in rows], SCHEMA + ", fault string, no int").repartition(3)
    full = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out, chunks = D.repair(d, chunk)
    got = sorted((tuple(r) for r in D.repair_digest(d, out, chunks).collect()), key=str)
    assert got == sorted(B.repair_digest(rows, full, tie(spark, full)), key=str)
    assert out.count() == len(rows)
    empty = d.limit(0)
    assert D.repair_digest(empty, *D.repair(empty)).count() == 0


def test_query_on_whole_table(spark):
    got = sorted(tuple(r) for r in QUERIES["op11_rank_viterbi"](spark, SF_CHECK).collect())
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = B.damaged(rows)
    assert got == sorted(B.repair_digest(rows, after, tie(spark, after)))


def test_damage(spark):
    rows = [(c, t, r, x) for c in [None, *range(30)] for t, r, x in ((0, "user", "Hi! a.b?"), (1, "assistant", "b."), (None, None, None))]
    got = D.damage(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, B.damaged(rows)))
