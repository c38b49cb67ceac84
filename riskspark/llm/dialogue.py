"""Conversation structure repair: cheapest edits that give ``(s?(ua)+)?``, by rank-convergence parallel Viterbi.

Rows (conv_id, turn, role, text) are taken by turn, nulls first, rows of one turn by
a hash of role and text.  Edits of a row: Keep (0), Rerole to user / assistant (3),
Delete (4; the only edit of blank rows and repeats); a kept or reroled truncated row costs 3
more; an empty user / assistant row may be Inserted anywhere (3).  Over the four
states of the pattern - start, behind a system row, behind user, behind assistant - the
cost to go is a vector per row, and a row is a min-plus linear map of such vectors.

1. *Chunks.*  A conversation is cut into chunks of at most ``CHUNK`` rows, each in a bucket of its
   turns, so one long conversation (or all rows without a conv_id) is spread over tasks.
   Only the rows' classes (role initial, fault) enter the search, one letter a row.
2. *Speculation.*  Up to a constant only a few dozen cost vectors can occur
   (``SHAPES``, found by closing the last vector under all row classes).  Every chunk runs
   backwards from all of them at once; as a rule they differ by constants only after a few rows
   (the map's rank has converged to one) and the chunk no longer depends on what follows.
3. *Fix-up passes.*  A chunk behind which the vectors still differ takes its successor's
   vector when that is known and otherwise the successor's map, so the part of the
   conversation it looks over doubles with each pass; passes are rerun until every chunk's
   vector is fixed up to a constant.  Most tables need none, n chunks log2(n) at worst.
4. *Trace.*  With the stitched cost vector behind it, a chunk walks forward from
   every state, taking the ASCII-least edit that the vectors allow (D, I, K, R).  The maps from
   first to last state are stitched the same way, then each chunk's edits are fixed.

Edge cases: null role and text are one space; a null conv_id is one conversation; null turns come first; rows
of one (conv_id, turn) may be many; repeated rows are repeats (deleted); texts of any length
(only their faults are looked at); roles other than s / u / a initials can be reroled or
deleted; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from riskspark.llm.common import materialize

CHUNK = 128
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: states of the pattern, the state behind an inserted row, and the role that may stand next
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER_INSERT = (USER, USER, ASSISTANT, USER)
NEXT_ROLE = "uuau"
#: role initial (o: any other); upper case: truncated; x: blank or repeated
CLASSES = "suaoSUAOx"
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}


def _edits(cls: str, state: int):
    """Edits that use up a row of a class in a state: (letter, cost, next state)."""
    yield "D", DELETE, state
    if cls == "x":
        return
    more = TRUNCATED if cls.isupper() else 0
    role = cls.lower()
    if role == NEXT_ROLE[state]:
        yield "K", KEEP + more, AFTER_INSERT[state]
    elif role == "s" and state == START:
        yield "K", KEEP + more, SYSTEM
    yield "R", REROLE + more, AFTER_INSERT[state]


def _with_inserts(costs):
    costs = list(costs)
    for _ in range(2):
        for s in range(4):
            costs[s] = min(costs[s], INSERT + costs[AFTER_INSERT[s]])
    return tuple(costs)


def _before(cls: str, costs):
    """Cost vector before a row from the one behind it."""
    return _with_inserts([min(c + costs[t] for _, c, t in _edits(cls, s)) for s in range(4)])


def _shape(costs):
    low = min(costs)
    return tuple(c - low for c in costs)


LAST = _with_inserts([0, 1 << 20, 1 << 20, 0])


def _shapes():
    found, k = [_shape(LAST)], 0
    while k < len(found):
        for c in CLASSES:
            v = _shape(_before(c, found[k]))
            if v not in found:
                found.append(v)
        k += 1
    return found


#: all cost vectors that can stand anywhere in a conversation, less their minimum; the first is the last row's
SHAPES = _shapes()
#: shape before a row of a class, for every shape behind it
STEP = {c: np.array([SHAPES.index(_shape(_before(c, v))) for v in SHAPES]) for c in CLASSES}


def _walk(cls: str, behind, state: int):
    """(edits, roles, next state, cost) of the least-audit optimum from a state before a row."""
    ahead, edits, roles, cost = _before(cls, behind), "", "", 0
    while True:
        use = {e: (c, t) for e, c, t in _edits(cls, state)}
        if "D" in use and use["D"][0] + behind[state] == ahead[state]:
            return edits + "D", roles + "-", state, cost + DELETE
        if INSERT + ahead[AFTER_INSERT[state]] == ahead[state]:
            edits, roles, cost, state = edits + "I", roles + NEXT_ROLE[state], cost + INSERT, AFTER_INSERT[state]
            continue
        for e in "KR":
            if e in use and use[e][0] + behind[use[e][1]] == ahead[state]:
                return edits + e, roles + ("=" if e == "K" else NEXT_ROLE[state]), use[e][1], cost + use[e][0]
        raise AssertionError("a cost vector without an edit")


WALK = {(c, k, s): _walk(c, v, s) for c in CLASSES for k, v in enumerate(SHAPES) for s in range(4)}
#: inserts behind the last row
CLOSING = {START: ("", ""), SYSTEM: ("II", "ua"), USER: ("I", "a"), ASSISTANT: ("", "")}


def chunk_map(classes: str) -> list[int]:
    """Shape before a chunk for every shape behind it."""
    f = np.arange(len(SHAPES))
    for c in reversed(classes):
        f = STEP[c][f]
    return f.tolist()


def shapes_behind(classes: str, last: int) -> list[int]:
    """Shape behind each row of a chunk, from the one behind the chunk."""
    out = []
    for c in reversed(classes):
        out.append(last)
        last = int(STEP[c][last])
    return out[::-1]


def exits(classes: str, last: int) -> list[int]:
    """Last state of a chunk for every first state."""
    behind, out = shapes_behind(classes, last), [0, 1, 2, 3]
    for c, k in zip(classes, behind):
        out = [WALK[c, k, s][2] for s in out]
    return out


def trace(classes: str, last: int, state: int, closes: bool):
    """(edits per row, roles per row, cost) of a chunk; ``closes``: it ends the conversation."""
    edits, roles, cost = [], [], 0
    for c, k in zip(classes, shapes_behind(classes, last)):
        e, r, state, x = WALK[c, k, state]
        edits.append(e)
        roles.append(r)
        cost += x
    if closes:
        e, r = CLOSING[state]
        edits[-1] += e
        roles[-1] += r
        cost += INSERT * len(e)
    return edits, roles, cost


def mark_rows(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows with their place (p0, p1, pos, seq), fault and class; null role and text are one space."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    # a bucket holds ``chunk`` turns; rows without a turn are spread by their hash, which is their order too
    rows = rows.withColumn("tie", F.xxhash64("role", "text"))
    rows = rows.withColumn("p0", F.col("turn").isNotNull().cast("int"))
    rows = rows.withColumn("p1", F.when(F.col("turn").isNull(), F.shiftright("tie", 56)).otherwise(F.floor(F.col("turn") / chunk)).cast("long"))
    again = F.row_number().over(W.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))) > 1
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    rows = rows.withColumn("fault", F.when(blank, "blank").when(again, "duplicate").when(~whole, "truncated"))
    order = W.partitionBy("conv_id", "p0", "p1").orderBy("turn", "tie", "role", "text")
    rows = rows.withColumn("pos", F.row_number().over(order) - 1)
    rows = rows.withColumn("new_turn", F.coalesce(F.col("turn") != F.lag("turn").over(order), F.col("turn").isNotNull()).cast("int"))
    initial = F.substring("role", 1, 1)
    rows = rows.withColumn("initial", F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o")))
    cls = (F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial")))
    return rows.withColumn("cls", cls).withColumn("seq", F.floor(F.col("pos") / chunk).cast("int")).withColumn("pos", F.col("pos") % chunk)


KEY = ["conv_id", "p0", "p1", "seq"]


def _add_columns(df: DataFrame, names: list[str], kinds: list, inputs: list[str], fn) -> DataFrame:
    """``df`` with columns computed per row by ``fn(*inputs)`` in Arrow batches."""
    columns = df.columns

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = [fn(*x) for x in zip(*(b.column(columns.index(c)).to_pylist() for c in inputs))]
            new = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types())]
            yield pa.record_batch([*b.columns, *new], names=[*columns, *names])

    def types():
        import pyarrow as pa

        kind = {"ints": pa.list_(pa.int32()), "texts": pa.list_(pa.string()), "int": pa.int32(), "long": pa.int64()}
        return [kind[k] for k in kinds]

    spark_kind = {"ints": ArrayType(IntegerType()), "texts": ArrayType(StringType()), "int": IntegerType(), "long": LongType()}
    schema = StructType(list(df.schema.fields))
    for n, k in zip(names, kinds):
        schema = schema.add(n, spark_kind[k])
    return df.mapInArrow(run, schema)


def cut_chunks(rows: DataFrame) -> DataFrame:
    """A row per chunk: number in the conversation (no), classes, initials, counts, and the chunk's map ``f``."""
    listed = F.sort_array(F.collect_list(F.struct("pos", "cls", "initial")))
    count = lambda fault: F.sum((F.coalesce(F.col("fault") == fault, F.lit(False))).cast("long"))
    c = rows.groupBy(*KEY).agg(
        listed.alias("l"), *(count(f).alias(f) for f in ("blank", "duplicate", "truncated")),
        F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.sum("new_turn").alias("turns"))
    c = c.withColumn("classes", F.array_join(F.transform("l", lambda x: x["cls"]), ""))
    c = c.withColumn("initials", F.array_join(F.transform("l", lambda x: x["initial"]), "")).drop("l")
    order = W.partitionBy("conv_id").orderBy("p0", "p1", "seq")
    c = c.withColumn("no", F.row_number().over(order)).withColumn("closes", F.lead("no").over(order).isNull().cast("int"))
    c = c.withColumn("before", F.lag(F.substring("initials", -1, 1)).over(order))
    return _add_columns(c, ["f", "illegal"], ["ints", "long"], ["classes", "initials", "before"], lambda x, i, b: (
        chunk_map(x), sum((p + q) not in LEGAL for p, q in zip((b or "") + i, ((b or "") + i)[1:]))))


def stitch(chunks: DataFrame, f: str, into: str, first: int, backwards: bool) -> DataFrame:
    """Column ``into``: what enters each chunk's map ``f``, from the chunk before it (behind it, if ``backwards``).

    The conversation's first chunk in that direction takes ``first``.  Chunks whose neighbour's map is constant
    know their value at once; the others take the neighbour's value or, while that is open,
    its neighbour's map as well, so an open stretch halves its distance with every pass.
    """
    order = W.partitionBy("conv_id").orderBy(F.desc("no") if backwards else F.asc("no"))
    constant = lambda g: F.array_min(g) == F.array_max(g)
    value = F.when(F.col("g").isNull(), F.lit(first)).when(constant(F.col("g")), F.col("g")[0])
    t = chunks.withColumn("g", F.lag(f).over(order)).withColumn("to", F.lag("no").over(order)).withColumn(into, value)
    t = materialize(t, "dialogue-stitch")
    while not t.filter(F.col(into).isNull()).isEmpty():
        near = t.select(F.col("conv_id").alias("__c"), F.col("no").alias("__no"), F.col("g").alias("__g"), F.col("to").alias("__to"), F.col(into).alias("__v"))
        ahead = F.when(F.col(into).isNull(), F.col("to"))
        j = t.join(near, F.col("conv_id").eqNullSafe(F.col("__c")) & (ahead == F.col("__no")), "left")
        longer = F.transform("__g", lambda x: F.get("g", x))
        now = F.coalesce(F.col(into), F.get("g", F.col("__v")))
        open_ = now.isNull()
        j = j.withColumn("__new", now).withColumn("g", F.when(open_, longer).otherwise(F.col("g"))).withColumn("to", F.when(open_, F.col("__to")).otherwise(F.col("to")))
        j = j.withColumn(into, F.coalesce("__new", F.when(constant(F.col("g")), F.col("g")[0])))
        t = materialize(j.drop("__c", "__no", "__g", "__to", "__v", "__new"), "dialogue-stitch")
    return t.drop("g", "to")


def repair(conversations: DataFrame, chunk: int = CHUNK):
    """(rows, chunks) of the repaired conversations, both written tables.

    ``rows``: conv_id, turn, role, text, fault, no, pos, edits and ``entries`` (the rows that stand in its place:
    edit, role, text; inserted ones first), in the order of (no, pos).  ``chunks``: per conversation chunk its counts,
    cost and audit.
    """
    rows = materialize(mark_rows(conversations, chunk), "dialogue-rows")
    c = stitch(cut_chunks(rows), "f", "last", 0, backwards=True)
    c = _add_columns(c, ["e"], ["ints"], ["classes", "last"], lambda x, k: (exits(x, k),))
    c = stitch(c, "e", "state", START, backwards=False)
    c = _add_columns(c, ["edits", "roles", "cost"], ["texts", "texts", "long"], ["classes", "last", "state", "closes"],
                     lambda x, k, s, z: trace(x, k, s, bool(z)))
    c = materialize(c.withColumn("audit", F.array_join("edits", "")), "dialogue-chunks")
    t = c.select(*(F.col(k).alias(f"__{k}") for k in KEY), "no", "edits", "roles")
    same = F.lit(True)
    for k in KEY:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    j = rows.join(t, same)
    e, r = F.get("edits", "pos"), F.get("roles", "pos")
    j = j.withColumn("edits", e).withColumn("roles", r)
    return j.select("conv_id", "turn", "role", "text", "fault", "no", "pos", "edits", _entries().alias("entries")), c


def _entries() -> Column:
    letters = F.sequence(F.lit(1), F.length("edits"))

    def entry(i):
        edit, role = F.substring(F.col("edits"), i, F.lit(1)), F.substring(F.col("roles"), i, F.lit(1))
        named = F.when(role == "u", ROLES["u"]).when(role == "a", ROLES["a"]).otherwise(F.col("role"))
        return F.struct(edit.alias("edit"), named.alias("role"), F.when(edit == "I", "").otherwise(F.col("text")).alias("text"))

    return F.filter(F.transform(letters, entry), lambda x: x["edit"] != "D")


def conversation_hashes(rows: DataFrame) -> DataFrame:
    """conv_id, sha256 of the repaired ``role:text`` lines.

    A digest runs over a conversation in order, so its rows pass one task; they stream
    through it sorted and are never held together.
    """
    lines = F.transform("entries", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    d = rows.select("conv_id", "no", "pos", lines.alias("lines")).repartition("conv_id").sortWithinPartitions("conv_id", "no", "pos")
    kind = rows.schema["conv_id"].dataType

    def run(batches):
        import pyarrow as pa

        now, h, empty, any_row = None, hashlib.sha256(), True, False
        for b in batches:
            done = []
            for conv, lines in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
                if any_row and conv != now:
                    done.append((now, h.hexdigest()))
                    h, empty = hashlib.sha256(), True
                now, any_row = conv, True
                for x in lines:
                    h.update((x if empty else "\n" + x).encode())
                    empty = False
            if done:
                yield pa.record_batch([pa.array([x[0] for x in done], b.column(0).type), pa.array([x[1] for x in done])], names=["conv_id", "repaired_sha256"])
            column = b.column(0).type
        if any_row:
            yield pa.record_batch([pa.array([now], column), pa.array([h.hexdigest()])], names=["conv_id", "repaired_sha256"])

    return d.mapInArrow(run, StructType().add("conv_id", kind).add("repaired_sha256", StringType()))


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.encode(F.concat(one("conv_id"), F.lit(":"), one("turn")), "UTF-8")) % 20
    d = conversations.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), h.alias("h")).filter("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    d = d.withColumn("text", text).withColumn("role", F.when(F.col("h") == 4, "user").otherwise(F.col("role")))
    return d.withColumn("k", F.explode(F.sequence(F.lit(1), F.when(F.col("h") == 3, 2).otherwise(1)))).select("conv_id", "turn", "role", "text")


def repair_digest(conversations: DataFrame, rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """Contract columns for every conv_id of ``conversations``."""
    c = chunks.groupBy("conv_id").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("turns").alias("turns"),
        *(F.sum(x).cast("long").alias(x) for x in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("no", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    c = c.withColumn("gaps", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0)).cast("long"))
    every = conversations.select(F.col("conv_id").alias("__id")).distinct()
    h = conversation_hashes(rows).withColumnRenamed("conv_id", "__h")
    j = every.join(c, F.col("__id").eqNullSafe(F.col("conv_id")), "left").join(h, F.col("__id").eqNullSafe(F.col("__h")), "left")
    zero = lambda x: F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x)
    return j.select(F.col("__id").alias("conv_id"), *(zero(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                    F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
