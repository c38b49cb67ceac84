"""Periodic run detection: stretches of words that repeat themselves, found by recursive frequency splitting.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0 in each text.  A run is a stretch
with smallest period q (words q apart are identical) of at least
``max(SHORTEST, 3 q)`` words that no neighbouring word extends keeping period q.

1. *Recursive frequency splitting.*  A run holds each of its words three times or
   more.  A word with fewer occurrences inside the current segment can be in no
   run of that segment, so it splits the segment; pieces below ``SHORTEST`` words
   go, changed pieces are tested again until nothing changes.  The test needs no
   counting: with the positions of the two previous and two next occurrences of
   each word, "three times inside [s, e)" is one comparison, so a round is one
   pass over the segments that changed in the round before.
2. *Lag scan* of the surviving segments.  Lags below 8 compare the segment with
   itself directly.  Lags of the octave [b, 2b) are scanned from anchors b words
   apart: a run of such a period holds the block at one of its anchors once more
   q words on, so comparing every anchor's block with the b lags behind it is
   one pass over the segment per octave.  A hit is extended both ways by binary
   search over prefix hashes.  Of the stretches with equal bounds the smallest
   period stays.  Every run is compared word for word before it counts; a lag whose
   hit fails that (a hash collision) is scanned directly.

The work of the lag scan is O(n log n) for a text of n words whatever it holds; the splitting
costs one pass per round (a handful on prose).  Memory follows one chunk of
texts (1 MB, or one longer text).  Texts never meet, so there is no shuffle and no
hot key; texts are whole, never cut.

Edge cases: null or empty text has no words, no runs and an empty collapsed text;
a text that is one run keeps its first period; runs may overlap (a word is dropped
if any run holds it behind that run's first q words); repeated rows and repeated or
null doc_ids are handled row by row; an empty table gives an empty result; other
columns are passed through, columns called ``n_words``, ``runs`` or ``collapsed`` are
replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from riskspark.llm import textops as T
from riskspark.llm.common import arrow_batches, ws_words

SHORTEST = 24
#: lags below this one are scanned directly
OCTAVE = 8
RUNS = ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))


def _neighbours(word: np.ndarray, text: np.ndarray):
    """Word numbers per text, and the positions of the two previous and two next equal words of the text."""
    n = len(word)
    key = T.mix(word + text.astype(np.uint64) * T.BASE)
    order = np.argsort(key, kind="stable")
    k = key[order]
    group = np.zeros(n, np.int64)
    group[1:] = np.cumsum(k[1:] != k[:-1])
    ids = np.empty(n, np.int64)
    ids[order] = group
    near = []
    for step in (2, 1):
        before, after = np.full(n, -1, np.int64), np.full(n, 1 << 62, np.int64)
        if n > step:
            same = group[step:] == group[:-step]
            before[order[step:][same]] = order[:-step][same]
            after[order[:-step][same]] = order[step:][same]
        near += [before, after]
    return ids, near


def split_by_frequency(near, starts: np.ndarray, ends: np.ndarray, shortest: int = SHORTEST):
    """Segments [start, end) in which every word occurs three times or more, none below ``shortest``."""
    prev2, next2, prev1, next1 = near
    keep_s, keep_e = [], []
    long = ends - starts >= shortest
    s, e = starts[long], ends[long]
    while len(s):
        size = e - s
        offs = np.append(0, np.cumsum(size))
        owner = np.repeat(np.arange(len(s)), size)
        at = np.arange(offs[-1]) - offs[owner] + s[owner]
        lo, hi = s[owner], e[owner]
        often = (prev2[at] >= lo) | (next2[at] < hi) | ((prev1[at] >= lo) & (next1[at] < hi))
        a, b, seg = T.spans(often, offs)
        a, b = a - offs[seg] + s[seg], b - offs[seg] + s[seg]
        whole = (a == s[seg]) & (b == e[seg])
        keep_s.append(a[whole])
        keep_e.append(b[whole])
        again = ~whole & (b - a >= shortest)
        s, e = a[again], b[again]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *keep_s]), np.concatenate([none, *keep_e])


def _equal_stretches(seq: np.ndarray, lag: int, least: int):
    """Maximal [start, end) with ``seq[i] == seq[i + lag]`` inside, of ``least`` words or more with the lag."""
    if len(seq) <= lag:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, _ = T.spans(seq[:-lag] == seq[lag:], np.array([0, len(seq) - lag]))
    long = b + lag - a >= least
    return a[long], b[long] + lag


class _Prefix:
    """Polynomial prefix hashes of a sequence: equality of two blocks in a few operations."""

    def __init__(self, seq: np.ndarray):
        n = len(seq)
        self.n = n
        up, self.down, _ = T._powers(n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(T.mix(seq.astype(np.uint64)) * up[:n], out=self.total[1:])

    def block(self, at, size):
        return (self.total[at + size] - self.total[at]) * self.down[at]

    def blocks(self, size: int, upto: int):
        return (self.total[size:upto + 1] - self.total[:upto + 1 - size]) * self.down[:upto + 1 - size]

    def common(self, x, y, most, backwards: bool):
        """Length of the longest equal extension behind (or before) positions x and y, ``most`` at most."""
        size = np.zeros(len(x), np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            more = size + step
            fits = np.flatnonzero(more <= most)
            if backwards:
                same = self.block(x[fits] - more[fits], more[fits]) == self.block(y[fits] - more[fits], more[fits])
            else:
                same = self.block(x[fits], more[fits]) == self.block(y[fits], more[fits])
            size[fits[same]] = more[fits[same]]
            step >>= 1
        return size


def scan_lags(seq: np.ndarray, longest: np.ndarray, shortest: int = SHORTEST):
    """Runs (start, end, period) of a sequence of segments, longest first, parted by values that occur once.

    ``longest``: (length, end in the sequence) of the segments.
    """
    found = []

    def note(a, b, q):
        if len(a):
            found.append(np.stack([a, b, np.broadcast_to(q, len(a))], 1))

    for q in range(1, OCTAVE):
        note(*_equal_stretches(seq, q, max(shortest, 3 * q)), q)
    prefix, b = None, OCTAVE
    while len(longest) and longest[0, 0] >= 3 * b:
        upto = int(longest[longest[:, 0] >= 3 * b][-1, 1])
        prefix = prefix or _Prefix(seq[:upto])
        h = prefix.blocks(b, upto)
        anchors = (len(h) - 1) // b
        if anchors > 0:
            ahead = np.zeros(anchors * b, np.uint64)
            ahead[:len(h) - b] = h[b:b + anchors * b]
            hit = ahead.reshape(anchors, b) == h[:anchors * b:b][:, None]
            fresh = hit.copy()
            fresh[1:] &= ~hit[:-1]                     # the block before agrees at this lag: the same stretch
            j, r = np.nonzero(fresh)
            for k in range(0, len(j), 1 << 18):
                p, q = j[k:k + (1 << 18)] * b, r[k:k + (1 << 18)] + b
                ok = p + q + b <= upto
                p, q = p[ok], q[ok]
                left = prefix.common(p, p + q, p, True)
                right = prefix.common(p + b, p + q + b, upto - (p + q + b), False)
                s, e = p - left, p + q + b + right
                long = e - s >= np.maximum(shortest, 3 * q)
                note(s[long], e[long], q[long])
        b *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    out, done, scanned, k = [], None, set(), 0
    queue = [tuple(x) for x in rows.tolist()]
    while k < len(queue):
        s, e, q = queue[k]
        k += 1
        if done == (s, e):
            continue
        if np.array_equal(seq[s:e - q], seq[s + q:e]):
            out.append((s, e, q))
            done = (s, e)
        elif q not in scanned:                         # a hash collision: this lag is scanned word by word
            scanned.add(q)
            a, b = _equal_stretches(seq, q, max(shortest, 3 * q))
            queue, k, out, done = sorted({*queue, *((int(x), int(y), q) for x, y in zip(a, b))} - {(s, e, q)}), 0, [], None
    return np.array(out, np.int64).reshape(-1, 3)


def find_runs(word: np.ndarray, text: np.ndarray, shortest: int = SHORTEST):
    """Runs of the texts of a chunk: array of (first word, end, period) in positions of the chunk.

    ``word``: a 64-bit number per word, ``text``: its text, ascending.
    """
    if len(word) < shortest:
        return np.zeros((0, 3), np.int64)
    ids, near = _neighbours(word, text)
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    s, e = split_by_frequency(near, first, np.append(first[1:], len(word)), shortest)
    if not len(s):
        return np.zeros((0, 3), np.int64)
    o = np.argsort(s - e, kind="stable")               # longest first
    s, e = s[o], e[o]
    size = e - s
    base = np.append(0, np.cumsum(size + 1))
    seq = np.empty(base[-1], np.int64)
    seq[base[1:] - 1] = -1 - np.arange(len(s))         # the values between segments occur once
    owner = np.repeat(np.arange(len(s)), size)
    at = np.arange(size.sum()) - (np.cumsum(size) - size)[owner]
    seq[base[owner] + at] = ids[s[owner] + at]
    runs = scan_lags(seq, np.stack([size, base[1:] - 1], 1), shortest)
    seg = np.searchsorted(base, runs[:, 0], "right") - 1
    runs[:, :2] += (s[seg] - base[seg])[:, None]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def join_words(data: np.ndarray, offsets: np.ndarray, text, starts, ends):
    """Given words of each text joined by one space, as (bytes, offsets); the words stand in order."""
    last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
    change = np.zeros(len(data) + 2, np.int8)
    change[starts] += 1                                # words never touch, so starts and ends are distinct places
    stop = np.where(last, ends, ends + 1)
    change[stop] -= 1
    mask = np.cumsum(change[:len(data)], dtype=np.int8) > 0
    out = data.copy()
    out[ends[~last]] = 0x20
    at = np.append(0, np.cumsum(mask))
    return out[mask], at[offsets]


def collapse_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``runs`` (start, length, period by start, then period) and ``collapsed``,

    the kept words joined by one space: a word goes if any run holds it behind that run's first period.
    """
    arrow_batches(docs.sparkSession)
    extra = ["n_words", "runs", "collapsed"]
    docs = docs.drop(*extra)
    names, at = docs.columns, docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for i, j, data, offs in T.chunks(b.column(at)):
                n = j - i
                h, t, s, e = T.words(data, offs, fold=False)
                count = np.bincount(t, minlength=n)
                begin = np.cumsum(count) - count
                runs = find_runs(h, t, shortest)
                of = t[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
                kept = np.ones(len(h), bool)
                for a, z, q in runs.tolist():
                    kept[a + q:z] = False
                text, new = join_words(data, offs, t[kept], s[kept], e[kept])
                cut = np.searchsorted(of, np.arange(n + 1))
                spans = pa.StructArray.from_arrays(
                    [pa.array(runs[:, 0] - begin[of]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                    names=["start", "length", "period"])
                yield pa.record_batch(
                    [*(b.column(c).slice(i, n) for c in range(len(names))), pa.array(count, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), spans),
                     pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(new.astype(np.int32)), pa.py_buffer(text)])],
                    names=[*names, *extra])

    schema = StructType(list(docs.schema.fields)).add("n_words", "long").add("runs", RUNS).add("collapsed", "string")
    return docs.mapInArrow(run, schema)


def plant_runs(docs: DataFrame) -> DataFrame:
    """The contract's planted repetition: in a tenth of the documents the words from a on repeat with period p."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    g = F.floor(h / 10).cast("long")
    planted = F.coalesce(h % 10 == 0, F.lit(False))
    n = F.size("__w").cast("long")
    d = docs.withColumn("__w", F.when(planted, ws_words(F.col("text")))).withColumn("__g", g)
    d = d.withColumn("__a", F.when(n > 0, (F.col("__g") % n).cast("int")))
    d = d.withColumn("__p", (F.lit(1) + F.floor((n - F.col("__a")) / (F.lit(3) + F.col("__g") % 8))).cast("int"))
    word = F.transform("__w", lambda w, i: F.when(i < F.col("__a"), w).otherwise(
        F.get("__w", F.col("__a") + (i - F.col("__a")) % F.col("__p"))))
    return d.withColumn("text", F.when(n > 0, F.array_join(word, " ")).otherwise(F.col("text"))).drop("__w", "__g", "__a", "__p")


def run_digest(found: DataFrame) -> DataFrame:
    """Contract columns: number of runs, the run of greatest exponent, hashes of the runs and the kept words."""
    none = F.lit(None).cast(RUNS.elementType)
    best = F.aggregate("runs", none, lambda top, r: F.when(
        top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), _milli(F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _milli(length: Column, period: Column) -> Column:
    """floor(1000 * length / period), in whole numbers."""
    whole = length * 1000
    return ((whole - whole % period) / period).cast("long")
