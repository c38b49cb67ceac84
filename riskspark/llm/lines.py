"""Line dedup: documents probe a sharded minimal perfect hash instead of joining lines.

A line's key is the line stripped of ``[\x20\x09-\x0D]`` at both ends, A-Z lower-cased.
Keys of at least ``MIN_CHARS`` code points found in two or more documents lose
all their lines except in the smallest doc_id that holds them.

1. One Arrow pass turns texts into 128-bit line hashes, packed per (chunk of
   texts, shard): each distinct line of the chunk once with its smallest and
   largest doc_id and count, and the list of its documents.  Written once.
2. Per shard (a range of line hashes) the pre-aggregated keys give the lines that
   repeat (smallest doc_id differs from the largest).  A minimal perfect hash
   over them (levels of bit arrays, rank by prefix counts) indexes three compact
   arrays: fingerprint (the second 64 bits), count, smallest doc_id.  A line of a
   third of all documents arrives once per chunk, not once per document.
3. The chunks' lines probe the arrays of their shard; the probes of a shard are
   split over ``SALTS`` tasks by chunk, so a hot line's documents are spread.
   What comes back is (doc_id, line hash) for lines to drop only.
4. Documents drop those lines in a second Arrow pass.

Rows with one doc_id are one document.  Edge cases: null or empty text is one
empty line; a null doc_id is one document, after all others; a document may lose
all its lines (empty text); an empty table gives an empty result; other columns
are passed through untouched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import textops as T
from riskspark.llm.common import arrow_batches, materialize, shards

MIN_CHARS = 10
SALTS = 4
NO_ID = (1 << 63) - 1
GAMMA = 2.0
LEVELS = 24


def line_keys(data, offsets):
    """Lines of a chunk: (hash, second hash, text index, code points of the key, line start, line end)."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    per = 1 + np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1])
    text = np.repeat(np.arange(n), per)
    solid = np.flatnonzero(~T.SPACE[data]) if len(data) else np.zeros(0, np.int64)
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = b > a
    ks, ke = starts.copy(), starts.copy()
    ks[some], ke[some] = solid[a[some]], solid[b[some] - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    folded = T.FOLD[data]
    return T.hashes(folded, ks, ke), T.hashes(folded, ks, ke, 1), text, points[ke] - points[ks], starts, ends


def _level(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * int(T.BASE) & 0xFFFFFFFFFFFFFFFF)
    return (T.mix(keys + salt) % np.uint64(size)).astype(np.int64)


def build_index(keys: np.ndarray) -> dict:
    """Minimal perfect hash of distinct 64-bit keys: level sizes, their bits, and the few keys left over."""
    sizes, bits, left = [], [], keys
    for level in range(LEVELS):
        if not len(left):
            break
        size = int(max(64, GAMMA * len(left)))
        at = _level(left, level, size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone))
        left = left[~alone[at]]
    return {"sizes": np.array(sizes, np.int64), "bits": np.concatenate(bits) if bits else np.zeros(0, np.uint8), "rest": np.sort(left)}


def probe_index(index: dict, keys: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 if no level holds it; keys of the index get distinct slots 0..n-1."""
    slot = np.full(len(keys), -1, np.int64)
    open_, at, base = np.arange(len(keys)), 0, 0
    for level, size in enumerate(index["sizes"]):
        width = (int(size) + 7) // 8
        alone = np.unpackbits(index["bits"][at:at + width])[:size].astype(bool)
        at += width
        rank = np.cumsum(alone) - 1
        p = _level(keys[open_], level, int(size))
        hit = alone[p]
        slot[open_[hit]] = base + rank[p[hit]]
        open_ = open_[~hit]
        base += int(rank[-1]) + 1 if size else 0
    rest = index["rest"]
    if len(rest) and len(open_):
        p = np.minimum(np.searchsorted(rest, keys[open_]), len(rest) - 1)
        hit = rest[p] == keys[open_]
        slot[open_[hit]] = base + p[hit]
    return slot


def _pack(n_shards: int, min_chars: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for i, j, data, offs in T.chunks(b.column(1)):
                h, g, t, points, _, _ = line_keys(data, offs)
                ok = points >= min_chars
                h, g, doc = h[ok], g[ok], ids[i:j][t[ok]]
                if not len(h):
                    continue
                o = np.lexsort((doc, g, h))
                h, g, doc = h[o], g[o], doc[o]
                fresh = np.ones(len(h), bool)
                fresh[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
                h, g, doc = h[fresh], g[fresh], doc[fresh]
                head = np.ones(len(h), bool)
                head[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
                first = np.flatnonzero(head)
                count = np.diff(np.append(first, len(h)))
                line = np.zeros(len(first), ROW)
                line["h"], line["g"], line["lo"], line["hi"], line["n"] = h[first], g[first], doc[first], doc[first + count - 1], count
                shard = ((line["h"] >> np.uint64(32)) * np.uint64(n_shards) >> np.uint64(32)).astype(np.int64)
                cut = np.searchsorted(shard, np.arange(n_shards + 1))        # h is sorted, so shards are runs
                used = np.flatnonzero(np.diff(cut))
                at = np.append(first, len(h))
                yield pa.record_batch([
                    pa.array(used, pa.int32()), pa.array(np.full(len(used), int(ids[i] % 1000003)), pa.int32()),
                    pa.array([line[cut[s]:cut[s + 1]].tobytes() for s in used], pa.binary()),
                    pa.array([doc[at[cut[s]]:at[cut[s + 1]]].tobytes() for s in used], pa.binary())],
                    names=["shard", "chunk", "lines", "docs"])
    return run


#: one distinct line of a chunk: hashes, smallest and largest doc_id, documents
ROW = np.dtype([("h", "u8"), ("g", "u8"), ("lo", "i8"), ("hi", "i8"), ("n", "i4")])


def _index_shard(key, table):
    """Lines of the shard that repeat, as a minimal perfect hash with its arrays (one row)."""
    import pyarrow as pa

    rows = np.concatenate([np.frombuffer(x, ROW) for x in table.column("lines").to_pylist()])
    rows = rows[np.lexsort((rows["g"], rows["h"]))]
    first = np.flatnonzero(np.append(True, (rows["h"][1:] != rows["h"][:-1]) | (rows["g"][1:] != rows["g"][:-1])))
    lo, hi = np.minimum.reduceat(rows["lo"], first), np.maximum.reduceat(rows["hi"], first)
    n = np.add.reduceat(rows["n"].astype(np.int64), first)
    h, g = rows["h"][first], rows["g"][first]
    many = lo != hi
    h, g, lo, n = h[many], g[many], lo[many], n[many]
    # two different lines with one first hash keep the larger slot apart by the fingerprint of both
    once = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
    index = build_index(h[once])
    slot = probe_index(index, h[once])
    arrays = [np.zeros(len(slot), k) for k in ("u8", "u4", "i8")]
    for a, v in zip(arrays, (g[once], np.minimum(n[once], 0xFFFFFFFF), lo[once])):
        a[slot] = v
    twin = ~once
    extra = np.zeros(int(twin.sum()), ROW)
    extra["h"], extra["g"], extra["lo"] = h[twin], g[twin], lo[twin]
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "sizes": [index["sizes"].tobytes()], "bits": [index["bits"].tobytes()],
                     "rest": [index["rest"].tobytes()], "fingerprints": [arrays[0].tobytes()], "counts": [arrays[1].tobytes()],
                     "lowest": [arrays[2].tobytes()], "twins": [extra.tobytes()]})


INDEX = ("shard int, sizes binary, bits binary, rest binary, fingerprints binary, counts binary, lowest binary, twins binary")


def _probe_shard(key, left, right):
    """(doc_id, line hash) of the lines to drop among a shard's packed lines."""
    import pyarrow as pa

    out_d, out_h = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    if left.num_rows and right.num_rows:
        x = {c: right.column(c)[0].as_py() for c in right.column_names}
        index = {"sizes": np.frombuffer(x["sizes"], np.int64), "bits": np.frombuffer(x["bits"], np.uint8), "rest": np.frombuffer(x["rest"], np.uint64)}
        prints, lowest = np.frombuffer(x["fingerprints"], np.uint64), np.frombuffer(x["lowest"], np.int64)
        twins = np.frombuffer(x["twins"], ROW)
        for lines, docs in zip(left.column("lines").to_pylist(), left.column("docs").to_pylist()):
            line, doc = np.frombuffer(lines, ROW), np.frombuffer(docs, np.int64)
            slot = probe_index(index, line["h"])
            known = slot >= 0
            known[known] = prints[slot[known]] == line["g"][known]
            keep = np.zeros(len(line), np.int64)
            keep[known] = lowest[slot[known]]
            for tw in twins:                            # hash twins: practically none
                same = (line["h"] == tw["h"]) & (line["g"] == tw["g"])
                known |= same
                keep[same] = tw["lo"]
            drop = np.repeat(known, line["n"]) & (doc != np.repeat(keep, line["n"]))
            out_d.append(doc[drop])
            out_h.append(np.repeat(line["h"], line["n"])[drop])
    return pa.table({"doc": np.concatenate(out_d), "line": np.concatenate(out_h).view(np.int64)})


def line_index(docs: DataFrame, min_chars: int = MIN_CHARS):
    """(packed lines, sharded index) of a corpus, both written tables."""
    spark = docs.sparkSession
    arrow_batches(spark)
    n = shards(spark)
    packed = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pack(n, min_chars), "shard int, chunk int, lines binary, docs binary"), "lines-packed")
    index = materialize(packed.select("shard", "lines").groupBy("shard").applyInArrow(_index_shard, INDEX), "lines-index")
    return packed, index


def lines_to_drop(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, lines: hashes of the lines that a document loses."""
    packed, index = line_index(docs, min_chars)
    probes = packed.select("shard", F.pmod("chunk", F.lit(SALTS)).alias("salt"), "lines", "docs")
    salted = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = probes.groupBy("shard", "salt").cogroup(salted.groupBy("shard", "salt")).applyInArrow(_probe_shard, "doc long, line long")
    return found.groupBy("doc").agg(F.collect_set("line").alias("lines"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, counts: bool = True) -> DataFrame:
    """All columns of ``docs`` with ``text`` rewritten; with ``counts`` also ``n_lines`` (before) and ``n_dropped``,

    which then replace existing columns of these names.
    """
    drops = lines_to_drop(docs, min_chars).select(F.col("doc").alias("__doc"), F.col("lines").alias("__lines"))
    docs = docs.drop("n_lines", "n_dropped") if counts else docs
    extra = ["n_lines", "n_dropped"] if counts else []
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    joined = docs.withColumn("__key", key).join(drops, F.col("__key") == F.col("__doc"), "left").drop("__key", "__doc")
    names, at = docs.columns, docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            gone_all = b.column(len(names))
            for i, j, data, offs in T.chunks(b.column(at)):
                gone = gone_all.slice(i, j - i)
                sizes = np.array([len(x) if x.is_valid else 0 for x in gone], np.int64)
                h, _, t, points, s, e = line_keys(data, offs)
                drop = np.zeros(len(h), bool)
                if sizes.any():
                    which = np.repeat(np.arange(j - i), sizes).astype(np.uint64)
                    flat = gone.drop_null().flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    drop = (points >= min_chars) & np.isin(T.mix(h + t.astype(np.uint64) * T.BASE), T.mix(flat + which * T.BASE))
                lost = np.bincount(t[drop], minlength=j - i)
                text = []
                first = np.searchsorted(t, np.arange(j - i + 1))
                for k in range(j - i):
                    if lost[k]:
                        rows = np.arange(first[k], first[k + 1])
                        text.append(b"\n".join(data[s[r]:e[r]].tobytes() for r in rows[~drop[rows]]))
                    else:
                        text.append(data[offs[k]:offs[k + 1]].tobytes())
                columns = [b.column(c).slice(i, j - i) for c in range(len(names))]
                columns[at] = pa.array(text, pa.binary()).cast(pa.string())
                numbers = [pa.array(np.diff(first), pa.int64()), pa.array(lost, pa.int64())]
                yield pa.record_batch(columns + numbers[:len(extra)], names=[*names, *extra])

    schema = docs.select(*[f"`{c}`" for c in names]).schema
    for c in extra:
        schema = schema.add(c, "long")
    schema["text"].nullable = True
    return joined.mapInArrow(run, schema)
