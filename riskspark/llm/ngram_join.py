"""N-gram Jaccard join: a blocked sparse product of the document by shingle incidence matrix.

A document's set is its distinct five-word shingles (fewer words: the whole
sequence).  Documents with one and the same set are one row of the matrix, so
exact copies cost one row.  Two rows link when 100 * overlap >= 75 * union.

1. One Arrow pass cuts the matrix into (chunk of rows) x (column block) pieces,
   packed as binary: a column is 32 bits inside its block, the block follows
   from the upper bits of the shingle's hash.  The shuffle carries about 5 bytes
   per entry and one row per piece.
2. Per column block, columns with one row are dropped (they add to no overlap);
   of the others every entry comes out with the number of rows of its column.
3. A row's size-derived bound says how many entries it may miss in a linked
   partner.  Rows with fewer shared entries than ceil(0.75 n) are out.  Of the
   rest, only the necessary prefix in order of rising column size is multiplied:
   two linked rows share a prefix column.
4. The product runs over prefix columns.  A pair is discarded when the entries
   that still follow in the shorter row cannot reach 3/7 of both sizes; the
   others get their exact overlap from the rows' entries.
5. No group is expanded into all its pairs.  First each column pairs its rows
   with its most central row (fewest rarer entries) only; connected components
   follow; then, per column, only rows of different components are paired, so
   every remaining link that could join two components is checked.

So the result is the components, not the list or number of all links: links inside
a component are skipped, and overlaps are intersected per candidate pair rather
than summed over a whole product.  It is exact up to hash collisions: 64 bits for
a document's set, 32 bits and log2(blocks) for a shingle.  Edge cases: null, empty or
wordless text is an empty set, linked with nothing; null doc_id rows are
returned, and a component without any id has a null component_id; repeated rows
are returned as often; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskspark.llm import textops as T
from riskspark.llm.common import arrow_batches, materialize, shards
from riskspark.llm.graph import components

WORDS = 5
#: a pair links when 7 * overlap >= 3 * (size + size), that is overlap / union >= 3 / 4
#: stands for a null doc_id
NO_ID = (1 << 63) - 1


def _sets(data, offsets):
    """Distinct shingles of a chunk sorted by (text, hash): (hash, text, set sizes, set signatures)."""
    n = len(offsets) - 1
    h, t, _, _ = T.words(data, offsets)
    g, gt, _ = T.shingles(h, t, n, WORDS)
    g, gt = T.distinct(g, gt)
    size = np.bincount(gt, minlength=n)
    total = np.concatenate([[np.uint64(0)], np.cumsum(T.mix(g + np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    end = np.cumsum(size)
    return g, gt, size, T.mix(total[end] - total[end - size] + size.astype(np.uint64) * T.MIX1)


def _signatures(batches):
    import pyarrow as pa

    for b in batches:
        for i, j, data, offs in T.chunks(b.column(1)):
            _, _, size, sig = _sets(data, offs)
            yield pa.record_batch([b.column(0).slice(i, j - i), pa.array(size, pa.int64()), pa.array(sig.view(np.int64))],
                                  names=["doc_id", "n", "node"])


def _pieces(n_blocks: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for _, _, data, offs in T.chunks(b.column(0)):
                g, t, size, sig = _sets(data, offs)
                first = np.zeros(len(size), bool)
                first[np.unique(sig, return_index=True)[1]] = True           # one row per set in this chunk
                keep = first[t]
                g, t = g[keep], t[keep]
                if not len(g):
                    continue
                block = ((g >> np.uint64(32)) * np.uint64(n_blocks) >> np.uint64(32)).astype(np.int64)
                o = np.argsort(block.astype(np.uint16) if n_blocks < 65536 else block, kind="stable")
                block, key, t = block[o], (g[o] & np.uint64(0xFFFFFFFF)).astype(np.uint32), t[o]
                cut = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (t[1:] != t[:-1])))
                count, row, of = np.diff(np.append(cut, len(t))).astype(np.uint32), sig[t[cut]], block[cut]
                edge, at = np.searchsorted(of, np.arange(n_blocks + 1)), np.append(cut, len(t))
                used = np.flatnonzero(np.diff(edge))
                yield pa.record_batch([
                    pa.array(used, pa.int32()),
                    pa.array([row[edge[x]:edge[x + 1]].tobytes() for x in used], pa.binary()),
                    pa.array([count[edge[x]:edge[x + 1]].tobytes() for x in used], pa.binary()),
                    pa.array([key[at[edge[x]]:at[edge[x + 1]]].tobytes() for x in used], pa.binary())],
                    names=["block", "nodes", "counts", "keys"])
    return run


def _shared_entries(key, table):
    """Entries of a column block whose column has two or more rows: (node, column, rows of the column)."""
    import pyarrow as pa

    def column(name, kind):
        return np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])

    node, count, col = column("nodes", np.int64), column("counts", np.uint32).astype(np.int64), column("keys", np.uint32)
    first = np.zeros(len(node), bool)
    first[np.unique(node, return_index=True)[1]] = True
    row = np.repeat(np.arange(len(node), dtype=np.int32), count)
    keep = first[row]
    row, col = row[keep], col[keep]
    o = np.argsort(col, kind="stable")
    row, col = row[o], col[o]
    start = np.flatnonzero(np.append(True, col[1:] != col[:-1])) if len(col) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(col)))
    df = np.repeat(size, size)
    many = df > 1
    base = np.int64(key[0].as_py()) << np.int64(32)
    return pa.table({"node": node[row[many]], "col": base | col[many].astype(np.int64), "df": pa.array(df[many], pa.int32())})


def incidence(docs: DataFrame):
    """(doc rows with set size and node, shared entries of the matrix), the first a written table."""
    spark = docs.sparkSession
    arrow_batches(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = materialize(d.mapInArrow(_signatures, "doc_id long, n long, node long"), "jaccard-rows")
    entries = (d.select("text").mapInArrow(_pieces(shards(spark)), "block int, nodes binary, counts binary, keys binary")
               .groupBy("block").applyInArrow(_shared_entries, "node long, col long, df int"))
    return rows, entries


def prefix_rows(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """node, n, cols (shared columns, rarest first), take (length of the necessary prefix among them)."""
    sizes = rows.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"))
    packed = entries.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "col"))).alias("e"))
    least = F.ceil(F.col("n") * 3 / 4)
    return (packed.join(sizes, "node").filter(F.size("e") >= least)
            .select("node", "n", F.transform("e", lambda x: x["col"]).alias("cols"),
                    (F.size("e") - least + 1).cast("int").alias("take")))


def _may_link(na, ia, nb, ib):
    """Size-derived bound at a shared column: what follows it must still reach 3/7 of both sizes."""
    return 7 * (1 + F.least(na - ia - 1, nb - ib - 1)) >= 3 * (na + nb)


def verify(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs (a, b) whose exact overlap links them."""
    left = rows.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("cols").alias("ca"))
    right = rows.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("cols").alias("cb"))
    overlap = F.size(F.array_intersect("ca", "cb"))
    return (pairs.join(left, "a").join(right, "b")
            .filter(7 * overlap >= 3 * (F.col("na") + F.col("nb"))).select("a", "b"))


def jaccard_links(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Links (a, b) between nodes that connect every pair of linked nodes."""
    matrix = materialize(prefix_rows(rows, entries), "jaccard-prefix")
    prefix = (matrix.select("node", "n", F.size("cols").alias("m"), F.posexplode(F.slice("cols", F.lit(1), F.col("take"))).alias("i", "col"))
              .select("col", "node", "n", (F.col("n") - F.col("m") + F.col("i")).alias("pos")))
    hubs = (prefix.groupBy("col").agg(F.min(F.struct("pos", "node", "n")).alias("h"), F.count(F.lit(1)).alias("rows"))
            .filter("rows > 1").select("col", F.col("h.node").alias("hub"), F.col("h.n").alias("hn"), F.col("h.pos").alias("hp")))
    stars = (prefix.join(hubs, "col").filter((F.col("node") != F.col("hub")) & _may_link(F.col("n"), F.col("pos"), F.col("hn"), F.col("hp")))
             .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    first = materialize(verify(stars, matrix), "jaccard-links")
    comp = components(first)
    # Rows of one column that are not yet in one component: pair components, then their members.
    # With na <= nb the bound reads nb <= cap(a) and na <= cap(b), cap = 7/3 of what follows less n; so the
    # smaller row has cap >= n, and its partners lie in its own or the next size class (ratio 4/3).
    placed = (prefix.join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
              .withColumn("cap", F.floor((F.col("n") - F.col("pos")) * 7 / 3) - F.col("n"))
              .withColumn("z", F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(4 / 3)) + F.lit(1e-9)).cast("int")))
    open_cols = placed.groupBy("col").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("col")
    rows_open = materialize(placed.join(open_cols, "col", "left_semi"), "jaccard-open")

    def grouped(df, tag):
        g = df.groupBy("col", "z", "root").agg(F.min("n").alias("n"), F.max("cap").alias("cap"),
                                               F.collect_list(F.struct("node", "n", "pos", "cap")).alias("g"))
        return g.select(*[F.col(c).alias(c + tag) for c in ("col", "z", "root", "n", "cap", "g")])

    small = rows_open.filter(F.col("cap") >= F.col("n")).withColumn("z", F.explode(F.array(F.col("z"), F.col("z") + 1)))
    x, y = grouped(small, "_a"), grouped(rows_open, "_b")
    cross = (x.join(y, (F.col("col_a") == F.col("col_b")) & (F.col("z_a") == F.col("z_b")) & (F.col("root_a") != F.col("root_b"))
                    & (F.col("n_b") <= F.col("cap_a")) & (F.col("n_a") <= F.col("cap_b")))
             # only members that the other group's extremes allow come out, so a large component meets no outsider in vain
             .select(F.explode(F.filter("g_a", lambda p: (p["cap"] >= F.col("n_b")) & (p["n"] <= F.col("cap_b")))).alias("p"), "g_b")
             .select("p", F.explode(F.filter("g_b", lambda q: (F.col("p.n") <= q["n"]) & _may_link(
                 F.col("p.n"), F.col("p.pos"), q["n"], q["pos"]))).alias("q"))
             .select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct())
    cross = cross.join(stars, ["a", "b"], "left_anti")
    return materialize(first.union(verify(cross, matrix)), "jaccard-links")


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every document row."""
    rows, entries = incidence(docs)
    comp = components(jaccard_links(rows, entries))
    own = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("own"))
    placed = own.join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("own").alias("component_id"))
    ids = placed.join(least, "root").select("node", "component_id")
    full = rows.filter("n > 0").join(ids, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.union(rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))


def one_per_class(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns as they are), one per class of near duplicates.

    A class keeps the row of its smallest doc_id (a null id only if there is no
    other); of repeated rows one stays.  Documents with an empty set all stay.
    """
    rows, entries = incidence(docs)
    comp = components(jaccard_links(rows, entries))
    own = rows.filter("n > 0").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("r"))
    keep = (own.join(comp, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("r").alias("r"))
            .select(F.coalesce("r.doc_id", F.lit(NO_ID)).alias("__id"), F.col("r.node").alias("__node"), F.lit(True).alias("__kept")))
    names, at = docs.columns, docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for i, j, data, offs in T.chunks(b.column(at)):
                _, _, size, sig = _sets(data, offs)
                yield pa.record_batch([b.column(c).slice(i, j - i) for c in range(len(names))]
                                      + [pa.array(size, pa.int64()), pa.array(sig.view(np.int64))], names=[*names, "__n", "__node"])

    schema = docs.select(*[f"`{c}`" for c in names]).schema.add("__n", "long").add("__node", "long")
    marked = docs.mapInArrow(run, schema).withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    full = marked.filter("__n > 0").join(keep, ["__id", "__node"])
    first = F.row_number().over(W.partitionBy("__id", "__node").orderBy("__n"))
    full = full.withColumn("__copy", first).filter("__copy = 1")
    return full.select(*[f"`{c}`" for c in names]).union(marked.filter("__n = 0").select(*[f"`{c}`" for c in names]))
