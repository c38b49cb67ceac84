"""Benchmark decontamination as a prefix-filtered set join (DataFrame functions only).

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.  Every
benchmark item gives windows of ``WINDOW`` consecutive words (an item of fewer
words, but not none, is one window).  A window is a set of shingles of
``SHINGLE`` consecutive words; it occurs in a document where all of them do, in
place.  With containment 1 the necessary prefix of a window is one shingle, so

1. one pass over all documents writes the positions that hold a shingle of the
   benchmark, each with the words around it (broadcast of the benchmark's distinct
   shingles, no shuffle of words);
2. the positions are counted per shingle and each window's shingles ordered by
   rarity; a shingle that occurs nowhere rules its windows out, of the others the
   rarest one is joined with its positions;
3. length bound: the document has at least the window's words; positional bound:
   the window put at the match begins and ends inside the document;
4. verify the slice of document words against the window, word by word.

The benchmark's windows are broadcast in blocks of ``BLOCK`` (a proven bound);
a larger benchmark takes more passes.  Matches are grouped by (doc_id, text
hash), never by benchmark item or shingle, so a passage that a third of all
documents holds is spread over those documents.

Edge cases: null or empty text has no words (0 hits); a null or wordless item has
no window; an item with a null id marks words but is not listed; repeated
documents are all returned; an empty benchmark leaves every document clean; an
empty document table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import ascii_lower, materialize

WINDOW, SHINGLE = 10, 3
#: windows per broadcast (about 200 bytes each)
BLOCK = 100_000
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_words(df: DataFrame, name: str = "words") -> DataFrame:
    """Add the word array; the split leaves at most one empty string at either end."""
    a = F.col("__split")
    df = df.withColumn("__split", F.split(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), BREAK))
    lead = F.when(F.element_at(a, 1) == "", 1).otherwise(0)
    trail = F.when((F.size(a) > 1) & (F.element_at(a, -1) == ""), 1).otherwise(0)
    return df.withColumn(name, F.slice(a, lead + 1, F.size(a) - lead - trail)).drop("__split")


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """item_id, window (word array) of every benchmark window."""
    w = with_words(items.select("item_id", "text")).filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - width, F.lit(0))
    return (w.select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("s"))
            .select("item_id", F.slice("words", F.col("s") + 1, F.least(F.size("words"), F.lit(width))).alias("window")))


def _key(words: Column, first: Column, k: int) -> Column:
    """Hash of the k words from 0-based position ``first``."""
    return F.xxhash64(F.lit(k), *[F.get(words, first + i) for i in range(k)])


def window_shingles(wins: DataFrame, k: int) -> DataFrame:
    """wid, window, off, key: the shingles of the windows that use shingles of k words."""
    size = F.least(F.size("window"), F.lit(SHINGLE))
    return (wins.filter(size == k)
            .select("wid", "window", F.explode(F.sequence(F.lit(0), F.size("window") - k)).alias("off"))
            .withColumn("key", _key(F.col("window"), F.col("off"), k)))


def _positions(docs: DataFrame) -> DataFrame:
    """One row per word position (1-based; words[0] is a sentinel) plus row 0 for the document itself."""
    d = with_words(docs.select("doc_id", F.col("text"))).select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), F.size("words").alias("n"),
        F.concat(F.array(F.lit("")), F.col("words")).alias("words"))
    return d.select("doc_id", "th", "n", "words", F.posexplode("words").alias("pos", "word"))


def _doc_key(k: int) -> Column:
    p = F.col("pos")
    return F.when((p > 0) & (p + (k - 1) <= F.col("n")), _key(F.col("words"), p, k))


def shingle_matches(docs: DataFrame, shingles: DataFrame, sizes: list[int], width: int) -> DataFrame:
    """Document positions that hold one of the benchmark's shingles, and row 0 of every document.

    One pass over the texts: (doc_id, th, n, pos, key, at, context); ``context``
    are the words from position ``at`` that a window through the shingle can reach.
    """
    pos, own = _positions(docs), F.col("pos") == 0
    if len(sizes) == 1:
        pos = pos.withColumn("key", _doc_key(sizes[0]))
    else:
        keys = F.array_compact(F.array(*[_doc_key(k) for k in sizes])) if sizes else F.array().cast("array<bigint>")
        pos = pos.withColumn("key", F.explode(F.when(own, F.array(F.lit(None).cast("long"))).otherwise(keys)))
    least = min(sizes, default=1)
    at = F.greatest(F.col("pos") - (width - least), F.lit(1))
    wanted = F.broadcast(shingles.select(F.col("key").alias("wanted")).distinct())
    return (pos.join(wanted, F.col("key") == F.col("wanted"), "left").filter(own | F.col("wanted").isNotNull())
            .select("doc_id", "th", "n", "pos", "key", at.alias("at"),
                    F.when(~own, F.slice("words", at + 1, F.lit(2 * width))).alias("context")))


def prefix_shingles(shingles: DataFrame, matches: DataFrame) -> DataFrame:
    """The necessary prefix of every window that can occur: its rarest shingle over all documents (wid, key, off, window)."""
    freq = matches.filter("pos > 0").groupBy("key").agg(F.count(F.lit(1)).alias("freq"))
    return (shingles.join(freq, "key", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
            .groupBy("wid").agg(F.min_by(F.struct("key", "off", "window"), F.struct("freq", "key", "off")).alias("m"),
                                F.min("freq").alias("freq"))
            .filter("freq > 0").select("wid", "m.key", "m.off", "m.window"))


def occurrences(matches: DataFrame, prefix: DataFrame) -> DataFrame:
    """doc_id, th, wid, start (1-based), len of every window that is verified word by word."""
    start, size = F.col("pos") - F.col("off"), F.size("window")
    hit = ((F.col("n") >= size) & (start >= 1) & (start + size - 1 <= F.col("n"))
           & (F.slice("context", start - F.col("at") + 1, size) == F.col("window")))
    return (matches.filter("pos > 0").join(F.broadcast(prefix), "key").filter(hit)
            .select("doc_id", "th", "wid", start.alias("start"), size.alias("len")))


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (ids as strings, sorted), contaminated, one row per document row."""
    distinct = materialize(windows(items, width).groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
                           .withColumn("wid", F.monotonically_increasing_id()), "decon-windows")
    stats = distinct.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.least(F.size("window"), F.lit(SHINGLE))).alias("ks")).first()
    sizes, blocks = sorted(stats["ks"]), max(1, -(-stats["n"] // block))
    found = None
    for b in range(blocks):
        wins = distinct.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)
        shingles = reduce(DataFrame.unionByName, [window_shingles(wins, k) for k in sizes or [SHINGLE]])
        matches = materialize(shingle_matches(docs, shingles, sizes, width), "decon-matches")
        hits = occurrences(matches, prefix_shingles(shingles, matches)).withColumn("n", F.lit(None).cast("int"))
        if b == 0:
            own = matches.filter("pos = 0").select("doc_id", "th", "n")
            found = own.unionByName(hits, allowMissingColumns=True)
        else:
            found = found.unionByName(hits)
    per_doc = found.groupBy("doc_id", "th").agg(
        F.max("n").alias("n"), F.count("n").alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("wid").isNotNull(), F.struct("start", "len")))).alias("spans"),
        F.collect_set("wid").alias("wids"))
    per_doc = materialize(per_doc.withColumn("n_hit", _covered(F.col("spans"))).drop("spans"), "decon-docs")
    ids = (per_doc.filter(F.size("wids") > 0).select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.explode("wids").alias("wid"))
           .join(distinct.select("wid", "ids"), "wid").select("_d", "_t", F.explode("ids").alias("id")).distinct()
           .groupBy("_d", "_t").agg(F.array_sort(F.collect_list("id")).alias("items")))
    out = per_doc.join(ids, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left")
    items_col = F.coalesce("items", F.array().cast("array<string>"))
    return (out.withColumn("items", items_col)
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "th", F.col("n").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated")))


def _covered(spans: Column) -> Column:
    """Number of positions in the union of (start, len) spans sorted by start."""
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["start"] + x["len"] - 1).alias("end"),
                              (a["n"] + F.greatest(F.lit(0), x["start"] + x["len"] - 1 - F.greatest(a["end"], x["start"] - 1))).alias("n")),
        lambda a: a["n"])


def contamination_digest(found: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) without any benchmark window."""
    bad = (contamination(docs, items).filter("contaminated").select(F.col("doc_id").alias("__d"), F.col("th").alias("__t")).distinct())
    own = docs.withColumn("__th", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    return own.join(bad, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("__th") == F.col("__t")), "left_anti").drop("__th")
