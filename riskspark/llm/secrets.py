"""Secret scans with an incremental blob ledger.

Every text is content-addressed (SHA-256 of its UTF-8 bytes).  The ledger is a
Parquet table of (blob, rules, findings): which rule versions have been run on a
blob and what they found.  A scan

1. addresses every path (document version) by its blob,
2. keeps one text per blob (map-side first, so a blob that a third of all paths
   hold is one text per task before the shuffle),
3. removes the (blob, rule version) pairs that the ledger already has,
4. runs the remaining rules over the remaining blobs in Arrow batches and
   appends what they found to the ledger (clean blobs too),
5. joins the findings back to all paths.

A second scan with the same rules runs over new blobs only; raising a rule's
version runs that rule alone over all blobs.  Rules are leftmost non-overlapping
matches; matches that are too short are dropped after matching.

Edge cases: null text is the empty blob; a path without findings has an empty
list; repeated rows keep their rows; an empty table gives an empty result; extra
columns are ignored; a missing ledger folder is an empty ledger.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import arrow_batches

#: Base rules of the contract (fixed values), then the added kinds; kind: (version, pattern, group, shortest length).
#: ``[0-9a-f]{24,}`` and ``AKIA[A-Z0-9]{16,}`` match exactly the maximal runs of the base rules that are long enough.
BASE = ("assign", "access", "hex")
RULES = {
    "assign": (1, r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (1, r"[0-9a-f]{24,}", 0, 24),
    "pem": (1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
    "jwt": (1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 20),
    "urlcred": (1, r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@", 0, 8),
}
IGNORE_CASE = ("assign",)
#: what a text must contain (lower-cased) for the rule to match at all
NEEDS = {"assign": ("password", "passwd", "secret", "token", "api"), "access": ("akia",), "pem": ("-----begin",),
         "jwt": ("eyj",), "urlcred": ("://",)}
FINDINGS = "array<struct<kind:string,start:long,end:long>>"


def rule_ids(rules=None) -> list[str]:
    return [f"{k}@{v[0]}" for k, v in (rules or RULES).items()]


def find(text: str, kinds, rules=None) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, end exclusive."""
    rules, out, low = rules or RULES, [], text.lower()
    for kind in kinds:
        if kind in NEEDS and not any(x in low for x in NEEDS[kind]):
            continue
        _, pattern, group, least = rules[kind]
        flags = re.ASCII | (re.IGNORECASE if kind in IGNORE_CASE else 0)
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text, flags) if m.end(group) - m.start(group) >= least]
    return out


def read_ledger(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"blob string, rules array<string>, findings {FINDINGS}").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_unseen(docs: DataFrame, ledger_path: str, rules=None) -> DataFrame:
    """Run the unseen (blob, rule version) pairs and append them to the ledger; returns the ledger."""
    spark = docs.sparkSession
    arrow_batches(spark)
    rules = rules or RULES
    ids = F.array(*[F.lit(x) for x in rule_ids(rules)])
    text = F.coalesce("text", F.lit(""))
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
    known = read_ledger(spark, ledger_path)
    if known is None:
        todo = blobs.groupBy("blob").agg(F.first("text").alias("text")).withColumn("todo", ids)
    else:
        have = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("have"))
        todo = (blobs.join(have, "blob", "left")
                .withColumn("todo", F.array_except(ids, F.coalesce("have", F.array().cast("array<string>"))))
                .filter(F.size("todo") > 0)
                .groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo")))

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            texts, todos = b.column(1).to_pylist(), b.column(2).to_pylist()
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find(x, [r.split("@")[0] for r in todo], rules)]
                     for x, todo in zip(texts, todos)]
            yield pa.record_batch([b.column(0), b.column(2), pa.array(found, kind)], names=["blob", "rules", "findings"])

    new = todo.select("blob", "text", "todo").mapInArrow(run, f"blob string, rules array<string>, findings {FINDINGS}")
    new.write.mode("append").parquet(ledger_path)
    return read_ledger(spark, ledger_path)


def scan(docs: DataFrame, ledger_path: str, rules=None) -> DataFrame:
    """doc_id, blob, findings (sorted by start, then rule order) for every path, scanning only what the ledger lacks."""
    rules = rules or RULES
    ledger = scan_unseen(docs, ledger_path, rules)
    place = F.create_map(*[x for i, k in enumerate(rules) for x in (F.lit(k), F.lit(i))])
    current = F.array(*[F.lit(x) for x in rule_ids(rules)])
    hits = (ledger.filter(F.size("findings") > 0)
            .withColumn("ran", F.array_intersect("rules", current))
            .withColumn("findings", F.filter("findings", lambda f: F.exists("ran", lambda r: F.substring_index(r, "@", 1) == f["kind"])))
            .groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("f"))
            .select("blob", F.transform(F.array_sort(F.transform("f", lambda x: F.struct(
                x["start"].alias("start"), F.element_at(place, x["kind"]).alias("place"), x["kind"].alias("kind"), x["end"].alias("end")))),
                lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("findings")))
    paths = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))
    return paths.join(hits, "blob", "left").select(
        "doc_id", "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings"))


def scan_digest(found: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    def text(col):
        return F.array_join(F.transform(col, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    base = F.filter("findings", lambda f: f["kind"].isin(*BASE))
    def of(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of(k) for k in BASE]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text("findings").alias("spans"))
