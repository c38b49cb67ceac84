"""Registered queries of the operators: thin digests over whole tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from riskspark.llm import chat, decontam, dialogue, linecrf, lines, mixing, ngram_join, passages, quality_rules, repetition, secrets, tokenfiles, toxicity
from riskspark.llm.common import table
from riskspark.llm.labelled import fold_column
from riskspark.session import scratch_path

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


#: words, items and windows of the contamination contract
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query("op1_prefix_join", f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s + 1 : s + least(len(w), 10)], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, k, s, array_to_string(w[s + 1 : s + k], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS s FROM d, sizes WHERE len(w) >= k)),
hit AS (SELECT doc_id, dw.k, s, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.k = iw.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT doc_id, s, k FROM hit)) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS l
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(pos.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(ids.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids.l, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
""")
def op1(spark, sf_dir):
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.contamination_digest(found)


@query("op2_line_crf")
def op2(spark, sf_dir):
    fold = fold_column(F.col("doc_id"), 4)
    d = linecrf.quality_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), lambda c: fold_column(c, 4) != 2)
    return d.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op3_toxic_segments")
def op3(spark, sf_dir):
    fold = fold_column(F.col("doc_id"), 5)
    d = toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), lambda c: fold_column(c, 5) != 0)
    return d.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


@query("op4_shingle_product", f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 5, 0) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, reach) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(reach) AS c FROM r GROUP BY doc_id) m USING (doc_id)
""")
def op4(spark, sf_dir):
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"))


@query("op5_compact_windows")
def op5(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query("op6_entropy_mix")
def op6(spark, sf_dir):
    d = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@query("op7_blob_ledger")
def op7(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))
    return secrets.scan_digest(found)


#: turns as (conv_id, turn, role, text), null text and role empty, with the planted conversation
_TURNS = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&lsqb;'), ']', '&rsqb;') AS esc,
             replace(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&lsqb;'), ']', '&rsqb;') AS esc_role FROM t)
"""


@query("op8_typed_parts", _TURNS + """
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(7 + sum(6 + length(esc_role) + 1 + length(esc) + 7) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_attachments,
       CAST(sum(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))) AS BIGINT) AS n_tokens
FROM e GROUP BY conv_id
""")
def op8(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.chat_digest(c.unionByName(planted).withColumn("parts", chat.text_parts(F.col("text"))))


@query("op9_line_index", """
WITH l AS (SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
g AS (SELECT k, min(doc_id) AS keep FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
f AS (SELECT doc_id, i, line, keep IS NOT NULL AND doc_id <> keep AS gone FROM l LEFT JOIN g USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
""")
def op9(spark, sf_dir):
    d = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op10_ngram_rules")
def op10(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_rank_viterbi")
def op11(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    rows, chunks = dialogue.repair(dialogue.damage(c))
    return dialogue.repair_digest(c, rows, chunks)


@query("op12_frequency_split")
def op12(spark, sf_dir):
    docs = repetition.plant_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return repetition.run_digest(repetition.collapse_runs(docs))


@query("op13_context_mixing")
def op13(spark, sf_dir):
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    tokenfiles.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfiles.read_documents(spark, path)
