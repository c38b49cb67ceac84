"""Chat formatting with typed content parts (DataFrame functions only).

A message is a row (conv_id, turn, role, parts); ``parts`` is an array of typed
parts ``struct<type, text, ref, n>``:

* ``text``      the text itself
* ``image``     ``n`` tiles,   placeholder ``<image_k>``,    IMAGE_TOKENS per tile
* ``audio``     ``n`` seconds, placeholder ``<audio_k>``,    AUDIO_TOKENS per second
* ``document``  ``n`` pages,   placeholder ``<document_k>``, DOCUMENT_TOKENS per page

The visitor walks the parts of a conversation in order (turn, then position) and
flattens them to one string: text is escaped, every other part becomes a
placeholder numbered per type over the whole conversation, its reference goes
to the attachment list and its expanded token count is recorded.

Template of a turn: ``[TURN role]text[/TURN]``; a conversation is ``<s>`` turns
``</s>``.  Inside roles and texts ``& < > [ ]`` are written as character
references, so no control string of this or another template survives in a text
and the escape is reversed exactly.  Placeholders use ``< >`` and can therefore
not be forged by text.  ``spans`` are the loss spans (assistant texts, without
control strings) as (start, length) in code points of the formatted text.

Edge cases: null role, text or part list is empty; unknown part types are
treated as ``document``; turns sort by (turn, role, parts), null turn first;
rows with a null conv_id form one conversation; an empty table gives an empty
result; extra columns are ignored.  A conversation is one string, so its turns
meet in one row by definition.  The sums run over the whole table of messages;
nothing but the order of a conversation's own turns is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskspark.llm.common import WS

#: control strings of the template and their escapes; "&" is replaced first and restored last
OPEN, MIDDLE, CLOSE, BEGIN, END = "[TURN ", "]", "[/TURN]", "<s>", "</s>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lsqb;"), ("]", "&rsqb;"))
IMAGE_TOKENS, AUDIO_TOKENS, DOCUMENT_TOKENS = 256, 25, 512
MEDIA = ("image", "audio", "document")
LOSS_ROLE = "assistant"
PART = "struct<type:string,text:string,ref:string,n:int>"


def escape(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    for raw, safe in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def text_parts(text: Column) -> Column:
    """A plain text column as a one-part list."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            null.cast("string").alias("ref"), null.cast("int").alias("n"))).cast(f"array<{PART}>")


def _kind(p: Column) -> Column:
    t = p["type"]
    return F.when(t.isin("text", "image", "audio"), t).otherwise(F.lit("document"))


def _tokens(p: Column) -> Column:
    n = F.coalesce(p["n"], F.lit(1)).cast("long")
    words = F.size(F.filter(F.split(F.coalesce(p["text"], F.lit("")), WS), lambda w: w != ""))
    k = _kind(p)
    return (F.when(k == "text", words.cast("long")).when(k == "image", n * IMAGE_TOKENS)
            .when(k == "audio", n * AUDIO_TOKENS).otherwise(n * DOCUMENT_TOKENS))


def _n_of(kind: str, parts: Column) -> Column:
    return F.size(F.filter(parts, lambda p: _kind(p) == kind))


def _placeholder(parts: Column, p: Column, i: Column) -> Column:
    """Placeholder of part i: media of its kind in earlier turns, and up to i in this one."""
    def number(kind):
        return F.col(f"before_{kind}") + _n_of(kind, F.slice(parts, F.lit(1), i + 1))
    k = _kind(p)
    no = F.when(k == "image", number("image")).when(k == "audio", number("audio")).otherwise(number("document"))
    return F.concat(F.lit("<"), k, F.lit("_"), no.cast("string"), F.lit(">"))


def format_messages(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, spans, attachments, n_tokens; ``messages``: conv_id, turn, role, parts.

    One shuffle by conv_id: the running counts (media of each kind, characters)
    are window sums over the turns, and the aggregation reuses the partitioning.
    """
    parts = F.col("parts")
    m = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("parts", F.array().cast(f"array<{PART}>")).alias("parts"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "parts")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    m = m.withColumn("k", F.row_number().over(order))
    for kind in MEDIA:
        m = m.withColumn(f"before_{kind}", F.coalesce(F.sum(_n_of(kind, parts)).over(before), F.lit(0)))
    body = F.array_join(F.transform(parts, lambda p, i: F.when(_kind(p) == "text", escape(p["text"]))
                                    .otherwise(_placeholder(parts, p, i))), "")
    media = F.filter(F.transform(parts, lambda p, i: F.struct(
        _placeholder(parts, p, i).alias("placeholder"), _kind(p).alias("type"),
        p["ref"].alias("ref"), _tokens(p).alias("tokens"))), lambda a: a["type"] != "text")
    tokens = F.aggregate(F.transform(parts, _tokens), F.lit(0).cast("long"), lambda a, x: a + x)
    m = (m.withColumn("body", body).withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE)))
         .withColumn("media", media).withColumn("tokens", tokens))
    chars = F.char_length("head") + F.char_length("body") + F.lit(len(CLOSE))
    m = m.withColumn("start", F.lit(len(BEGIN)) + F.coalesce(F.sum(chars).over(before), F.lit(0)) + F.char_length("head"))
    turn = F.struct("k", F.concat("head", "body", F.lit(CLOSE)).alias("s"), "role", "start",
                    F.char_length("body").alias("length"), "media")
    conv = m.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.sum("tokens").alias("n_tokens"))
    return conv.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(F.transform("turns", lambda t: t["s"]), ""), F.lit(END)).alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["role"] == LOSS_ROLE), lambda t: F.struct(
            (t["k"] - 1).alias("turn_index"), t["start"].alias("start"), t["length"].alias("length"))).alias("spans"),
        F.flatten(F.transform("turns", lambda t: t["media"])).alias("attachments"), "n_tokens")


def read_back(formatted: Column) -> Column:
    """Turns of a formatted conversation as array<struct<role, text>>, escapes undone."""
    inner = F.substring(formatted, F.lit(len(BEGIN) + 1), F.char_length(formatted) - (len(BEGIN) + len(END)))
    pieces = F.filter(F.split(inner, r"\[/TURN\]"), lambda p: p != "")
    return F.transform(pieces, lambda p: _turn(F.substring_index(p, MIDDLE, 1), p))


def _turn(head: Column, piece: Column) -> Column:
    role = F.substring(head, F.lit(len(OPEN) + 1), F.char_length(head))
    text = F.substring(piece, F.char_length(head) + 2, F.char_length(piece))
    return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))


def chat_digest(messages: DataFrame) -> DataFrame:
    """Contract columns of the registered query, read back from the formatted text and its loss spans."""
    f = format_messages(messages).withColumn("back", read_back(F.col("formatted")))
    # what the mask covers, cut from the formatted text, then unescaped
    loss = F.array_join(F.transform("spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    turns = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return f.withColumn("loss", loss).select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"), "n_tokens")
