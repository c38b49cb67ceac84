"""Token-id files: whole texts as ids of a public tokenizer, range-coded in checksummed blocks.

*Writing.*  Rows are range-partitioned by (doc_id, hash of the text) and sorted, so the files hold
the documents in ascending doc_id order and no doc_id, null included, is tied to one
task.  A task tokenizes its documents in chunks, appends the end id to each, cuts
the stream of ids into blocks of ``rangecoder.BLOCK`` ids (a long document spans several)
and codes up to ``rangecoder.LANES`` blocks in step.  The container is Parquet, one row per block, so a
retried task leaves no half-written file.  A block row holds

    shard, block       number of the file in doc_id order, number of the block in it
    first              ids of the shard before this block
    n_tokens           ids in the block
    first_doc          number (in the shard) of the first document in it
    skipped            ids of that document in earlier blocks
    doc_ids, doc_tokens   key and whole number of ids of every document in it
    payload            the coded block (``rangecoder``), readable on its own

*Reading* decodes blocks in Arrow batches wherever Spark splits the files.  Pieces of a
document meet in one aggregation of a small row per piece: ids are counted, and CRC-32 is
linear, so a piece's checksum moved over the ids behind it adds (xor) to the document's.
A missing or damaged block is an error.  Starts are running totals per shard: the totals (one
number per file) pass the driver.

Tokenizing splits a text at places where the byte-level BPE's word pattern never joins anything
(single spaces and line ends between visible characters, stops behind letters), and encodes every distinct piece once per
worker; the ids equal those of the whole text (``split`` = False encodes whole texts, for
tokenizers without that property).  The cache is emptied at ``CACHE`` pieces.

Edge cases: a null or empty text has the end id only; control strings in texts are ordinary
text; repeated rows and repeated or null doc_ids (first) are separate documents, copies of
one doc_id in the order of their texts' hashes; a text of any length is coded whole; an
empty table gives no blocks and an empty result; other columns are ignored.
"""

from __future__ import annotations

import sys
import types
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from riskspark.llm import rangecoder as R
from riskspark.llm import textops as T
from riskspark.llm.common import arrow_batches, shards

END_ID = 2
#: distinct pieces a worker remembers
CACHE = 600_000
TEXT_CHUNK = 4 << 20
STOP = np.zeros(256, bool)
STOP[list(b".,;:!?)")] = True


class Tokenizer:
    """A tokenizer file with a cache of encoded pieces; lives in a worker."""

    def __init__(self, path: str, split: bool = True):
        from tokenizers import Tokenizer as File

        self.file = File.from_file(path)
        self.file.encode_special_tokens = True
        self.vocab = self.file.get_vocab_size(with_added_tokens=True)
        self.split = split
        lines = self._plain(["\n"])[0]
        self.newline = lines[0] if len(lines) == 1 else None
        self._empty()

    def _empty(self):
        self.known, self.flat, self.begin = {}, np.zeros(1 << 16, np.int32), np.zeros(CACHE + (1 << 20), np.int64)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        encode = getattr(self.file, "encode_batch_fast", self.file.encode_batch)
        return [e.ids for e in encode(texts, add_special_tokens=False)]

    def _encode(self, pieces: list[str]):
        """(pieces in another order, their ids one after the other, ids of each).

        Many go through the library in one call, parted by line ends (one id of their own).
        """
        order, flat, sizes, rest = [], [], [], []
        if self.newline is None or not self.split:
            rest = pieces
        else:
            simple = []
            for p in pieces:
                (simple if (r := p[1:] if p[0] == " " else p) and r.split() == [r] else rest).append(p)
            for k in range(0, len(simple), 1024):
                group = simple[k:k + 1024]
                ids = np.array(self._plain(["\n".join(group)])[0], np.int32)
                cut = np.flatnonzero(ids == self.newline)
                if len(cut) != len(group) - 1:           # these go one by one
                    rest += group
                    continue
                order += group
                flat.append(np.delete(ids, cut))
                sizes.append(np.diff(cut, prepend=-1, append=len(ids)) - 1)
        single = self._plain(rest)
        flat += [np.asarray(x, np.int32) for x in single]
        sizes.append(np.array([len(x) for x in single], np.int64))
        return order + rest, np.concatenate(flat), np.concatenate(sizes)

    def _add(self, pieces: list[str]):
        pieces, ids, sizes = self._encode(pieces)
        n, at = len(self.known), int(self.begin[len(self.known)])
        while at + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(sizes) >= len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.flat[at:at + len(ids)] = ids
        self.begin[n + 1:n + 1 + len(sizes)] = at + np.cumsum(sizes)
        self.known.update(zip(pieces, range(n, n + len(pieces))))

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int = END_ID):
        """(ids, ids per text) of a chunk of texts, the end id behind each text."""
        import pyarrow as pa

        n = len(offsets) - 1
        if len(self.known) > CACHE:
            self._empty()
        cuts = _cuts(data) if self.split else np.zeros(0, np.int64)
        at = np.sort(np.concatenate([offsets, cuts]))
        at = at[np.append(True, at[1:] != at[:-1])]
        if len(at) < 2:
            return np.full(n, end_id, np.int32), np.ones(n, np.int64)
        pieces = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if missing := [w for w in words if w not in self.known]:
            self._add(missing)
        known, use = self.known, coded.indices.to_numpy()
        word = np.fromiter((known[w] for w in words), np.int64, len(words))
        begin = self.begin[word]
        size = (self.begin[word + 1] - begin).astype(np.int32)[use]
        behind = np.cumsum(size, dtype=np.int32)
        place = np.repeat(begin.astype(np.int32)[use] - (behind - size), size)
        place += np.arange(len(place), dtype=np.int32)
        ends = np.append(0, behind)[np.searchsorted(at, offsets)]        # of the texts, in ids of pieces
        count = np.diff(ends).astype(np.int64) + 1
        out = np.insert(self.flat[place], ends[1:], end_id)
        return out, count


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places where a piece may begin.

    Before spaces with a visible character on both sides; visible for sure are ASCII above the space and
    two-byte characters but for lead byte C2, ahead also four-byte ones and three-byte ones with a
    lead byte above E3 (no white space there).  Before a stop behind an ASCII letter.  Before and
    behind a line end between two visible ASCII characters.
    """
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 1) & (at < len(data) - 1)]
    before, second, ahead = data[at - 1], data[at - 2], data[at + 1]
    left = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (second >= 0xC3) & (second <= 0xDF))
    right = ((ahead > 0x20) & (ahead < 0x7F)) | ((ahead >= 0xC3) & (ahead <= 0xDF)) | (ahead >= 0xE4)
    stop = np.flatnonzero(STOP[data])
    stop = stop[stop > 0]
    letter = data[stop - 1] | 0x20
    line = np.flatnonzero(data == 0x0A)
    line = line[(line > 0) & (line < len(data) - 1)]
    before, ahead = data[line - 1], data[line + 1]
    line = line[(before > 0x20) & (before < 0x7F) & (ahead > 0x20) & (ahead < 0x7F)]
    return np.concatenate([at[left & right], stop[(letter >= 0x61) & (letter <= 0x7A)], line, line + 1])


def tokenizer(path: str, split: bool = True) -> Tokenizer:
    """The process's tokenizer of a file.

    This code travels to the workers by value, anew for every task; the tokenizer and its cache
    stay in the worker process under a module name of their own.
    """
    kept = sys.modules.setdefault("riskspark_worker_tokenizers", types.ModuleType("riskspark_worker_tokenizers")).__dict__
    if (path, split) not in kept:
        kept[path, split] = Tokenizer(path, split)
    return kept[path, split]


FIELDS = ["shard", "block", "first", "n_tokens", "first_doc", "skipped", "doc_ids", "doc_tokens", "payload"]


def _schema(doc_id) -> StructType:
    kinds = [IntegerType(), IntegerType(), LongType(), IntegerType(), LongType(), LongType(), ArrayType(doc_id), ArrayType(LongType()), BinaryType()]
    out = StructType()
    for name, kind in zip(FIELDS, kinds):
        out = out.add(name, kind)
    return out


class _Writer:
    """Cuts a shard's stream of documents into blocks."""

    def __init__(self, shard: int, vocab: int):
        self.shard, self.vocab = shard, vocab
        self.ids, self.keys, self.sizes = [], [], []     # waiting ids, document keys, document sizes
        self.waiting = self.first = self.block = self.first_doc = self.skipped = 0

    def add(self, keys, sizes: np.ndarray, ids: np.ndarray):
        self.ids.append(ids)
        self.keys.append(keys)
        self.sizes.append(sizes)
        self.waiting += len(ids)

    def flush(self, all_of_it: bool):
        """Block rows of what waits; a part of a block stays unless ``all_of_it``."""
        import pyarrow as pa

        ids, keys, sizes = np.concatenate(self.ids), pa.concat_arrays(self.keys), np.concatenate(self.sizes)
        upto = len(ids) if all_of_it else len(ids) // R.BLOCK * R.BLOCK
        edges = np.append(np.arange(0, upto, R.BLOCK), upto)
        ends = np.cumsum(sizes) - self.skipped           # of the documents, in waiting ids
        begins = ends - sizes
        lo, hi = np.searchsorted(ends, edges[:-1], "right"), np.searchsorted(begins, edges[1:], "left")
        blocks = R.encode_blocks([ids[a:b] for a, b in zip(edges[:-1], edges[1:])], self.vocab)
        n, span = len(blocks), hi - lo
        at = np.repeat(lo - (np.cumsum(span) - span), span) + np.arange(span.sum())
        cut = pa.array(np.append(0, np.cumsum(span)), pa.int32())
        yield pa.record_batch([
            pa.array(np.full(n, self.shard), pa.int32()), pa.array(np.arange(self.block, self.block + n), pa.int32()),
            pa.array(self.first + edges[:-1], pa.int64()), pa.array(np.diff(edges), pa.int32()),
            pa.array(self.first_doc + lo, pa.int64()), pa.array(np.maximum(edges[:-1] - begins[lo], 0), pa.int64()),
            pa.ListArray.from_arrays(cut, keys.take(pa.array(at))), pa.ListArray.from_arrays(cut, pa.array(sizes[at])),
            pa.array(blocks, pa.binary())], names=FIELDS)
        done = int(np.searchsorted(ends, upto, "right"))  # documents that are written whole
        self.skipped = int(upto - begins[done]) if done < len(sizes) else 0
        self.ids, self.keys, self.sizes = [ids[upto:].copy()], [keys.slice(done)], [sizes[done:]]
        self.first, self.block, self.first_doc, self.waiting = self.first + upto, self.block + n, self.first_doc + done, len(ids) - upto


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, split: bool = True) -> None:
    """Write the token files of ``docs`` (doc_id, text) into a folder, one file per shard."""
    spark = docs.sparkSession
    arrow_batches(spark)
    doc_id = docs.schema["doc_id"].dataType
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    d = d.repartitionByRange(shards(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")

    def run(batches):
        from pyspark import TaskContext

        tok, out = tokenizer(tokenizer_path, split), None
        for b in batches:
            out = out or _Writer(TaskContext.get().partitionId(), max(tok.vocab, end_id + 1))
            for i, j, data, offs in T.chunks(b.column(1), TEXT_CHUNK):
                ids, count = tok.encode(data, offs, end_id)
                out.add(b.column(0).slice(i, j - i), count, ids)
                if out.waiting >= R.BLOCK * R.LANES:
                    yield from out.flush(False)
        if out and out.waiting:
            yield from out.flush(True)

    d.mapInArrow(run, _schema(doc_id)).write.mode("overwrite").parquet(path)


def crc_shift(crc: int, n_bytes: int) -> int:
    """CRC-32 of data followed by other data of ``n_bytes``, as far as the first data counts in it.

    ``crc32(a + b) == crc_shift(crc32(a), len(b)) ^ crc32(b)``: a product by x^(8 n) modulo the polynomial.
    """
    power, square, n = 1 << 31, 1 << 23, n_bytes        # x^0 and x^8, bits reflected
    while n:
        if n & 1:
            power = _product(power, square)
        square, n = _product(square, square), n >> 1
    return _product(power, crc)


def _product(a: int, b: int) -> int:
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        a = (a << 1) & 0xFFFFFFFF
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return out


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """A row per block and document in it: shard, doc, doc_id, first, n, total, crc (moved to the document's end), ids."""
    stored = spark.read.parquet(path).select(*FIELDS)
    doc_id = stored.schema["doc_ids"].dataType.elementType

    def decode(rows):
        import pyarrow as pa

        t = pa.Table.from_batches(rows)
        for shard, first, n, doc, skipped, keys, totals, ids in zip(
                *(t.column(c).to_pylist() for c in ("shard", "first", "n_tokens", "first_doc", "skipped")),
                t.column("doc_ids"), t.column("doc_tokens"), R.decode_blocks(t.column("payload").to_pylist())):
            total = np.array(totals.as_py(), np.int64)
            if len(ids) != n:
                raise ValueError("token block is damaged: number of ids")
            begin = np.maximum(np.cumsum(total) - total - skipped, 0)
            end = np.minimum(np.cumsum(total) - skipped, n)
            before = np.zeros(len(total), np.int64)
            before[0] = skipped
            crc = []
            for a, z, left in zip(begin.tolist(), end.tolist(), (total - before - (end - begin)).tolist()):
                c = zlib.crc32(ids[a:z].tobytes())
                crc.append(crc_shift(c, 4 * left) if left else c)
            k = len(total)
            yield pa.record_batch(
                [pa.array([shard] * k, pa.int32()), pa.array(np.arange(doc, doc + k)), keys.values, pa.array(first + begin),
                 pa.array(end - begin), pa.array(total), pa.array(crc, pa.int64())]
                + ([pa.array([ids[a:z].tobytes() for a, z in zip(begin, end)], pa.binary())] if with_ids else []),
                names=["shard", "doc", "doc_id", "first", "n", "total", "crc"] + ["ids"] * with_ids)

    def run(batches):
        waiting, size = [], 0
        for b in batches:
            for k in range(0, b.num_rows, R.LANES):
                part = b.slice(k, R.LANES)
                if waiting and size + part.num_rows > R.LANES:
                    yield from decode(waiting)
                    waiting, size = [], 0
                waiting.append(part)
                size += part.num_rows
        if size:
            yield from decode(waiting)

    schema = StructType().add("shard", IntegerType()).add("doc", LongType()).add("doc_id", doc_id)
    for c in ("first", "n", "total", "crc"):
        schema = schema.add(c, LongType())
    return stored.mapInArrow(run, schema.add("ids", BinaryType()) if with_ids else schema)


def _starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, base: ids in the files before; one row per file, so its size is the number of files."""
    totals = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    base = np.cumsum([0] + [r["n"] for r in totals]).tolist()
    return spark.createDataFrame([(r["shard"], b) for r, b in zip(totals, base)], "shard int, base long")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the files, all ids decoded and tested."""
    whole = read_pieces(spark, path).groupBy("shard", "doc", "doc_id").agg(
        F.min("first").alias("first"), F.sum("n").alias("n_tokens"), F.max("total").alias("total"), F.bit_xor("crc").alias("ids_crc32"))
    whole = whole.withColumn("n_tokens", F.when(F.col("n_tokens") == F.col("total"), F.col("n_tokens"))
                             .otherwise(F.raise_error(F.lit("a document's token blocks are not complete")).cast("long")))
    return whole.join(F.broadcast(_starts(spark, path)), "shard").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ids: every document's ids as little-endian 32-bit words (a document is one row by definition)."""
    pieces = read_pieces(spark, path, with_ids=True).groupBy("shard", "doc", "doc_id").agg(
        F.sort_array(F.collect_list(F.struct("first", "ids"))).alias("p"))
    return pieces.select("doc_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
