"""Token files: exact round trips, damaged blocks, ids of the whole texts, contract columns by brute force."""

import os
import random
import sys
import zlib

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute as B  # noqa: E402
import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
import pytest  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from riskspark.llm import rangecoder as R  # noqa: E402
from riskspark.llm import tokenfiles as K  # noqa: E402
from riskspark.llm.queries import QUERIES  # noqa: E402
from riskspark.session import scratch_path  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    blocks = [rng.integers(0, 50257, n) for n in (1, 2, 31, 32, 33, 500, R.BLOCK)]
    blocks += [np.zeros(R.BLOCK, int), np.full(100, 50256), np.arange(R.BLOCK) % 3, np.arange(R.BLOCK) * 7 % 50257]
    blocks += [(rng.pareto(0.5, 1500) * 20).astype(np.int64) % 50257 for _ in range(20)]
    coded = R.encode_blocks(blocks, 50257)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, R.decode_blocks(coded)))
    assert [len(x) for x in coded[7:9]] == [len(coded[7]), len(coded[8])] and len(coded[7]) < 80
    for k in (0, 5, 11):                                 # a block decodes alone and codes alike in any company
        assert R.encode_blocks([blocks[k]], 50257) == [coded[k]]
        assert np.array_equal(R.decode_blocks([coded[k]])[0], blocks[k])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=120), min_size=1, max_size=5))
def test_small_vocabularies_round_trip(blocks):
    blocks = [np.array(b) for b in blocks]
    assert all(np.array_equal(a, b) for a, b in zip(blocks, R.decode_blocks(R.encode_blocks(blocks, 10))))


def test_prediction_pays():
    rng = random.Random(1)
    text = [rng.randrange(300) for _ in range(600)]
    repeated, mixed = np.array((text * 4)[:R.BLOCK]), np.random.default_rng(0).integers(0, 50257, R.BLOCK)
    a, b = map(len, R.encode_blocks([repeated, mixed], 50257))
    assert 8 * a / R.BLOCK < 6 and 8 * b / R.BLOCK < 19.5


def test_damage_is_found():
    coded = R.encode_blocks([np.arange(900) % 50], 64)[0]
    for k in (0, 5, 9, 13, 17, 21, R.HEADER_SIZE, len(coded) - 1):
        bad = coded[:k] + bytes([coded[k] ^ 4]) + coded[k + 1:]
        with pytest.raises(ValueError):
            R.decode_blocks([bad])
    for bad in (coded[:-4], coded[:10], b""):
        with pytest.raises(ValueError):
            R.decode_blocks([bad])
    with pytest.raises(ValueError):
        R.encode_blocks([np.array([64])], 64)


def test_crc_of_joined_data():
    rng = random.Random(2)
    for _ in range(50):
        a, b = rng.randbytes(rng.randrange(50)), rng.randbytes(rng.randrange(5000))
        assert zlib.crc32(a + b) == K.crc_shift(zlib.crc32(a), len(b)) ^ zlib.crc32(b)


AWKWARD = ["", " ", "a", " a", "a b", "a  b", "a \n b", "\na b\n", "it's we'll 'S  'x", "é à  ü ß", "x  y  z", "中 文 字 a",
           "a  b  c", "1 2 33 a1 b", "<|endoftext|> a <|endoftext|>", "emoji 😀 😀a b", "tab\t a\x1c b \x85 c", "x " * 50, "\r\n a b",
           "᠎ a ᠎b c", "　 a b　 c", "a b" * 500, "´ a ¨ b", "a\x00 b \x00 c", "ſ ſt ﬁ x"]


def test_ids_of_whole_texts(library):
    import pyarrow as pa

    rng = random.Random(3)
    parts = [" ", "  ", "\n", "a", "the", "é", "中", "😀", "'s", "1", ".", " ", " ", "　", "\t", "Word", "ß"]
    texts = AWKWARD + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(800)]
    tok = K.Tokenizer(PATH)
    for _ in range(2):                                   # the second time from the cache
        got = []
        for _, _, data, offs in K.T.chunks(pa.array(texts), 2000):
            ids, count = tok.encode(data, offs)
            got += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
        assert got == [library(t) for t in texts]
    assert K.Tokenizer(PATH, split=False).encode(*list(K.T.chunks(pa.array(texts)))[0][2:])[0].tolist() == [i for t in texts for i in library(t)]


def expected(rows, library):
    out, at = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library(text)
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files(spark, library):
    rng = random.Random(8)
    rows = [(i, t) for i, (_, t, *_) in enumerate(B.corpus())]
    rows += [(5000, B.sentence(rng, 9000)), (5001, None), (-7, B.sentence(rng, 4100)), (None, "no key")]
    rows += [(6000 + i, t) for i, t in enumerate(AWKWARD)]
    rng.shuffle(rows)
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, shard int").repartition(5)
    path = scratch_path(spark, "token-test")
    K.write_tokens(d, path, PATH)
    got = sorted((tuple(r) for r in K.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(rows, library)
    assert spark.read.parquet(path).filter("skipped > 0").count() > 3    # long documents span blocks
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in K.read_ids(spark, path).collect()}
    assert all(ids[k] == library(t) for k, t in rows)
    bad = scratch_path(spark, "token-test-bad")
    spark.read.parquet(path).filter("not (skipped > 0 and first_doc >= 0) or block % 2 = 0").write.parquet(bad)
    with pytest.raises(Exception, match="not complete"):
        K.read_documents(spark, bad).collect()


def test_repeated_rows_text_keys_and_no_rows(spark, library):
    rows = [("b", "one two"), ("b", "one two"), ("a", "x"), (None, None), (None, "y")]
    d = spark.createDataFrame(rows, "doc_id string, text string")
    path = scratch_path(spark, "token-test")
    K.write_tokens(d, path, PATH)
    got = sorted((tuple(r) for r in K.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, "a", "b", "b"]
    assert sorted(r[3] for r in got) == sorted(zlib.crc32(np.array(library(t), "<u4").tobytes()) for _, t in rows)
    K.write_tokens(d.limit(0), path + "-none", PATH)
    assert K.read_documents(spark, path + "-none").count() == 0


def test_query_on_whole_table(spark, library):
    got = sorted((tuple(r) for r in QUERIES["op13_context_mixing"](spark, SF_SMALL).collect()), key=lambda r: r[1])
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert got == expected([tuple(r) for r in docs], library)
