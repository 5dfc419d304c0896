import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fieldlake.llm import token_store
from fieldlake.llm.words import mixed, pieces
from helpers import SCHEMA, no_documents, odd_documents, read

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "  ", "a  b", " a", "a ", "a\n b", "a \nb", "a \n b", "\n", "x<|endoftext|>y z", "  \n x", "é è  ü  w",
    "　 x y", "it's  don't", "I'm\n'tis.", "a\t b\t\tc", "12 3,4 5", "日本 語", "a\nb", "a.\nB c", "a.\n\nB", "a\n", "\na", "é.\nx",
    "a’s.\n b", "A.B.\nC!?\nd", "a\r\nb.", "a.\n1", "...\nA", "a  b", " ", "f(x):\n  y;", "don't, can't. We'll\nGo",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_parts_give_the_tokenizers_ids(tokenizer, spark, small_dir):
    texts = TEXTS + [r.text for r in read(spark, small_dir).collect()]
    for limit, most in ((600_000, 1 << 20), (10, 2000)):
        encoder = token_store.Encoder(PATH, limit)
        for first, data, offsets in pieces(pa.array(texts, pa.string()), most):
            ids, counts = encoder.encode(data, offsets)
            for k, own in enumerate(np.split(ids, np.cumsum(counts)[:-1])):
                assert own.tolist() == tokenizer.encode(texts[first + k] or "", add_special_tokens=False).ids, texts[first + k]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 1000])
def test_perfect_hash_is_minimal_and_finds_only_its_keys(n):
    doc_ids = list(range(n))
    ids, counts = np.arange(2 * n, dtype=np.uint32), np.full(n, 2)
    shard = token_store.Shard(token_store.write_shard(doc_ids, ids, counts, 4))
    slots = shard.find(token_store.key_hashes(doc_ids))
    assert sorted(slots.tolist()) == list(range(n))
    assert all(shard.ids(s).tolist() == [2 * k, 2 * k + 1] for k, s in enumerate(slots))
    others = shard.find(mixed(np.arange(10_000, 20_000, dtype=np.uint64)))
    assert (others >= 0).sum() == 0
    with pytest.raises(ValueError):
        token_store.Shard(b"\0" * 64)


def expected(tokenizer, rows):
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip(tokenizer, spark, small_dir):
    docs = read(spark, small_dir).repartition(5)
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = token_store.encode_and_read(docs, PATH, shard_bytes=50_000, shard_docs=7)
    assert sorted(tuple(r) for r in got.collect()) == expected(tokenizer, rows)


def test_odd_rows(tokenizer, spark):
    docs = odd_documents(spark)
    got = [tuple(r) for r in token_store.encode_and_read(docs, PATH).orderBy("start").collect()]
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0)) and len(ids) == docs.count()
    texts = {}
    for r in docs.collect():
        key = expected(tokenizer, [(r.doc_id, r.text)])[0]
        texts.setdefault(r.doc_id, []).append(key[2:])
    assert all(r[2:] in texts[r[0]] for r in got)
    assert [r[1] for r in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))]


def test_no_rows_and_one_shard_of_equal_ids(tokenizer, spark):
    assert token_store.encode_and_read(no_documents(spark), PATH).count() == 0
    same = spark.createDataFrame([(5, "a b", None, None, None)] * 40, SCHEMA)
    got = sorted(tuple(r) for r in token_store.encode_and_read(same, PATH, shard_docs=16).collect())
    assert got == expected(tokenizer, [(5, "a b")] * 40)
