import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from fieldlake.llm import monoid_bpe
from helpers import no_documents, odd_documents, prose, read

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return monoid_bpe.Ranks(monoid_bpe.read_ranks(PATH))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})


def plain_merge(ranks, data):
    """Merges one at a time, looking at every pair."""
    tokens = [data[i : i + 1] for i in range(len(data))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(tokens, tokens[1:])) if a + b in ranks]
        if not pairs:
            return tokens
        i = min(pairs)[1]
        tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]


def runs(count, seed=5):
    draw = random.Random(seed)
    for k in range(count):
        letters = draw.choice(["ab", "the rain", "aA1 .", "etaoinshrdlu", "é日\U0001f600ß", "=-", "a", " \n"])
        yield "".join(draw.choice(letters) for _ in range(draw.choice([1, 2, 5, 17, 40, 90, 300])))


def test_tree_equals_plain_merging(ranks):
    for text in runs(400):
        data = text.encode()
        expected = plain_merge(ranks.ranks, data)
        assert ranks.merge(data) == ranks._long(data) == expected
        for leaf in (1, 3, 16):
            assert monoid_bpe.Ranks(ranks.ranks, leaf).tokens(data) == expected


def test_join_is_associative_for_any_cut(ranks):
    draw = random.Random(9)
    for text in runs(300, 6):
        data = text.encode()
        a, b = sorted((draw.randint(0, len(data)), draw.randint(0, len(data))))
        x, y, z = (ranks.tokens(part) for part in (data[:a], data[a:b], data[b:]))
        assert ranks.join(ranks.join(x, y), z) == ranks.join(x, ranks.join(y, z)) == ranks.tokens(data)


def test_own_small_vocabulary_with_awkward_ranks():
    """Merges whose result merges earlier than they do, and equal pairs that overlap."""
    tokens = [bytes([b]) for b in range(256)] + [b"aa", b"ab", b"aab", b"ba", b"aaa", b"bab", b"abaab", b"bb"]
    for seed in range(30):
        draw = random.Random(seed)
        order = tokens[256:]
        draw.shuffle(order)
        ranks = {t: i for i, t in enumerate(tokens[:256] + order)}
        for _ in range(40):
            data = bytes(draw.choice(b"ab") for _ in range(draw.randint(1, 60)))
            assert monoid_bpe.Ranks(ranks, draw.randint(1, 9)).tokens(data) == plain_merge(ranks, data)


def test_texts_like_the_library(ranks, library, spark, small_dir):
    coder = monoid_bpe.Coder(ranks, public_tokenizers.PATTERN, limit=500)
    texts = [*runs(300, 7), *(r.text or "" for r in read(spark, small_dir).collect()), "a" * 5000, "ab" * 40_000, "日本語" * 9000]
    texts += [prose(3, 30_000), "x \n" * 20_000, "don't  I'll\x85\xa0 <|endoftext|> \r\n\t1234", " " * 70_000 + "end", "\x1c \x1f a"]
    for text in texts:
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_leaves_cut_where_pieces_begin(ranks, monkeypatch):
    monkeypatch.setattr(monoid_bpe, "_TEXT_LEAF", 3)
    coder = monoid_bpe.Coder(ranks, public_tokenizers.PATTERN)
    for text in runs(500, 8):
        parts = list(coder._leaves(text))
        assert "".join(parts) == text
        assert sum((coder.pattern.findall(p) for p in parts), []) == coder.pattern.findall(text)


def test_rows(library, spark):
    docs = odd_documents(spark)
    found = monoid_bpe.decode(monoid_bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "ids", "bytes"]

    def row(r):
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()
        return repr(r.doc_id), ids, (r.text or "").encode()

    assert sorted((repr(r.doc_id), bytes(r.ids), bytes(r.bytes)) for r in found.collect()) == sorted(map(row, docs.collect()))


def test_query(library, spark, small_dir):
    from fieldlake.llm.queries import op11_monoid_bpe

    def digest(r):
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
        return r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()

    found = op11_monoid_bpe(spark, small_dir)
    assert found.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(tuple(r) for r in found.collect()) == sorted(map(digest, read(spark, small_dir).collect()))


def test_no_rows(spark):
    found = monoid_bpe.decode(monoid_bpe.encode(no_documents(spark), PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert found.collect() == []


def test_a_table_without_a_byte_is_refused():
    with pytest.raises(ValueError):
        monoid_bpe.Ranks({b"a": 0})
