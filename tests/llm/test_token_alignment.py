import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fieldlake.llm import token_alignment
from helpers import no_documents, odd_documents, prose, read

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(tokenizers, rows):
    """Whole texts, tokens as byte ranges, links by overlap, counts in one table."""
    a, b = tokenizers
    letters = token_alignment.byte_characters()
    docs, counts = [], collections.Counter()
    for key, text in rows:
        a_ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = b.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
        b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        whole = (" " + text).encode() if text else b""
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a_ids, b_ids, a_bytes, b_bytes = [], [], [], []
        a_ends, b_ends = (np.cumsum([len(x) for x in own]).tolist() for own in (a_bytes, b_bytes))
        links = []
        k = 0
        for i, end in enumerate(a_ends):
            start = end - len(a_bytes[i])
            while k and b_ends[k - 1] > start:
                k -= 1
            while k < len(b_ends) and b_ends[k] - len(b_bytes[k]) < end:
                if b_ends[k] > start:
                    links.append((a_ids[i], b_ids[k]))
                k += 1
        groups, i, j = [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            own_a, own_b = [], []
            while i < len(a_ends) and a_ends[i] <= end:
                own_a.append(str(a_ids[i]))
                i += 1
            while j < len(b_ends) and b_ends[j] <= end:
                own_b.append(str(b_ids[j]))
                j += 1
            groups.append(",".join(own_a) + "|" + ",".join(own_b))
        counts.update(links)
        docs.append((key, len(a_ids), len(b_ids), groups, links))
    highest = collections.defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (key, n_a, n_b, len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for key, n_a, n_b, groups, links in docs
    ], counts


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \n b", "\n", "\t x", "x<|endoftext|>y <s> </s> <unk>", "▁", "a ▁b c", "a▁ b",
    "<0x41> [0x0A]", "日本語 テキスト \U0001f600 é é", "don't I'll 12 345,678", "\x1c a\x1f b \x85 c\xa0 d", "a\x00b", "ﬁ ½ Ａ", "aaaa" * 300, "x " * 500,
    "=" * 90 + " -- " + "*" * 33, "​ ﻿ b", "Ünï cödé  ", "a\r\n b\r\n",
]


def texts():
    draw = random.Random(3)
    for _ in range(150):
        letters = draw.choice(["ab ", "the rain. \n", "aA1 .,  ", "é日\U0001f600ß ", "<|endoftext|> ", "▁ ab", "\t \n\r x"])
        yield "".join(draw.choice(letters) for _ in range(draw.choice([1, 3, 9, 40, 200])))


def test_whole_result_by_brute_force(tokenizers, spark, small_dir):
    own = [(k, t) for k, t in enumerate([*ODD, *texts(), *ODD])] + [(r.doc_id, r.text) for r in read(spark, small_dir).collect()]
    own += [(None, "null key"), (None, "null key"), (5, None)]
    expected, counts = brute(tokenizers, own)
    frame = spark.createDataFrame(own, "doc_id long, text string").repartition(3)
    for options in ({}, {"spill_links": 2000, "fan_in": 3}, {"radix": 0}):
        found = token_alignment.align(frame, A, B, **options)
        assert found.columns == COLUMNS
        assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected)), options
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    pairs = token_alignment.pair_counts(frame, A, B)
    assert {tuple(r) for r in pairs.collect()} == {(a, b, n, n == highest[b]) for (a, b), n in counts.items()}


def test_remembered_parts_change_nothing(tokenizers):
    own = token_alignment.Aligner(A, B, 8, limit=10)
    for text in [*ODD, *texts(), prose(5, 300)]:
        if not text:
            continue
        (numbers,) = own.align([text])
        (key, n_a, n_b, n_groups, n_links, *_), = brute(tokenizers, [(1, text)])[0]
        assert (numbers is None) == (n_a == 0), text
        if numbers is not None:
            assert own.counts[numbers].sum(axis=0).tolist() == [n_a, n_b, n_groups, n_links], text


def test_long_text_counts_by_distinct_part(tokenizers, spark, monkeypatch):
    text = prose(4, 3000)
    expected, _ = brute(tokenizers, [(1, text), (2, "one two")])
    own = token_alignment.Aligner(A, B, 8)
    plain, short = token_alignment.Run(own), token_alignment.Run(own)
    (numbers,) = own.align([text])
    plain.add(1, numbers)
    monkeypatch.setattr(token_alignment, "_LONG", 100)
    short.add(1, numbers)
    assert all((x == y).all() for x, y in zip(plain.records(), short.records()))
    assert plain.rows == short.rows and plain.rows[0][3] == expected[0][4]


def test_pack_keeps_integers():
    for values in ([], [0], [1, 255], [256, 70_000], [2**40, 3], [2**62]):
        (out,) = token_alignment.unpack(token_alignment.pack(np.array(values, dtype=np.int64)))
        assert out.tolist() == values


def test_merge_in_rounds(spark, tmp_path):
    draw = np.random.default_rng(2)
    total, heads = collections.Counter(), []
    for run in range(40):
        pairs = np.unique(draw.integers(0, 300, 50))
        links = draw.integers(1, 9, len(pairs))
        total.update(dict(zip(pairs.tolist(), links.tolist())))
        heads.append((run, 0, bytearray(token_alignment.pack(np.diff(pairs, prepend=0), links))))
    from fieldlake.llm.common import Scratch

    frame = spark.createDataFrame(heads, "run long, bucket int, head binary")
    for fan_in in (2, 7, 64):
        rows = token_alignment.count_pairs(frame, Scratch(spark, f"rounds{fan_in}"), 40, fan_in).collect()
        assert len(rows) == 1
        steps, links = token_alignment.unpack(bytes(rows[0].head))
        assert dict(zip(np.cumsum(steps).tolist(), links.tolist())) == total


def test_odd_rows(tokenizers, spark):
    docs = odd_documents(spark)
    found = token_alignment.align(docs, A, B)
    expected, _ = brute(tokenizers, [(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_no_rows(spark):
    assert token_alignment.align(no_documents(spark), A, B).collect() == []
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, token_alignment.align(empty, A, B).collect())) == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]
