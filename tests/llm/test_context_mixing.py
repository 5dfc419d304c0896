import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldlake.llm import context_mixing as cm
from fieldlake.llm.words import hash_word
from helpers import SCHEMA, no_documents, odd_documents, odd_texts, prose, read, spaced


def held(doc_id):
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def base_scores(rows):
    tokens = [(i, [*spaced(t), "\0end"]) for i, t in rows]
    counts = Counter(w for i, words in tokens if not held(i) for w in words)
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, words in tokens:
        score = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        out.append((i, held(i), len(words), sum(counts[w] > 0 for w in words), total, score))
    return out


def key(row):
    return (row[0] is None, row[0] or 0, row[5])


@pytest.fixture(scope="module")
def scored(spark, small_dir):
    docs = read(spark, small_dir)
    return docs, cm.score(docs, frequent=200).collect()


def test_base_score_as_by_brute_force(scored):
    docs, rows = scored
    expected = sorted(base_scores([(r.doc_id, r.text) for r in docs.collect()]), key=key)
    got = sorted((tuple(r) for r in rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in expected])


def test_the_model_beats_the_base_on_what_it_learned_and_is_a_probability(scored):
    _, rows = scored
    learned = [r for r in rows if not r.held_out]
    assert sum(r.score for r in learned) > sum(r.base_score for r in learned)
    assert all(r.score < 0 for r in rows) and all(r.bits_per_byte > 0 for r in rows)


@pytest.mark.parametrize("counts", [[5], [5, 1], [1, 1, 1, 1], [100, 50, 20, 7, 3, 1, 1]])
def test_code_is_complete_and_prefix_free(counts):
    starts, nodes, bits = cm.huffman(np.array(counts))
    lengths = np.diff(starts)
    words = ["".join(map(str, bits[a:b])) for a, b in zip(starts[:-1], starts[1:])]
    assert len(set(words)) == len(words) and not any(a != b and b.startswith(a) for a in words for b in words)
    assert len(counts) == 1 or sum(2.0 ** -int(n) for n in lengths) == 1
    assert set(nodes.tolist()) == set(range(len(counts) - 1))


def test_symbols_of_a_place_sum_to_one():
    """Whatever the tables say, the chances of all next symbols add up to 1."""
    words = [f"w{k}" for k in range(6)]
    hashes = np.array([hash_word(w) for w in words], dtype=np.uint64)
    code = cm.Code(cm.Vocabulary(hashes), np.array([9, 7, 5, 3, 2, 1]), 40, 12, 4, power=8)
    rng = np.random.default_rng(0)
    mixer = cm.Mixer(code, [rng.normal(size=256).astype(np.float32) for _ in cm.CONTEXTS],
                     [rng.integers(0, 4, 256).astype(np.int8) for _ in range(2)],
                     rng.normal(size=(cm._GATES, len(cm.CONTEXTS) + 1)).astype(np.float32), rate=0.0)

    def chance(text):
        (_, own, places), = cm.text_words(pa.array([text]))
        return 10 ** mixer.log10_probability(cm.steps_of(code, own, places))[0]

    # With one more word: all continuations of "w1" by a symbol and then the end, over the chance of "w1" without its end.
    after = sum(chance(f"w1 {w}") / last for w in [*words, "unknown"] for last in [_end(mixer, code, f"w1 {w}")])
    start = chance("w1") / _end(mixer, code, "w1")
    assert after + chance("w1") == pytest.approx(start)


def _end(mixer, code, text):
    (_, own, places), = cm.text_words(pa.array([text]))
    steps = cm.steps_of(code, own, places)
    n = int(np.diff(code.starts)[code.end])
    inputs, gate = mixer.inputs(steps)
    z = np.einsum("ij,ij->i", inputs, mixer.weights[gate])[-n:]
    return float(np.prod(1 / (1 + np.exp(np.where(steps.bit[-n:] > 0, -z, z)))))


def test_spelling_is_a_distribution_over_characters():
    texts = pa.array(["banana bandana cabana", "ban can"])
    size = 1 << cm._SPELL_POWER
    tables = [np.zeros(size, np.uint32) for _ in range(2 * len(cm.ORDERS))]
    for _, data, offsets in cm.pieces(texts):
        starts, ends, _ = cm.word_bounds(data, offsets)
        for k, pair in enumerate(cm.spelling_slots(data, starts, ends)[1]):
            for table, own in zip(tables[2 * k : 2 * k + 2], pair):
                table += np.bincount(own, minlength=size).astype(np.uint32)

    def log10(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return cm.spelling_log10(tables, data, np.array([0]), np.array([len(data)]))[0]

    assert log10("banana") > log10("bxnana") and log10("ban") > log10("nab")
    assert sum(10 ** log10(x) for x in ("banana", "bandana", "cabana", "ban", "can", "cana", "bana", "z")) < 1


def test_texts_do_not_depend_on_their_neighbours(spark, small_dir):
    docs = read(spark, small_dir).withColumn("held_out", F.lit(False))
    counts = cm.word_counts(docs, cm.spelling_tables(docs)).cache()
    mixer = cm.fit(docs, counts, frequent=100)
    mixer.rate = 0.02
    texts = [r.text for r in docs.limit(25).collect()]

    def run(part):
        (_, words, places), = cm.text_words(pa.array(part), most=1 << 24)
        return mixer.log10_probability(cm.steps_of(mixer.code, words, places))

    assert np.allclose(run(texts), np.concatenate([run([t]) for t in texts]), rtol=1e-4)


def test_the_same_whatever_the_partitions(spark, scored, small_dir):
    """Every document keeps its own score when the input is no plain file scan, however it is dealt out."""
    docs, rows = scored
    dealt = sorted((tuple(r) for r in cm.score(docs.repartition(12), frequent=200).collect()), key=key)
    rows = sorted((tuple(r) for r in rows), key=key)
    assert [r[:5] for r in dealt] == [r[:5] for r in rows]
    for at in (5, 6):
        assert [r[at] for r in dealt] == pytest.approx([r[at] for r in rows], rel=1e-3)


def test_counts_beyond_32_bits_do_not_wrap():
    table = np.array([0, 3, 2**32 - 1, 2**33 + 5], dtype=np.uint64)
    for own in (table, table[:3]):
        data = cm._packed(0, 0, 0, own).column(3)[0].as_py()
        assert cm._unpacked(data).tolist() == own.tolist()
    assert (cm._unpacked(data) + cm._unpacked(data)).tolist() == [0, 6, 2**33 - 2]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    expected = sorted(base_scores(odd_texts()), key=key)
    got = sorted((tuple(r) for r in cm.score(docs, frequent=20).collect()), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in expected])
    assert all(r[6] <= 0 for r in got) and sum(r[7] is None for r in got) == sum(not t for _, t in odd_texts())


def test_no_rows_and_nothing_to_learn_from(spark):
    assert cm.score(no_documents(spark)).count() == 0
    ids = [k for k in range(60) if held(k)]
    docs = spark.createDataFrame([(k, prose(k, 9), None, None, None) for k in ids], SCHEMA)
    rows = cm.score(docs).collect()
    assert len(rows) == len(ids) and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)


def test_tables_and_weights_use_every_training_document(spark):
    """Also more documents than any sample: those set apart for the weights are all used, and counted in the end."""
    texts = [prose(k, 6) for k in range(12_000)]
    docs = spark.createDataFrame([(k, t, False) for k, t in enumerate(texts)], "doc_id long, text string, held_out boolean").repartition(4)
    counts = cm.word_counts(docs, cm.spelling_tables(docs.limit(50))).cache()
    tuned, tune = [], cm.Mixer.tune

    def noted(self, own, **options):
        tuned.append(own.count())
        return tune(self, own, **options)

    cm.Mixer.tune = noted
    try:
        mixer = cm.fit(docs, counts, frequent=50, power=12)
    finally:
        cm.Mixer.tune = tune
    assert tuned[0] > 1024
    whole = cm.count_tables(docs.select("text"), mixer.code)
    assert all(np.array_equal(a, b) for a, b in zip(mixer.odds, cm._read_off(whole)[0]))


def test_spelling_tables_travel_in_few_bytes():
    assert cm._narrow(np.array([0, 255], np.uint64)).dtype == np.uint8
    assert cm._narrow(np.array([0, 2**32], np.uint64)).tolist() == [0, 2**32]
