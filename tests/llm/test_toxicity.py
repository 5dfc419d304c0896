import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import plan
from fieldlake.llm import toxicity
from fieldlake.llm.words import PLAIN, pieces, prefix_hashes, word_bounds, word_hashes
from helpers import SCHEMA, no_documents, odd_documents, prose

BAD = {"en": ["grumfle", "grumfling", "snarkel"], "de": ["grübelß", "grübelßen", "snörkel"]}


def labelled(spark, n=900):
    docs, labels = [], []
    for k in range(n):
        words = prose(k, 20 + k % 80).split()
        lang = "de" if k % 3 == 0 else "en"
        if lang == "de":
            words = [w.replace("u", "ü") for w in words]
        toxic = k % 5 == 0
        if toxic:
            words[len(words) // 2] = BAD[lang][k % 3]
            words[1] = BAD[lang][(k + 1) % 3]
        docs.append((k, " ".join(words), lang, "s", 0))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = labelled(spark)
    return docs, labels, toxicity.fit(docs, labels)


def test_held_out_documents_are_told_apart(spark, fitted):
    docs, labels, net = fitted
    rows = toxicity.score(docs, net).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 200
    hits = [r.predicted == r.toxic for r in held]
    assert np.mean(hits) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    kept = {r.doc_id for r in toxicity.keep_clean(docs, net).collect()}
    assert kept == {r.doc_id for r in rows if not r.predicted}


def test_the_sample_holds_no_held_out_rows_and_no_order(spark):
    docs, labels = labelled(spark, 300)
    texts, toxic = toxicity.training_sample(docs, labels, per_label=20)
    again = toxicity.training_sample(docs.repartition(9), labels.repartition(3), per_label=20)
    assert texts == again[0] and toxic.tolist() == again[1].tolist() and sorted(toxic.tolist()) == [0] * 20 + [1] * 20
    held = {r.text for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert not held & set(texts)


def test_pooling_is_the_largest_window_of_each_filter():
    net = toxicity.Network(rows=64, dim=4, filters=3)
    (_, words, starts, _), = toxicity.runs(toxicity.pa.array(["a b c", "", "d", "e f"]))
    net.start(words.ravel())
    places = net.places(words)
    got, best, vectors = net.pooled(places, starts, argmax=True)
    for text in range(4):
        for k, width in enumerate(net.widths):
            windows = [
                sum(vectors[at + i] @ net.kernels[k][i] for i in range(width))
                for at in range(starts[text], starts[text + 1] - width + 1)
            ]
            expected = np.maximum(np.max(windows, axis=0), 0) if windows else np.zeros(3)
            assert np.allclose(got[text, 3 * k : 3 * k + 3], expected, atol=1e-6)
    assert (best[1] == -1).all()


def test_gradients_match_differences():
    net = toxicity.Network(rows=32, dim=3, filters=2)
    (_, words, starts, _), = toxicity.runs(toxicity.pa.array(["a b c d", "e f g", "a c"]))
    net.start(words.ravel())
    places, labels, weight = net.places(words), np.array([1, 0, 1]), np.ones(3)

    def loss():
        z = net.raw(places, starts)
        return float(np.mean(np.logaddexp(0, np.where(labels == 1, -z, z))))

    before = loss()
    squares = {"out": np.full_like(net.out, 1e-3), "tables": [np.full(net.rows + 1, 1e-3, np.float32) for _ in net.tables],
               "kernels": [np.full_like(x, 1e-3) for x in net.kernels], "biases": [np.full_like(x, 1e-3) for x in net.biases]}
    for _ in range(40):
        toxicity._step(net, squares, places, starts, labels, weight, 0.05)
    assert loss() < 0.3 * before
    assert all((table[-1] == 0).all() for table in net.tables)


def test_odd_rows_and_labels(spark, fitted):
    docs = odd_documents(spark)
    net = fitted[2]
    rows = toxicity.score(docs, net).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5, 6)}) == 1
    assert toxicity.keep_clean(docs, net).schema == docs.schema
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (99, 1), (3, None)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is not None


def test_no_rows_or_one_label_only(spark):
    docs, labels = labelled(spark, 30)
    none = no_documents(spark)
    constant = toxicity.fit(none, labels.limit(0))
    assert toxicity.score(none, constant).count() == 0
    assert {r.predicted for r in toxicity.score(docs, constant).collect()} == {0}
    assert toxicity.keep_clean(docs, toxicity.fit(docs, labels.where("toxic = 0"))).count() == 30


def test_every_labelled_document_is_learned_from(spark):
    """A word that only documents beyond 3,000 of a label have is learned, in several shards."""
    texts = [(k, f"good day number {'vile' if k % 2 else 'nice'} {'zzz' if k % 9 == 1 else 'plain'}", k % 2) for k in range(16_000)]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t, _ in texts], SCHEMA).repartition(4)
    labels = spark.createDataFrame([(k, x) for k, _, x in texts], "doc_id long, toxic int")
    rows = toxicity.labelled(docs, labels, shard_rows=2000)
    n = labels.where(toxicity.fold_of("doc_id", 3) != 1).count()
    assert rows.count() == n > 10_000 and rows.select("shard").distinct().count() == -(-n // 2000)
    net = toxicity.fit(docs, labels, shard_rows=2000, epochs=3, starts_at_most=1)
    wrong = toxicity.score(docs, net).join(labels, "doc_id").where("predicted <> toxic").count()
    assert wrong == 0


def test_states_travel_without_loss_and_small(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 0.2, 8 * 4000).astype(np.float32)
    base[:3] = [0.0, -0.0, 1e-30]
    own = [base.copy() for _ in range(5)]
    for k, x in enumerate(own):
        x.reshape(-1, 8)[40 * k : 40 * k + 400] += rng.normal(0, 0.1, (400, 8)).astype(np.float32)
    sent = [toxicity._packed(x, 1, base) for x in own]
    assert all((toxicity._unpacked(x, 1, base).view(np.uint32) == y.view(np.uint32)).all() for x, y in zip(sent, own))
    total = sum(x.astype(np.float64) for x in own).astype(np.float32)
    packed = toxicity._packed(total, 5, base)
    assert (toxicity._unpacked(packed, 5, base).view(np.uint32) == total.view(np.uint32)).all()
    assert max(map(len, [*sent, packed])) < base.nbytes / 5


def test_only_labelled_texts_are_shuffled_and_stored_once(spark, monkeypatch):
    docs, labels = labelled(spark, 300)
    joins = []
    inner = toxicity.Scratch.put
    monkeypatch.setattr(toxicity.Scratch, "put", lambda self, df, name, *a: joins.append(plan(df)) or inner(self, df, name, *a))
    scratch = toxicity.Scratch(spark, "toxic")
    rows = toxicity.labelled(docs, labels.where("doc_id < 100"), scratch=scratch)
    assert "BroadcastHashJoin" in joins[-1] and "SortMergeJoin" not in joins[-1]
    assert scratch.names == ["known", "shards"] and 0 < rows.count() < 100
    scratch.keep_only()


def test_keys_and_languages_come_from_one_pass_over_the_bytes():
    """Prefixes are hashed like words; languages are those of a plain count of letters, the first of equals."""
    texts = ["", "plain words", "Äpfel über alles", "déjà vu ñ", "ñ ä", "¿qué? ¡sí! é", "日本 ö", "x" * 9 + " " + "É" * 3, "½ Å ç"]
    (_, keys, starts, languages), = toxicity.runs(pa.array(texts))
    plain = []
    for text in texts:
        counts = {lang: sum(text.count(x) for x in letters) for lang, letters in toxicity.LETTERS.items()}
        plain.append(max(counts, key=counts.get) if max(counts.values()) else "other")
    assert languages == plain
    (_, data, offsets), = pieces(pa.array(texts))
    begin, end, _ = word_bounds(data, offsets, PLAIN)
    ends = [end, np.minimum(end, begin + 4), np.minimum(end, begin + 5)]
    for own, several in zip(ends, prefix_hashes(data, begin, ends)):
        assert several.tolist() == word_hashes(data, begin, own).tolist()
    assert len(keys) == len(begin) and starts[-1] == len(begin)
