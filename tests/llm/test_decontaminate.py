import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldlake.llm import decontaminate
from fieldlake.llm.common import gather_tables
from fieldlake.llm.words import hash_word
from helpers import SCHEMA, no_documents, odd_documents, plain, prose, read


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [max(row[k], out) for k, out in enumerate(_step(row, x, b), 1)]
    return row[-1]


def _step(row, x, b):
    left = 0
    for k, y in enumerate(b):
        left = row[k] + 1 if x == y else max(left, row[k + 1])
        yield left


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=30))
def test_common_subsequence(a, b):
    got = decontaminate.common_subsequence(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
    assert got == longest_common(a, b)


def holds(words, item):
    return any(words[k : k + len(item)] == item for k in range(len(words) - len(item) + 1))


def test_every_verbatim_item_is_found_and_nothing_else(spark, small_dir):
    docs, bench = read(spark, small_dir), read(spark, small_dir, "benchmark")
    items = {r.item_id: plain(r.text) for r in bench.collect()}
    texts = {r.doc_id: plain(r.text) for r in docs.collect()}
    expected = {(d, i) for d, words in texts.items() for i, item in items.items() if holds(words, item)}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert len(expected & got) >= 0.9 * len(expected) and expected
    # Anything else that is found shares most of an item's words in order.
    for d, i in got - expected:
        assert longest_common(items[i], texts[d]) >= 0.6 * len(items[i])


def planted(spark, n_items=12):
    items = [(k, prose(500 + k, 15 + 5 * k)) for k in range(n_items)]
    rows = []
    for k, (_, text) in enumerate(items):
        words = text.split()
        near = " ".join("x" if j % 9 == 4 else w for j, w in enumerate(words))
        rows.append((2 * k, f"{prose(900 + k, 300)} {text.upper()} {prose(950 + k, 200)}"))
        rows.append((2 * k + 1, f"{prose(700 + k, 40 * k)} {near} {prose(750 + k, 100)}"))
    rows += [(1000 + k, prose(2000 + k, 250)) for k in range(80)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    return docs, spark.createDataFrame(items, "item_id long, text string")


def test_verbatim_and_reworded_items(spark):
    docs, bench = planted(spark)
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, bench).collect()}
    expected = {(2 * k + j, k) for k in range(12) for j in range(2)}
    assert len(expected & set(got)) >= 0.9 * len(expected) and set(got) <= expected
    assert {(2 * k, k) for k in range(12)} <= set(got)
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench, block=5).collect()}
    assert {(2 * k, k) for k in range(12)} <= blocks <= expected
    kept = {r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in got}


def test_latent_search_against_all_cosines(spark):
    """Candidates of the latent search hold at least nine tenths of those of plain TF-IDF cosine."""
    docs, bench = planted(spark)
    items = decontaminate.items_of(*zip(*[(r.item_id, r.text) for r in bench.collect()]))
    rules = decontaminate.Rules()
    decontaminate.prepare(docs, items, rules)
    full = np.eye(len(items.idf)) * items.idf
    hits = found = 0
    for _, words, places in decontaminate.text_words(pa.array([r.text for r in docs.collect()]), decontaminate.PLAIN):
        features = items.vocabulary.features(words)
        bounds, known, first = decontaminate.half_windows(features, places, rules.half)

        def cosines(basis):
            windows = decontaminate.windows_of(decontaminate.sums_of(basis.astype(np.float32), known, bounds), first)
            own = np.stack([basis[items.vocabulary.features(x)].sum(axis=0) for x in items.words])
            norms = np.linalg.norm(windows, axis=1)[:, None] * np.linalg.norm(own, axis=1)
            return windows @ own.T / np.maximum(norms, 1e-9)

        exact, latent = cosines(full) >= rules.cosine, cosines(items.basis) >= rules.cosine - 1e-6
        hits, found = hits + exact.sum(), found + (exact & latent).sum()
    assert hits and found >= 0.9 * hits


def test_odd_rows(spark):
    docs = odd_documents(spark)
    bench = spark.createDataFrame([(1, prose(2, 60)), (1, prose(2, 60)), (2, None), (3, ""), (4, "..."), (None, prose(3, 50)), (5, prose(2, 60))], "item_id long, text string")
    got = sorted((tuple(r)[:2] for r in decontaminate.leaks(docs, bench).collect()), key=repr)
    first = [(d, i) for d in (1, 2, 2, 3) for i in (1, 5)]
    assert got == sorted(first + [(None, None)] * 2, key=repr)
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.schema == docs.schema and kept.count() == docs.count() - 6


def test_no_rows(spark):
    docs, bench = planted(spark, 2)
    none, no_items = no_documents(spark), bench.limit(0)
    assert decontaminate.leaks(none, bench).count() == 0 == decontaminate.leaks(docs, no_items).count()
    assert decontaminate.keep_clean(docs, no_items).count() == docs.count() and decontaminate.keep_clean(none, bench).count() == 0


def test_verbatim_items_of_any_length_are_found(spark):
    """Items of 5 to 1,000 words, whole, at every place of a half-window, among words of other items."""
    lengths = [5, 6, 8, 12, 20, 31, 32, 33, 48, 64, 100, 128, 200, 300, 400, 500, 700, 850, 1000]
    items = [(k, prose(3000 + k, n)) for k, n in enumerate(lengths)]
    common = " ".join(t for _, t in items).split()
    rng = np.random.default_rng(8)
    rows = []
    for k, text in items:
        around = [" ".join(rng.choice(common, 60 + 5 * k)), " ".join(rng.choice(common, 90))]
        rows += [(10 * k, f"{around[0]} {text} {around[1]}"), (10 * k + 1, text), (10 * k + 2, around[0])]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, bench).collect()}
    expected = {(10 * k + j, k) for k in range(len(items)) for j in range(2)}
    assert expected <= set(got)
    assert all(got[x].share == 1.0 for x in expected)
    kept = {r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()}
    assert not kept & {d for d, _ in expected}


def test_long_items_are_met_by_their_windows(spark):
    """Each window of a long item is compared, so a reworded copy of it is found where cosine with the whole is low."""
    docs, _ = planted(spark, 2)
    items = decontaminate.items_of([1, 2], [prose(4000, 500), prose(4001, 20)])
    rules = decontaminate.Rules()
    decontaminate.prepare(docs, items, rules)
    assert np.bincount(items.owners).tolist() == [1 + 31, 1]
    # The mark is taken away by the edit: every sixth word is another.
    words = ["q" + w if j % 6 == 3 or j == 0 else w for j, w in enumerate(prose(4000, 500).split())]
    text = f"{prose(4100, 200)} {' '.join(words)} {prose(4101, 150)}"
    assert [r[:2] for r in decontaminate.find(items, rules, pa.array([text]))] == [(0, 0)]


def test_the_basis_comes_from_every_window_of_every_document(spark):
    """Also of copies and of documents beyond any sample; the matrix and the products by rounds are the same."""
    texts = [" ".join(f"w{(i * 7 + k * k) % 13}" for k in range(5 * i % 90)) for i in range(3000)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    items = decontaminate.items_of([1, 2], ["w1 w2 w3 w4 w5 w6 w2", "w7 w8 w9 w1"])
    half = 4
    expected = np.zeros((len(items.vocabulary.hashes),) * 2)
    for text in texts:
        words = [hash_word(w) for w in (text or "").split()]
        for at in range(0, len(words), half):
            own = items.vocabulary.features(np.array(words[at : at + 2 * half], np.uint64))
            counts = np.bincount(own[own >= 0], minlength=len(expected))
            expected += np.outer(counts, counts)
    found = decontaminate.window_matrix(docs, items, half)
    assert np.array_equal(decontaminate._matrix_product(found, np.eye(len(expected))), expected)
    items.idf = np.ones(len(expected), np.float32)
    one = decontaminate.latent_basis(docs, items, half=half, rank=4)
    other = decontaminate.latent_basis(docs, items, half=half, rank=4, cells=0)
    assert np.allclose(one @ one.T, other @ other.T, atol=1e-3)


def test_order_is_looked_at_only_where_enough_of_an_item_stands(monkeypatch):
    """With every window a candidate, only those with enough words of the item pass to the search for its order; leaks stay."""
    items = decontaminate.items_of([1, 2], [prose(900, 40), prose(901, 12)])
    size = len(items.vocabulary.hashes)
    monkeypatch.setattr(decontaminate, "document_counts", lambda docs, items: (np.ones(size, np.int64), 50))
    monkeypatch.setattr(decontaminate, "window_matrix", lambda *_: np.zeros(size * (size + 1) // 2, np.uint64))
    rules = decontaminate.Rules(cosine=-2.0)
    decontaminate.prepare(None, items, rules)
    texts = [prose(k, 200) for k in range(20)] + [prose(30, 50) + " " + prose(900, 40) + " " + prose(31, 50), None, ""]
    asked, real = [], decontaminate.common_subsequence
    monkeypatch.setattr(decontaminate, "common_subsequence", lambda a, b: asked.append(np.isin(a, b).mean()) or real(a, b))
    found = decontaminate.find(items, rules, pa.array(texts))
    assert (20, 0) in {(row, item) for row, item, *_ in found}
    assert asked and min(asked) >= rules.maybe


def test_tables_are_filled_from_runs_of_the_asked_size(spark):
    texts = [prose(k, 400) for k in range(60)]

    def fill(tables, data, offsets):
        tables[0][0] += np.uint64(len(data) > 1 << 14)
        tables[0][1] += np.uint64(len(data))

    over, seen = gather_tables(spark.createDataFrame([(x,) for x in texts], "text string").coalesce(1), [16], fill, 1 << 14)[0][:2]
    assert over == 0 and seen == sum(map(len, texts))
