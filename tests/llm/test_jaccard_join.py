import itertools
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldlake.llm import jaccard_join
from fieldlake.llm.jaccard_join import Sets, divide_skip, keep_one, least_overlap, link_components, sketches
from fieldlake.llm.words import text_words
from helpers import SCHEMA, no_documents, odd_documents, odd_texts, prose, read, shingles


def brute(pairs, percent=75):
    """Rows of (doc_id, n_shingles, component_id), by comparing all sets that share a shingle."""
    sets = [(i, frozenset(shingles(t))) for i, t in pairs]
    keys = list(dict.fromkeys((i if i is not None else ("null", s), s) for i, s in sets))
    parent = {k: k for k in range(len(keys))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for k, (_, s) in enumerate(keys):
        for x in s:
            index.setdefault(x, []).append(k)
    met = {p for own in index.values() for p in itertools.combinations(own, 2)}
    same_id = {}
    for k, (i, s) in enumerate(keys):
        if s and not isinstance(i, tuple):
            met.add((same_id.setdefault(i, k), k))
    for a, b in met:
        x, y = keys[a][1], keys[b][1]
        if keys[a][0] == keys[b][0] or 100 * len(x & y) >= percent * len(x | y):
            parent[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(keys):
        if not isinstance(i, tuple):
            least[find(k)] = min(least.get(find(k), i), i)
    number = {key: k for k, key in enumerate(keys)}
    out = []
    for i, s in sets:
        k = number[(i if i is not None else ("null", s), s)]
        out.append((i, len(s), least.get(find(k)) if s else i))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.lists(st.sets(st.integers(0, 60), min_size=1), max_size=12), st.integers(1, 100))
def test_divide_skip_finds_what_reaches_its_need(query, others, percent):
    query = np.array(sorted(query), dtype=np.uint64)
    sets = [np.array(sorted(x), dtype=np.uint64) for x in others]
    needs = np.array([least_overlap(len(query), len(x), percent) for x in sets], dtype=np.int64)
    exact = [len(np.intersect1d(query, x)) for x in sets]
    assert divide_skip(query, sets, needs).tolist() == [n if n >= need else 0 for n, need in zip(exact, needs)]


def test_same_components_as_brute_force(spark, small_dir):
    docs = read(spark, small_dir)
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = ordered(link_components(docs).collect())
    assert got == ordered(brute(pairs)) and any(r[0] != r[2] for r in got)


def test_groups_of_copies_chains_and_shared_passages(spark):
    base, passage = prose(5, 120).split(), prose(6, 40)
    pairs = [(k, prose(100 + k, 30) + " " + passage) for k in range(40)]
    for k in range(60):  # copies with an own word each, and a chain that drifts away
        words = list(base)
        words[(k * 7) % 120] = f"own{k}"
        pairs.append((1000 + k, " ".join(words)))
        pairs.append((2000 + k, " ".join(base[k : 60 + k])))
    pairs += [(3000 + k, " ".join(base)) for k in range(30)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], SCHEMA).repartition(7)
    assert ordered(link_components(docs).collect()) == ordered(brute(pairs))
    assert ordered(link_components(docs, rounds=0).collect()) == ordered(brute(pairs))
    kept = {r.doc_id for r in keep_one(docs).collect()}
    assert kept == {i for i, _, c in brute(pairs) if i == c}


def test_cells_of_small_blocks_find_the_same(spark, monkeypatch):
    """A list over many blocks and divisions: its pairs meet in exactly those cells that hold both."""
    monkeypatch.setattr(jaccard_join, "_CELL", 3)
    monkeypatch.setattr(jaccard_join, "_PAIRS", 5)
    passage = prose(6, 60)
    pairs = [(k, prose(100 + k, 4 + k % 30) + " " + passage) for k in range(50)]
    pairs += [(100 + k, passage + " " + prose(300 + k, 1 + k % 9)) for k in range(30)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], SCHEMA).repartition(5)
    assert ordered(link_components(docs, rounds=0).collect()) == ordered(brute(pairs))
    assert ordered(link_components(docs, percent=100, rounds=0).collect()) == ordered(brute(pairs, 100))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=300), st.lists(st.integers(0, 400), max_size=300))
def test_sketches_never_differ_more_than_the_sets(a, b):
    texts = pa.array([" ".join(f"w{x}" for x in own) for own in (a, b)])
    (_, words, places), = text_words(texts)
    sets = Sets(words, places, 5)
    x, y = sketches(sets, np.array([0, 1]))
    apart = int(np.bitwise_count(x ^ y).sum())
    exact = len(np.setxor1d(sets.of(0), sets.of(1)))
    assert apart <= exact and apart % 2 == exact % 2


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert ordered(link_components(docs).collect()) == ordered(brute(odd_texts()))
    kept = keep_one(docs)
    assert kept.schema == docs.schema and kept.where("doc_id = 3").count() == 0 and kept.where("doc_id is null").count() == 3


def test_no_rows(spark):
    docs = no_documents(spark)
    assert link_components(docs).count() == 0 and keep_one(docs).schema == docs.schema and keep_one(docs).count() == 0


def test_candidates_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    """Near copies of one text: what is compared is a few pairs of each, though nearly every two of them link."""
    base, pairs, compared = prose(5, 120).split(), [], []
    for k in range(150):
        words = list(base)
        words[(k * 7) % 120] = f"own{k}"
        pairs.append((k, " ".join(words)))
    compare = jaccard_join._compare
    monkeypatch.setattr(jaccard_join, "_compare", lambda pairs, *rest: compared.append(pairs.count()) or compare(pairs, *rest))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], SCHEMA).repartition(4)
    assert ordered(link_components(docs, rounds=0).collect()) == ordered(brute(pairs))
    assert 0 < sum(compared) <= 6 * len(pairs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 900), max_size=900), min_size=2, max_size=6))
def test_folded_sketches_never_differ_more_than_the_sets(several):
    texts = pa.array([" ".join(f"w{x}" for x in own) for own in several])
    (_, words, places), = text_words(texts)
    sets = Sets(words, places, 5)
    whole = sketches(sets, np.arange(len(several)))
    small = jaccard_join.Sketches(pa.array([jaccard_join.folded(x, n).tobytes() for x, n in zip(whole, sets.sizes.tolist())], pa.binary()))
    x, y = (v.ravel() for v in np.indices((len(several), len(several))))
    exact = np.array([len(np.setxor1d(sets.of(i), sets.of(j))) for i, j in zip(x, y)])
    apart = small.differ(x, y)
    assert (apart <= exact).all() and (apart % 2 == exact % 2).all()
    assert all(64 * w <= max(256, 2 * n) for w, n in zip(small.words.tolist(), sets.sizes.tolist()))


def test_postings_without_candidates_leave_after_one_search(spark, monkeypatch):
    """Texts of the same passages in other choices share lists but do not link; of them and some near copies only the copies are searched again."""
    rng, base = random.Random(1), prose(5, 120).split()
    pool = [prose(500 + k, 30) for k in range(30)]
    pairs = [(k, " ".join(rng.sample(pool, 6))) for k in range(60)]
    for k in range(20):
        words = list(base)
        words[(k * 7) % 120] = f"own{k}"
        pairs.append((1000 + k, " ".join(words)))
    searched, search = [], jaccard_join._search
    monkeypatch.setattr(jaccard_join, "_search", lambda lists, *rest: searched.append(lists.select("node").distinct().count()) or search(lists, *rest))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], SCHEMA).repartition(4)
    assert ordered(link_components(docs, rounds=0).collect()) == ordered(brute(pairs))
    assert searched[0] > 60 and sum(searched[1:]) <= 25, searched
