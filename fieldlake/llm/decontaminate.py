"""Benchmark passages in documents, also reworded: latent semantic retrieval, then exact checks.

1. Features are the benchmark's words, weighted by their inverse document frequency in all
   documents. Passages are windows of words; each window is two neighbouring half-windows.
2. A randomised SVD of the TF-IDF windows of all documents and of the benchmark gives the
   latent basis; Spark adds up the products of its power iterations.
3. Every window of every document is projected and compared by cosine with every item, as a
   whole and with each of its own windows if it is longer than one. Where an item's rarest word
   stands in a document with the item's first and last word in their places, the item is a
   candidate whatever its cosine, so no copy word for word is missed.
4. A candidate is a leak if the longest common subsequence of words with the item is long, or
   is fairly long and the item's answer, its rarest words, is there too.

The benchmark is a stated query set; it is taken in blocks of `block` items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.common import gather_tables
from fieldlake.llm.words import PLAIN, U64, text_words, word_bounds, word_hashes

_SLOTS = 1 << 20
#: Bytes of texts that are worked on at once: what a task holds besides its tables grows with them.
_RUN_BYTES = 1 << 17


class Vocabulary:
    """Word hash -> feature number by two probes; -1 for other words."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.tables = [np.full(_SLOTS, -1, dtype=np.int32) for _ in range(2)]
        left = np.arange(len(self.hashes))
        for table, shift in zip(self.tables, (0, 22)):
            slots = self._slot(self.hashes[left], shift)
            table[slots] = left
            left = left[table[slots] != left]
        self.rest = dict(zip(self.hashes[left].tolist(), left.tolist()))

    def __reduce__(self):
        # Tasks make the tables anew: 8 MB that need not travel.
        return Vocabulary, (self.hashes,)

    @staticmethod
    def _slot(words: np.ndarray, shift: int) -> np.ndarray:
        return ((words >> U64(shift)) & U64(_SLOTS - 1)).astype(np.int64)

    def features(self, words: np.ndarray) -> np.ndarray:
        out = np.full(len(words), -1, dtype=np.int32)
        for table, shift in zip(self.tables, (0, 22)):
            found = table[self._slot(words, shift)]
            same = found >= 0
            same[same] = self.hashes[found[same]] == words[same]
            out[same] = found[same]
        for word, feature in self.rest.items():
            out[words == U64(word)] = feature
        return out


@dataclass
class Marks:
    """Items by the feature of their rarest word (`items` within `bounds`); its first place, and size, first and last word by item."""

    items: np.ndarray
    bounds: np.ndarray
    place: np.ndarray
    size: np.ndarray
    first: np.ndarray
    last: np.ndarray


@dataclass
class Items:
    """A block of benchmark items: ids, word hashes of each, and what scores them."""

    ids: list
    words: list[np.ndarray]
    vocabulary: Vocabulary
    idf: np.ndarray | None = None
    basis: np.ndarray | None = None
    vectors: np.ndarray | None = None
    owners: np.ndarray | None = None
    answers: list[np.ndarray] | None = None
    features: list[np.ndarray] | None = None
    marks: Marks | None = None


def items_of(ids: list, texts: list[str | None]) -> Items:
    """Items without words are left out: nothing can leak them."""
    words = []
    for _, hashes, places in text_words(pa.array(texts, pa.large_string()), PLAIN):
        words += [hashes[a:b] for a, b in zip(places[:-1], places[1:])]
    full = [i for i, x in enumerate(words) if len(x)]
    own = [words[i] for i in full]
    return Items([ids[i] for i in full], own, Vocabulary(np.concatenate(own) if own else np.zeros(0, np.uint64)))


def document_counts(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """Documents that have each feature, and all documents: over the whole table."""
    size = len(items.vocabulary.hashes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            seen += batch.num_rows
            for _, words, places in text_words(batch.column(0), PLAIN, _RUN_BYTES):
                features = items.vocabulary.features(words)
                owner = np.repeat(np.arange(len(places) - 1), np.diff(places))
                known = features >= 0
                pairs = np.zeros((len(places) - 1) * size if (len(places) - 1) * size < 1 << 24 else 0, dtype=bool)
                code = owner[known] * size + features[known]
                if len(pairs):
                    pairs[code] = True
                    total += pairs.reshape(-1, size).sum(axis=0)
                else:
                    total += np.bincount(np.unique(code) % size, minlength=size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(size), -1)), pa.array(np.append(total, seen))], names=["feature", "n"]
        )

    rows = docs.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = rows.toPandas()
    out = np.zeros(size + 1, dtype=np.int64)
    out[found["feature"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out[:-1], int(out[-1])


def half_windows(features: np.ndarray, places: np.ndarray, half: int):
    """Half-windows of each text: (first known word of each half, feature ids, halves per text)."""
    halves = -(-np.diff(places) // half)
    first_half = np.concatenate([[0], np.cumsum(halves)])
    owner = np.repeat(np.arange(len(halves)), np.diff(places))
    which = first_half[owner] + (np.arange(len(features)) - places[owner]) // half
    known = features >= 0
    bounds = np.searchsorted(which[known], np.arange(first_half[-1] + 1))
    return bounds, features[known], first_half


def sums_of(basis: np.ndarray, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the basis rows of each half-window: first words of all, then second words, and so on."""
    count = np.diff(bounds)
    order = np.argsort(-count, kind="stable")
    first, fewer = bounds[:-1][order], -count[order]
    total = np.zeros((len(count), basis.shape[1]), dtype=np.float32)
    for k in range(int(count.max(initial=0))):
        # Half-windows with more than k words come first in this order.
        n = int(np.searchsorted(fewer, -k, "left"))
        total[:n] += basis.take(features.take(first[:n] + k), axis=0)
    out = np.empty_like(total)
    out[order] = total
    return out


def windows_of(halves: np.ndarray, first_half: np.ndarray) -> np.ndarray:
    """Each half-window with the next of the same text."""
    out = halves.copy()
    if len(halves) > 1:
        follows = np.ones(len(halves) - 1, dtype=bool)
        ends = first_half[1:-1]
        follows[ends[(ends > 0) & (ends < len(halves))] - 1] = False
        out[:-1][follows] += halves[1:][follows]
    return out


def window_products(features: np.ndarray, places: np.ndarray, half: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of known words (feature, feature, times): in how many windows of the texts their places stand together.

    Words of one half are together in its own window and in that of the half before it, words of
    neighbouring halves in one. Two places with the same word count twice, once for each order.
    """
    bounds, known, first_half = half_windows(features, places, half)
    which = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    has_before = np.ones(len(bounds) - 1, dtype=np.uint64)
    has_before[first_half[:-1][first_half[:-1] < len(has_before)]] = 0
    at = np.arange(len(known))
    for back in range(2 * half):
        here = at[back:]
        apart = which[here] - which[here - back]
        near = (apart == 0) | ((apart == 1) & (has_before[which[here]] > 0))
        if not near.any():
            break
        here, apart = here[near], apart[near]
        a, b = known[here], known[here - back]
        times = np.where(apart == 0, 1 + has_before[which[here]], np.uint64(1))
        yield a, b, np.where((a == b) & (back > 0), 2 * times, times)


def _cell(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of a pair of features in a triangle of all pairs."""
    low, high = np.minimum(a, b).astype(np.int64), np.maximum(a, b).astype(np.int64)
    return high * (high + 1) // 2 + low


def window_matrix(docs: DataFrame, items: Items, half: int) -> np.ndarray:
    """Features by features, over the windows of all documents: how often both are there. Whole numbers, so any order of rows gives the same."""
    size = len(items.vocabulary.hashes)

    def fill(tables: list[np.ndarray], data: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, places = word_bounds(data, offsets, PLAIN)
        for a, b, times in window_products(items.vocabulary.features(word_hashes(data, starts, ends)), places, half):
            np.add.at(tables[0], _cell(a, b), times)

    return gather_tables(docs, [size * (size + 1) // 2], fill, _RUN_BYTES)[0]


def latent_basis(docs: DataFrame, items: Items, *, half: int, rank: int, rounds: int = 2, seed: int = 3, cells: int = 1 << 23) -> np.ndarray:
    """Orthonormal rows-by-features basis of the TF-IDF windows of all documents and of the items.

    Both parts count alike. Each round multiplies the basis with the windows and back, and makes it
    orthonormal again. Up to `cells` pairs of features, the documents' part is a matrix that Spark
    adds up once; beyond, Spark multiplies in every round. Both are the same product over every document.
    """
    size = len(items.vocabulary.hashes)
    rank = min(rank, size)
    idf = items.idf.astype(np.float32)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, rank)))[0].astype(np.float32)

    def product(features, places, own) -> np.ndarray:
        bounds, known, first_half = half_windows(features, places, half)
        windows = windows_of(sums_of(own, known, bounds), first_half)
        out = np.zeros_like(own)
        # A window holds the words of two halves, so each half's words meet up to two windows.
        before = np.zeros_like(windows)
        before[1:] = windows[:-1]
        before[first_half[:-1][first_half[:-1] < len(windows)]] = 0
        windows += before
        order = np.argsort(known, kind="stable")
        if len(order):
            first = np.flatnonzero(np.concatenate([[True], np.diff(known[order]) > 0]))
            of = np.repeat(np.arange(len(windows)), np.diff(bounds))[order]
            out[known[order][first]] = sums_of(windows, of, np.append(first, len(of)))
        return out

    item_words = np.concatenate(items.words)
    item_features = items.vocabulary.features(item_words)
    item_places = np.concatenate([[0], np.cumsum([len(x) for x in items.words])])
    whole = window_matrix(docs, items, half) if size * (size + 1) // 2 <= cells else None

    for _ in range(rounds):
        weighted = basis * idf[:, None]
        corpus = _matrix_product(whole, weighted) if whole is not None else _multiplied(docs, items, product, weighted)
        corpus = corpus.astype(np.float32) * idf[:, None]
        bench = product(item_features, item_places, weighted) * idf[:, None]
        scaled = [x / n for x in (corpus, bench) if (n := np.linalg.norm(x)) > 0]
        if not scaled:
            break
        basis = np.linalg.qr(sum(scaled))[0].astype(np.float32)
    return basis


def _matrix_product(triangle: np.ndarray, basis: np.ndarray, rows: int = 512) -> np.ndarray:
    """The symmetric matrix of a `window_matrix` times the basis, some rows at a time."""
    size = len(basis)
    out = np.zeros(basis.shape)
    columns = np.arange(size)
    for first in range(0, size, rows):
        own = np.arange(first, min(first + rows, size))
        part = triangle[_cell(own[:, None], columns[None, :])].astype(np.float64)
        out[own] = part @ basis
    return out


def _multiplied(docs: DataFrame, items: Items, product, weighted: np.ndarray) -> np.ndarray:
    """Sum of `product` over all documents, added up in Spark by blocks of features."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(weighted.shape)
        for batch in batches:
            for _, words, places in text_words(batch.column(0), PLAIN, _RUN_BYTES):
                total += product(items.vocabulary.features(words), places, weighted)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "value"])

    out = np.zeros(weighted.size)
    parts = docs.select("text").coalesce(2 * docs.sparkSession.sparkContext.defaultParallelism).mapInArrow(multiply, "at long, value double")
    found = parts.groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    out[found["at"].to_numpy(np.int64)] = found["value"].to_numpy()
    return out.reshape(weighted.shape)


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel in the first argument."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        hit = row & masks.get(x, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@dataclass
class Rules:
    """Limits: `half` words make half a window; cosine of candidates; shares of the item's words."""

    half: int = 16
    cosine: float = 0.5
    surely: float = 0.8
    maybe: float = 0.6
    answer: int = 4


def prepare(docs: DataFrame, items: Items, rules: Rules, *, rank: int = 256) -> Items:
    """Weights and the latent basis from all documents, and the items' vectors."""
    counts, total = document_counts(docs, items)
    items.idf = np.log((total + 1) / (counts + 1)).astype(np.float32) + 0.01
    basis = latent_basis(docs, items, half=rules.half, rank=rank)
    items.basis = basis * items.idf[:, None]
    vectors = np.stack([items.basis[items.vocabulary.features(x)].sum(axis=0) for x in items.words])
    parts, owners = [vectors], [np.arange(len(vectors))]
    for i, x in enumerate(items.words):
        if len(x) > 2 * rules.half:
            bounds, known, first_half = half_windows(items.vocabulary.features(x), np.array([0, len(x)]), rules.half)
            # The last half-window has no next one and is part of the window before it.
            parts.append(windows_of(sums_of(items.basis, known, bounds), first_half)[:-1])
            owners.append(np.full(len(parts[-1]), i))
    vectors, items.owners = np.concatenate(parts), np.concatenate(owners)
    items.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    items.features = [items.vocabulary.features(x) for x in items.words]
    items.answers = []
    for x in items.words:
        own = np.unique(x)
        rarest = np.argsort(-items.idf[items.vocabulary.features(own)], kind="stable")[: rules.answer]
        items.answers.append(own[rarest])
    rarest = np.array([items.vocabulary.features(x[:1])[0] for x in items.answers])
    order = np.argsort(rarest, kind="stable")
    items.marks = Marks(
        order, np.searchsorted(rarest[order], np.arange(len(items.idf) + 1)),
        np.array([np.flatnonzero(x == a[0])[0] for x, a in zip(items.words, items.answers)]),
        np.array([len(x) for x in items.words]), np.array([x[0] for x in items.words]), np.array([x[-1] for x in items.words]),
    )
    return items


def copies(items: Items, words: np.ndarray, features: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (first word, item) whose first and last word and rarest word are the item's: all copies word for word are there."""
    marks = items.marks
    at = np.flatnonzero(features >= 0)
    count = np.diff(marks.bounds)[features[at]]
    at, count = at[count > 0], count[count > 0]
    low = marks.bounds[features[at]]
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    item = marks.items[np.repeat(low, count) + nth]
    at = np.repeat(at, count)
    begin = at - marks.place[item]
    end = begin + marks.size[item]
    text = np.searchsorted(places, at, "right") - 1
    inside = (begin >= places[text]) & (end <= places[text + 1])
    begin, end, item = begin[inside], end[inside], item[inside]
    same = (words[begin] == marks.first[item]) & (words[end - 1] == marks.last[item])
    return begin[same], item[same]


def find(items: Items, rules: Rules, texts: pa.Array) -> list[tuple[int, int, float, float, int]]:
    """Leaks in a batch: (row, item number, cosine, share of the item in order, first word of the window)."""
    found: dict[tuple[int, int], tuple[float, float, int]] = {}
    for first, words, places in text_words(texts, PLAIN, _RUN_BYTES):
        features = items.vocabulary.features(words)
        bounds, known, first_half = half_windows(features, places, rules.half)
        windows = windows_of(sums_of(items.basis, known, bounds), first_half)
        norms = np.maximum(np.linalg.norm(windows, axis=1), 1e-9)
        window, vector = np.nonzero(windows @ items.vectors.T >= rules.cosine * norms[:, None])
        begin, copied = copies(items, words, features, places)
        own_text = np.searchsorted(places, begin, "right") - 1
        begin = first_half[own_text] + (begin - places[own_text]) // rules.half
        # An item and a window meet once, though several of its vectors may match.
        met = np.unique(np.concatenate([window, begin]) * len(items.ids) + np.concatenate([items.owners[vector], copied]))
        if not len(met):
            continue
        window, item = np.divmod(met, len(items.ids))
        text = np.searchsorted(first_half, window, "right") - 1
        present = np.zeros(len(items.vocabulary.hashes) + 1, dtype=bool)
        for w, i, t in zip(window.tolist(), item.tolist(), text.tolist()):
            own = items.words[i]
            begin = int(places[t]) + (w - int(first_half[t])) * rules.half
            low, high = max(int(places[t]), begin - len(own)), min(int(places[t + 1]), begin + 2 * rules.half + len(own))
            region = words[low:high]
            # No more of the item can stand in order than stands there at all; words of no item are in the last place.
            present[features[low:high]] = True
            present[-1] = False
            most = int(np.count_nonzero(present[items.features[i]])) / len(own)
            present[features[low:high]] = False
            if most < rules.maybe:
                continue
            share = common_subsequence(own, region) / len(own)
            if share < rules.maybe:
                continue
            if share < rules.surely and not np.isin(items.answers[i], region).all():
                continue
            cosine = float(windows[w] @ items.vectors[i] / norms[w])
            key, value = (first + t, i), (share, cosine, begin - int(places[t]))
            if key not in found or value > found[key]:
                found[key] = value
    return [(row, i, cosine, share, at) for (row, i), (share, cosine, at) in sorted(found.items())]


def _blocks(docs: DataFrame, benchmark: DataFrame, rules: Rules, block: int, **options) -> Iterator[Items]:
    rows = benchmark.select("item_id", "text").distinct().toPandas().sort_values(["item_id", "text"])
    for at in range(0, len(rows), block):
        part = rows.iloc[at : at + block]
        items = items_of([int(x) if x == x else None for x in part["item_id"]], part["text"].tolist())
        if items.ids:
            yield prepare(docs, items, rules, **options)


def leaks(docs: DataFrame, benchmark: DataFrame, *, rules: Rules = Rules(), block: int = 1024, **options) -> DataFrame:
    """Benchmark items found in documents: doc_id, item_id, cosine, share, first_word.

    `share` is the item's part that stands in order around the best window, which starts at
    word `first_word`. One row for each document row and item. Null and empty texts, and items
    without words, match nothing; equal items each match. Null ids are kept. Very long texts
    are searched whole. Other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, cosine double, share double, first_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(docs, benchmark, rules, block, **options):

        def search(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = find(items, rules, batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                        pa.array([items.ids[r[1]] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.float64()),
                        pa.array([r[4] for r in rows], pa.int64()),
                    ],
                    names=["doc_id", "item_id", "cosine", "share", "first_word"],
                )

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(search, schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, *, rules: Rules = Rules(), block: int = 1024, **options) -> DataFrame:
    """The documents without benchmark items, columns unchanged."""
    at = docs.columns.index("text")
    kept = docs
    for items in _blocks(docs, benchmark, rules, block, **options):

        def search(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[r[0] for r in find(items, rules, batch.column(at))]] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(search, docs.schema)
    return kept
