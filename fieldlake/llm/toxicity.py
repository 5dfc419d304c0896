"""Convolutional toxicity classifier: hashed word embeddings, several filter widths, max pooling.

The network is trained in numpy on all labelled documents: Spark deals them out in shards, each
shard goes through an epoch from the same parameters, and the parameters are averaged. A word's vector is
the sum of two rows chosen by two hashes of the word and of one row each for its first four
and five bytes, which inflected forms share. What too few training documents have adds
nothing, so that a rare word neither is learned by heart nor borrows a meaning. Thresholds
are fitted for each language that the text itself shows (by its letters), and the score is
shifted so that every language's threshold is at `cut`.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.common import Scratch, fold_of
from fieldlake.llm.words import PLAIN, U64, pieces, prefix_hashes, signed, word_bounds

# Letters that tell languages of Latin script apart; a text without any is "other".
LETTERS = {"de": "äöüßÄÖÜ", "fr": "éèêçàùâîôûÉÈÊÇÀ", "es": "ñíóáúÑÍÓÁÚ¿¡"}


@dataclass
class Network:
    """Parameters; `rows` and `dim` size the embedding tables, `filters` is per width."""

    rows: int = 1 << 16
    dim: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 12
    seed: int = 7
    tables: list[np.ndarray] = field(default_factory=list)
    kernels: list[np.ndarray] = field(default_factory=list)
    biases: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray | None = None
    known: np.ndarray | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    cut: float = 0.7

    def start(self, known_words: np.ndarray) -> "Network":
        rng = np.random.default_rng(self.seed)
        # The row behind the last is zero: what is not known has it.
        self.tables = [rng.normal(0, 0.2, (self.rows + 1, self.dim)).astype(np.float32) for _ in range(4)]
        for table in self.tables:
            table[-1] = 0
        scale = [1 / np.sqrt(self.dim * w) for w in self.widths]
        self.kernels = [
            rng.normal(0, s, (w, self.dim, self.filters)).astype(np.float32) for w, s in zip(self.widths, scale)
        ]
        self.biases = [np.zeros(self.filters, np.float32) for _ in self.widths]
        self.out = np.append(rng.normal(0, 0.3, self.filters * len(self.widths)), 0).astype(np.float32)
        self.known = np.zeros(1 << 20, dtype=bool)
        self.known[self._mark(known_words)] = True
        return self

    @staticmethod
    def _mark(words: np.ndarray) -> np.ndarray:
        return (words >> U64(44)).astype(np.int64)

    def places(self, words: np.ndarray) -> list[np.ndarray]:
        """Rows of all words in each table. `words` has a column for each kind of key."""
        size, out = U64(self.rows), []
        for kind, shift in ((0, 0), (0, 22), (1, 0), (2, 0)):
            own = words[:, kind]
            row = ((own >> U64(shift)) % size).astype(np.int32)
            row[~self.known[self._mark(own)]] = self.rows
            out.append(row)
        return out

    def vectors(self, places: list[np.ndarray]) -> np.ndarray:
        out = self.tables[0].take(places[0], axis=0)
        for table, place in zip(self.tables[1:], places[1:]):
            out += table.take(place, axis=0)
        return out

    def pooled(self, places: list[np.ndarray], starts: np.ndarray, argmax: bool = False):
        """Largest value of every filter in each text (0 if the text is too short or all are negative)."""
        vectors = self.vectors(places)
        counts = np.diff(starts)
        features = np.zeros((len(counts), self.filters * len(self.widths)), np.float32)
        best = np.full(features.shape, -1, dtype=np.int64)
        for k, width in enumerate(self.widths):
            full = np.flatnonzero(counts >= width)
            if not len(full):
                continue
            n = len(vectors) - width + 1
            values = sum(vectors[i : i + n] @ self.kernels[k][i] for i in range(width)) + self.biases[k]
            for i in range(1, width):
                cut = starts[1:-1] - i
                values[cut[(cut >= 0) & (cut < n)]] = -np.inf
            at = slice(k * self.filters, (k + 1) * self.filters)
            top = np.maximum.reduceat(values, starts[:-1][full], axis=0)
            features[full, at] = np.maximum(top, 0)
            if argmax:
                for row, text in enumerate(full):
                    own = values[starts[text] : starts[text] + counts[text] - width + 1]
                    best[text, at] = np.where(top[row] > 0, starts[text] + own.argmax(axis=0), -1)
        return (features, best, vectors) if argmax else features

    def raw(self, places: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
        return self.pooled(places, starts) @ self.out[:-1] + self.out[-1]

    def score(self, logits: np.ndarray, languages: list[str]) -> np.ndarray:
        shift = np.log(self.cut / (1 - self.cut))
        own = np.array([self.thresholds.get(x, self.thresholds.get("", 0.0)) for x in languages])
        return 1 / (1 + np.exp(-np.clip(logits - own + shift, -30, 30)))


def languages_of(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Language whose letters each text has most of, the first of `LETTERS` if several, "other" without any."""
    at = np.flatnonzero(_LEADS[data[:-1]])
    of = _MARKS[data[at], data[at + 1]]
    at, of = at[of >= 0], of[of >= 0]
    text = np.searchsorted(offsets, at, "right") - 1
    n, kinds = len(offsets) - 1, len(LETTERS)
    counts = np.bincount(text * kinds + of, minlength=n * kinds).reshape(n, kinds)
    names = np.array([*LETTERS, "other"])
    return names[np.where(counts.any(axis=1), counts.argmax(axis=1), kinds)].tolist()


def _marks() -> tuple[np.ndarray, np.ndarray]:
    """Number of the language of each letter, all of two bytes in UTF-8, by both bytes (else -1); bytes that start one."""
    marks = np.full((256, 256), -1, dtype=np.int64)
    for number, letters in enumerate(LETTERS.values()):
        for first, second in (x.encode() for x in letters):
            marks[first, second] = number
    return marks, (marks >= 0).any(axis=1)


_MARKS, _LEADS = _marks()


#: Bytes at a word's start that are keys of their own.
PREFIXES = (4, 5)


def runs(texts: pa.Array):
    """(first index, keys of words, starts, languages) of runs of texts; keys: the word and its prefixes."""
    for first, data, offsets in pieces(texts):
        yield first, *_keys(data, offsets), languages_of(data, offsets)


def _keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of words, and starts of texts."""
    begin, end, starts = word_bounds(data, offsets, PLAIN)
    keys = prefix_hashes(data, begin, [end, *(np.minimum(end, begin + n) for n in PREFIXES)])
    return np.stack([keys[0], *(x * U64(2 * n + 1) for x, n in zip(keys[1:], PREFIXES))], axis=1), starts


def _step(net: Network, squares: dict, places, starts, labels, weight, rate: float) -> None:
    features, best, vectors = net.pooled(places, starts, argmax=True)
    logits = features @ net.out[:-1] + net.out[-1]
    error = ((1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) * weight / len(labels)).astype(np.float32)
    back = error[:, None] * net.out[:-1]
    _move(net.out, np.append(features.T @ error, error.sum()), squares["out"], rate)
    rows, grads = [], []
    for k, width in enumerate(net.widths):
        at = slice(k * net.filters, (k + 1) * net.filters)
        kernel_grad = np.zeros_like(net.kernels[k])
        text, filt = np.nonzero(best[:, at] >= 0)
        where = best[:, at][text, filt]
        own = back[:, at][text, filt]
        bias_grad = np.bincount(filt, own, net.filters).astype(np.float32)
        for i in range(width):
            np.add.at(kernel_grad[i].T, filt, own[:, None] * vectors[where + i])
            rows.append(where + i)
            grads.append(own[:, None] * net.kernels[k][i].T[filt])
        _move(net.kernels[k], kernel_grad, squares["kernels"][k], rate)
        _move(net.biases[k], bias_grad, squares["biases"][k], rate)
    if not rows:
        return
    rows, grads = np.concatenate(rows), np.concatenate(grads)
    for table, place, square in zip(net.tables, places, squares["tables"]):
        own = place[rows]
        known = own < net.rows
        used, inverse = np.unique(own[known], return_inverse=True)
        total = np.zeros((len(used), net.dim), np.float32)
        np.add.at(total, inverse, grads[known])
        square[used] += (total**2).sum(axis=1)
        table[used] -= rate * total / np.sqrt(square[used])[:, None]


def _move(value: np.ndarray, grad: np.ndarray, square: np.ndarray, rate: float) -> None:
    square += grad**2
    value -= (rate * grad / np.sqrt(square)).astype(np.float32)


def _threshold(logits: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> tuple[float, float]:
    """Logit between the rising `logits` at which F0.5 is best, the middle of the gap, and that F0.5.

    `ones` and `zeros` count the toxic and the clean texts of each logit. F0.5 counts a clean text
    that is rejected more than a toxic one that stays.
    """
    logits, hits, taken = logits[::-1], np.cumsum(ones[::-1]), np.cumsum((ones + zeros)[::-1])
    if not len(hits) or not hits[-1]:
        return float(logits.max(initial=0.0)) + 1.0, 0.0
    f = 1.25 * hits / (taken + 0.25 * hits[-1])
    best = int(np.argmax(f))
    below = logits[best + 1] if best + 1 < len(logits) else logits[best] - 1.0
    return float((logits[best] + below) / 2), float(f[best])


def training_sample(docs: DataFrame, labels: DataFrame, *, folds: int = 3, held: int = 1, per_label: int = 3000):
    """Texts and labels of at most `per_label` documents of each label, never of the held-out fold.

    The documents are those whose ids hash smallest, which does not depend on the order of
    rows; of several labels of a document the highest counts.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(fold_of("doc_id", folds) != held).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.where("toxic = 1").limit(per_label).union(known.where("toxic = 0").limit(per_label))
    chosen = Scratch(docs.sparkSession, "toxic").put(chosen, "sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").toPandas()
    rows = rows.sort_values(["doc_id", "text"], na_position="first").drop_duplicates("doc_id")
    return rows["text"].tolist(), rows["toxic"].to_numpy(np.int64)


def labelled(docs: DataFrame, labels: DataFrame, *, folds: int = 3, held: int = 1, shard_rows: int = 6000, scratch: Scratch | None = None) -> DataFrame:
    """(shard, place, aside, text, toxic) of every labelled document that is not of the held-out fold, stored by shard.

    Of several labels of a document the highest counts, of several texts the smallest, null first.
    A fifth of the documents, by a hash of the id as `place` is, stands `aside` for the thresholds.
    """
    scratch = scratch or Scratch(docs.sparkSession, "toxic")
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(fold_of("doc_id", folds) != held)
    # Stored, so that the planner sees its size: while it is small, only labelled texts are shuffled.
    known = scratch.put(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "known")
    text = F.struct(F.col("text").isNotNull().alias("full"), "text")
    rows = docs.select("doc_id", "text").join(known, "doc_id").groupBy("doc_id").agg(
        F.min(text)["text"].alias("text"), F.first("toxic").cast("int").alias("toxic")
    )
    rows = scratch.put(rows.select(F.xxhash64("doc_id").alias("place"), "text", "toxic"), "rows")
    shards = max(1, -(-rows.count() // shard_rows))
    aside = F.pmod(F.shiftright("place", 32), F.lit(5)) == 0
    out = scratch.put_bucketed(
        rows.select(F.pmod("place", F.lit(shards)).alias("shard"), "place", aside.alias("aside"), "text", "toxic"), "shards", "shard"
    )
    scratch.drop("rows")
    return out


def _read(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of words and starts of texts of all texts together."""
    words, starts = [np.zeros((0, 1 + len(PREFIXES)), np.uint64)], [0]
    for _, data, offsets in pieces(texts):
        own, own_starts = _keys(data, offsets)
        words.append(own)
        starts.extend((own_starts[1:] + starts[-1]).tolist())
    return np.concatenate(words), np.array(starts)


def known_marks(rows: DataFrame, least: int) -> np.ndarray:
    """Which of the 2 ** 20 marks belong to a key that at least so many of the documents have."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in pieces(batch.column(0)):
                words, starts = _keys(data, offsets)
                owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                for kind in range(words.shape[1]):
                    own = words[:, kind]
                    order = np.lexsort((owner, own))
                    keys, at = own[order], owner[order]
                    fresh = np.ones(len(keys), dtype=bool)
                    fresh[1:] = (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])
                    found, times = np.unique(keys[fresh], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), kind, np.int32)), pa.array(signed(found)), pa.array(times)], names=["kind", "key", "n"]
                    )

    keys = rows.select("text").mapInArrow(count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    marks = keys.where(F.col("n") >= least).select(F.shiftrightunsigned("key", 44).alias("mark")).distinct()
    out = np.zeros(1 << 20, dtype=bool)
    # At most 2 ** 20 numbers, however many words there are.
    out[marks.toPandas()["mark"].to_numpy(np.int64)] = True
    return out


def fit(docs: DataFrame, labels: DataFrame, *, folds: int = 3, held: int = 1, shard_rows: int = 6000, epochs: int = 12, batch: int = 64,
        least: int = 5, rate: float = 0.1, cut: float = 0.7, seed: int = 7, starts_at_most: int = 3, enough: float = 0.97, **sizes) -> Network:
    """A network, and its thresholds, from all labelled documents but those of the held-out fold; a fifth fits the thresholds only.

    `least`: documents that must have a word for it to be learned. Training starts anew, at
    most `starts_at_most` times, until every language's F0.5 on that fifth is `enough`; the
    best network counts. Without both labels it is constant. A task holds the documents of one
    shard, about `shard_rows`.
    """
    scratch = Scratch(docs.sparkSession, "toxic")
    rows = labelled(docs, labels, folds=folds, held=held, shard_rows=shard_rows, scratch=scratch)
    counts = {(r.toxic, r.aside): r.n for r in rows.groupBy("toxic", "aside").agg(F.count("*").alias("n")).collect()}
    ones, zeros = (sum(n for (toxic, _), n in counts.items() if toxic == x) for x in (1, 0))
    net = Network(seed=seed, cut=cut, **sizes).start(np.zeros(0, np.uint64))
    if not ones or not zeros:
        net.out[:] = 0
        net.out[-1] = 5.0 if ones else -5.0
        scratch.keep_only()
        return net
    known = known_marks(rows, least)
    shards = rows.agg(F.max("shard")).first()[0] + 1
    weights = np.array([0.5 / zeros, 0.5 / ones]) * (ones + zeros)
    best, best_f = net, -1.0
    for turn in range(starts_at_most):
        net = Network(seed=seed + turn, cut=cut, **sizes).start(np.zeros(0, np.uint64))
        net.known = known
        squares = {"out": np.full_like(net.out, 1e-3), "tables": [np.full(net.rows + 1, 1e-3, np.float32) for _ in net.tables],
                   "kernels": [np.full_like(x, 1e-3) for x in net.kernels], "biases": [np.full_like(x, 1e-3) for x in net.biases]}
        for epoch in range(epochs):
            _epoch(rows.where("not aside"), shards, net, squares, weights, epoch, batch, rate)
        worst = _fit_thresholds(rows.where("aside"), net)
        # A start that misses one language's words is worth no more than its worst language.
        if worst > best_f:
            best, best_f = net, worst
        if worst >= enough:
            break
    scratch.keep_only()
    return best


def _epoch(rows: DataFrame, shards: int, net: Network, squares: dict, weights: np.ndarray, epoch: int, batch: int, rate: float) -> None:
    """Every shard goes through its documents once from the same parameters; their mean is the new state."""
    sent = rows.sparkSession.sparkContext.broadcast((net, squares))
    state = _state(net, squares)

    def learn(key: tuple, group: pa.Table) -> pa.Table:
        own, squares = copy.deepcopy(sent.value)
        group = group.sort_by("place")
        words, starts = _read(group.column("text").combine_chunks())
        places, labels = own.places(words), group.column("toxic").to_numpy()
        rng = np.random.default_rng([own.seed, epoch, key[0].as_py()])
        for part in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // batch)):
            own_starts = np.concatenate([[0], np.cumsum(starts[part + 1] - starts[part])])
            at = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in part])
            _step(own, squares, [x[at] for x in places], own_starts, labels[part], weights[labels[part]], rate)
        return pa.table({"part": [key[0].as_py()] * _BLOCKS, "block": pa.array(range(_BLOCKS), pa.int32()), "n": [1] * _BLOCKS,
                         "data": [_packed(x, 1, y) for x, y in zip(_blocks(_state(own, squares)), _blocks(_state(*sent.value)))]})

    def add(key: tuple, group: pa.Table) -> pa.Table:
        base, times = _blocks(_state(*sent.value))[key[1].as_py()], group.column("n").to_pylist()
        total = sum(_unpacked(x.as_py(), n, base).astype(np.float64) for x, n in zip(group.column("data"), times))
        return pa.table({"part": [key[0].as_py()], "block": pa.array([key[1].as_py()], pa.int32()),
                         "n": [sum(times)], "data": [_packed(total.astype(np.float32), sum(times), base)]})

    schema = "part long, block int, n long, data binary"
    parts = rows.groupBy("shard").applyInArrow(learn, schema)
    while shards > 1:
        parts = parts.withColumn("part", F.floor(F.col("part") / 32)).groupBy("part", "block").applyInArrow(add, schema)
        shards = -(-shards // 32)
    found = sorted((r.block, r.n, r.data) for r in parts.toLocalIterator())
    sent.destroy()
    if found:
        total = [_unpacked(x, n, base) for (_, n, x), base in zip(found, _blocks(state))]
        mean = np.concatenate(total) / np.float32(found[0][1])
        for x, own in zip(state, np.split(mean, np.cumsum([x.size for x in state])[:-1])):
            x[...] = own.reshape(x.shape)


def _state(net: Network, squares: dict) -> list[np.ndarray]:
    """All arrays that training changes."""
    sums = [*squares["tables"], *squares["kernels"], *squares["biases"], squares["out"]]
    return [*net.tables, *net.kernels, *net.biases, net.out, *sums]


_BLOCKS = 16


def _blocks(state: list[np.ndarray]) -> list[np.ndarray]:
    return np.array_split(np.concatenate([x.ravel() for x in state]), _BLOCKS)


def _packed(total: np.ndarray, n: int, base: np.ndarray) -> bytes:
    """A sum of `n` states that training took from `base`, without loss: the bits in which it differs from `n` times that.

    A shard changes few rows of the tables, so most bits are zero. Equal bytes of the values stand together.
    """
    bits = total.view(np.uint32) ^ (base.astype(np.float64) * n).astype(np.float32).view(np.uint32)
    return pa.compress(bits.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int, base: np.ndarray) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, base.nbytes, "zstd", asbytes=True), np.uint8).reshape(4, -1)
    bits = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
    return (bits ^ (base.astype(np.float64) * n).astype(np.float32).view(np.uint32)).view(np.float32)


def _fit_thresholds(rows: DataFrame, net: Network, steps: int = 1 << 11) -> float:
    """Thresholds of the languages, from counts of all rows by logit in steps of 1 / `steps`; the worst language's F0.5."""
    sent = rows.sparkSession.sparkContext.broadcast(net)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, starts, languages in runs(batch.column(0)):
                logits = np.clip(sent.value.raw(sent.value.places(words), starts), -30, 30)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(languages, pa.string()), pa.array(np.rint(logits * steps).astype(np.int32)), batch.column(1).slice(first, len(languages))],
                    names=["language", "at", "toxic"],
                )

    rows = rows.select("text", "toxic").mapInArrow(count, "language string, at int, toxic int")
    # At most 60 * steps rows a language.
    found = rows.groupBy("language", "at").agg(F.count_if(F.col("toxic") == 1).alias("ones"), F.count_if(F.col("toxic") == 0).alias("zeros")).toPandas()
    sent.destroy()

    def of(own) -> tuple[float, float]:
        own = own.groupby("at")[["ones", "zeros"]].sum().sort_index()
        return _threshold(own.index.to_numpy(np.float64) / steps, own["ones"].to_numpy(), own["zeros"].to_numpy())

    net.thresholds = {"": of(found)[0]}
    worst = []
    for language, own in found.groupby("language"):
        if own["ones"].sum() >= 30 and own["zeros"].sum() >= 30:
            net.thresholds[language], f = of(own)
            worst.append(f)
    return min(worst, default=of(found)[1])


def _scores(net: Network, texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts))
    for first, words, starts, languages in runs(texts):
        out[first : first + len(languages)] = net.score(net.raw(net.places(words), starts), languages)
    return out


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score >= cut) of every document.

    Null and empty texts get the score of a text without words. Rows with null or equal ids
    are scored like others. Other columns are ignored; no column but the text is read.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(net, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= net.cut).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {kind}, score double, predicted int")


def keep_clean(docs: DataFrame, net: Network) -> DataFrame:
    """The documents that the network does not reject, columns unchanged."""
    at = docs.columns.index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(net, batch.column(at)) < net.cut))

    return docs.mapInArrow(apply, docs.schema)
