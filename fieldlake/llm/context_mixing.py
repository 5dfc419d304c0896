"""Language model by logistic mixing of hashed-context bit predictors.

A text is its words (split at white space, lower-cased in A-Z) and one end. The most frequent
words, the end and an escape for all other words are symbols, coded by the bits of a Huffman
code. An escaped word is then named: by its share among the escaped words of the training
texts, mixed with its spelling by hashed character contexts. Every bit is predicted by several contexts: none, the word before, the two words before, and single
words further back. Each context and place in the code has hashed counts, gathered from all
training texts. Their log odds are combined by weights that a gate chooses, and each text
refines the weights as it goes, one block of words after another.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.common import Scratch, _packed, _unpacked, fold_of, gather_tables  # noqa: F401
from fieldlake.llm.decontaminate import Vocabulary
from fieldlake.llm.words import LOWER, U64, mixed, pieces, signed, text_words, word_bounds, word_hashes

#: Words before that make a context: (1,) is the word before, (1, 2) the two before.
CONTEXTS = ((1,), (1, 2), (2,), (3,))
#: Gates: depth in the code, and how often the first two contexts were seen.
_DEPTHS, _LEVELS = 6, (1, 4, 20)
_GATES = _DEPTHS * (len(_LEVELS) + 1) ** 2


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of symbols: (start of each symbol's steps, node of each step, bit of each step)."""
    n = len(counts)
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent, side = np.full(2 * n - 1, -1), np.zeros(2 * n - 1, dtype=np.int8)
    new = n
    while len(heap) > 1:
        (ca, a), (cb, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a] = parent[b] = new
        side[b] = 1
        heapq.heappush(heap, (ca + cb, new))
        new += 1
    starts, nodes, bits = [0], [], []
    for symbol in range(n):
        path, at = [], symbol
        while parent[at] >= 0:
            path.append((parent[at] - n, side[at]))
            at = parent[at]
        nodes += [x for x, _ in reversed(path)]
        bits += [x for _, x in reversed(path)]
        starts.append(len(nodes))
    return np.array(starts), np.array(nodes, dtype=np.int64), np.array(bits, dtype=np.int8)


@dataclass
class Code:
    """Symbols 0 to n-1 are the frequent words, n is the end, n + 1 the escape."""

    vocabulary: Vocabulary
    counts: np.ndarray
    total: int
    distinct: int
    documents: int
    power: int = 20

    def __post_init__(self):
        n = len(self.counts)
        self.rest_total = self.total - int(self.counts.sum()) - self.documents
        weights = np.concatenate([self.counts, [max(1, self.documents), max(1, self.rest_total)]])
        self.starts, self.nodes, self.bits = huffman(weights)
        ones = np.bincount(self.nodes, np.repeat(weights, np.diff(self.starts)) * self.bits, minlength=n + 1)
        both = np.bincount(self.nodes, np.repeat(weights, np.diff(self.starts)), minlength=n + 1)
        self.plain = np.log((ones + 0.4) / (both - ones + 0.4)).astype(np.float32)
        self.end, self.escape = n, n + 1
        depth = np.zeros(n + 1, dtype=np.int64)
        steps = np.arange(len(self.nodes)) - np.repeat(self.starts[:-1], np.diff(self.starts))
        depth[self.nodes] = np.minimum(steps, _DEPTHS - 1)
        self.depth = depth
        # For each step of each code: the hash of its node.
        self.node_hashes = mixed(self.nodes.astype(np.uint64) * U64(0x9E3779B97F4A7C15))


@dataclass
class Steps:
    """The coded bits of a run of texts, and what the words say besides."""

    text: np.ndarray
    block: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    slots: list[np.ndarray]
    n_tokens: np.ndarray
    rare: np.ndarray
    rare_text: np.ndarray
    frequent_log: np.ndarray


_END_HASH = U64(0x1234567)


def steps_of(code: Code, words: np.ndarray, places: np.ndarray, block_words: int = 64) -> Steps:
    n_texts = len(places) - 1
    counts = np.diff(places)
    starts = places + np.arange(n_texts + 1)
    hashes = np.full(starts[-1], _END_HASH, dtype=np.uint64)
    symbols = np.full(starts[-1], code.end, dtype=np.int64)
    text = np.repeat(np.arange(n_texts), counts + 1)
    is_word = np.ones(starts[-1], dtype=bool)
    is_word[starts[1:] - 1] = False
    found = code.vocabulary.features(words)
    hashes[is_word] = words
    symbols[is_word] = np.where(found < 0, code.escape, found)
    place = np.arange(starts[-1]) - starts[text]

    size = np.diff(code.starts)[symbols]
    token = np.repeat(np.arange(len(symbols)), size)
    step = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
    where = code.starts.take(symbols.take(token)) + step
    node = code.nodes.take(where)
    node_hash = code.node_hashes.take(where)
    slots = []
    for number, context in enumerate(CONTEXTS):
        own = np.full(len(symbols), number + 1, dtype=np.uint64)
        for back in context:
            before = np.zeros(len(symbols), dtype=np.uint64)
            before[back:] = hashes[:-back] if len(hashes) > back else 0
            before[place < back] = 0
            own = mixed(own * U64(0xD6E8FEB86659FD93) + before)
        odd = own * U64(2) + U64(1)
        slots.append((odd.take(token) * node_hash >> U64(64 - code.power)).view(np.int64))
    rare = is_word & (symbols == code.escape)
    common = np.append(np.log10(code.counts + 0.5), [np.log10(code.documents + 0.5), 0.0])
    return Steps(
        text.take(token), (place // block_words).take(token), node, code.bits.take(where), slots, counts + 1,
        hashes[rare], text[rare], np.bincount(text, common[symbols], n_texts),
    )


def count_tables(docs: DataFrame, code: Code) -> list[np.ndarray]:
    """Counts of both bits by hashed context, over all of `docs`: (slots, 2) for each context."""
    size = 2 << code.power

    def fill(tables: list[np.ndarray], data: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, places = word_bounds(data, offsets)
        steps = steps_of(code, word_hashes(data, starts, ends), places)
        for table, slots in zip(tables, steps.slots):
            table += np.bincount(slots * 2 + steps.bit, minlength=size).view(np.uint64)

    return [x.reshape(-1, 2) for x in gather_tables(docs, [size] * len(CONTEXTS), fill)]


#: Characters (bytes) before that make a context of the spelling.
ORDERS = (0, 1, 2, 3, 5)
_SPELL_POWER = 20


def distinct_words(data: np.ndarray, offsets: np.ndarray):
    """Distinct words of a run of texts: (hash, start, end, number of the first text's word, words, places)."""
    starts, ends, places = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    found, at, which = np.unique(words, return_index=True, return_inverse=True)
    return found, starts[at], ends[at], which, places


def spelling_slots(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """For each character of each word and its end: word number, and slots of (context, character) and context by order."""
    size = ends - starts + 1
    owner = np.repeat(np.arange(len(starts)), size)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    letters = np.zeros(len(owner), dtype=np.uint64)
    inside = place < size[owner] - 1
    letters[inside] = LOWER[data[(starts[owner] + place)[inside]]]
    slots, context = [], np.full(len(owner), 7, dtype=np.uint64)
    back = 0
    for order in ORDERS:
        while back < order:
            back += 1
            before = np.full(len(owner), 256, dtype=np.uint64)
            before[back:] = letters[:-back] if len(letters) > back else 256
            before[place < back] = 256
            context = (context * U64(0x9E3779B97F4A7C15) + before + U64(1)) * U64(0xD6E8FEB86659FD93)
        seen = context ^ (context >> U64(29))
        both = (seen * U64(0xBF58476D1CE4E5B9) + letters) * U64(0x94D049BB133111EB)
        shift = U64(64 - _SPELL_POWER)
        slots.append(((both >> shift).astype(np.int64), (seen * U64(0xD6E8FEB86659FD93) >> shift).astype(np.int64)))
    return owner, slots


def spelling_tables(docs: DataFrame) -> list[np.ndarray]:
    """Counts of (context, character) and of contexts, over the distinct words of every run of texts.

    `score` gives each distinct word of the corpus as a text, so that runs make no difference.
    """
    size = 1 << _SPELL_POWER

    def fill(tables: list[np.ndarray], data: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, _ = word_bounds(data, offsets)
        at = np.unique(word_hashes(data, starts, ends), return_index=True)[1]
        _, slots = spelling_slots(data, starts[at], ends[at])
        for k, pair in enumerate(slots):
            for table, own in zip(tables[2 * k : 2 * k + 2], pair):
                table += np.bincount(own, minlength=size).view(np.uint64)

    return [_narrow(x) for x in gather_tables(docs, [size] * (2 * len(ORDERS)), fill)]


def _narrow(table: np.ndarray) -> np.ndarray:
    """The same counts in the fewest bytes: tasks get tables by broadcast, which takes disk on driver and executors."""
    return table.astype(np.min_scalar_type(int(table.max(initial=0))))


def spelling_log10(tables: list[np.ndarray], data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """log10 probability of each word's spelling: longer contexts as far as they are known, then shorter ones."""
    owner, slots = spelling_slots(data, starts, ends)
    chance = np.full(len(owner), 1 / 257)
    for k, (both, context) in enumerate(slots):
        chance = (tables[2 * k][both] + 4.0 * chance) / (np.maximum(tables[2 * k + 1][context], tables[2 * k][both]) + 4.0)
    return np.bincount(owner, np.log10(chance.astype(np.float32)), len(starts))


@dataclass
class Mixer:
    """Log odds and levels by context slot, gated weights, and the rate at which a text refines them."""

    code: Code
    odds: list[np.ndarray]
    levels: list[np.ndarray]
    weights: np.ndarray
    rate: float = 0.0

    def inputs(self, steps: Steps) -> tuple[np.ndarray, np.ndarray]:
        columns = [self.code.plain.take(steps.node)] + [table.take(slots) for table, slots in zip(self.odds, steps.slots)]
        gate = self.code.depth.take(steps.node)
        for level, slots in zip(self.levels, steps.slots):
            gate = gate * (len(_LEVELS) + 1) + level.take(slots)
        return np.stack(columns, axis=1), gate

    def log10_probability(self, steps: Steps, inputs: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Of each text's symbols. Blocks of a text follow each other; texts run side by side."""
        inputs, gate = inputs or self.inputs(steps)
        n_texts = len(steps.n_tokens)
        if not self.rate:
            z = np.clip(np.einsum("ij,ij->i", inputs, self.weights.take(gate, axis=0)), -30, 30)
            cost = np.log1p(np.exp(np.where(steps.bit > 0, -z, z)))
            return -np.bincount(steps.text, cost, n_texts) / np.log(10)
        total = np.zeros(n_texts)
        own = np.zeros((n_texts, inputs.shape[1]), dtype=np.float32)
        order = np.argsort(steps.block, kind="stable")
        ends = np.searchsorted(steps.block.take(order), np.arange(int(steps.block.max(initial=-1)) + 2))
        for a, b in zip(ends[:-1], ends[1:]):
            at = order[a:b]
            text, x = steps.text.take(at), inputs.take(at, axis=0)
            z = np.clip(np.einsum("ij,ij->i", x, self.weights.take(gate.take(at), axis=0) + own.take(text, axis=0)), -30, 30)
            bit = steps.bit.take(at)
            odds = np.exp(-z)
            cost = np.log1p(odds) + np.where(bit > 0, 0, z)
            first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            total[text[first]] -= np.add.reduceat(cost, first)
            error = (bit - 1 / (1 + odds)).astype(np.float32)
            moved = np.add.reduceat(error[:, None] * x, first, axis=0)
            n_bits = np.diff(np.append(first, len(text)))[:, None]
            own[text[first]] += self.rate * moved / np.sqrt(n_bits)
            np.clip(own, -1, 1, out=own)
        return total / np.log(10)

    def tune(self, docs: DataFrame, rounds: int = 4, prior: float = 20.0) -> "Mixer":
        """Fit the gated weights, and the rate, on all texts of `docs`, which the tables do not count.

        Each gate's weights are a logistic regression by Newton's method, drawn to the weights
        at the start as `prior` bits would draw them. Tasks add up slopes and bends, and the
        gains of the rates; what meets on the driver does not grow with the texts.
        """
        start = self.weights.astype(np.float64)
        n = start.shape[1]
        upper = np.triu_indices(n)
        # The tables go out once for all rounds; only weights change.
        held = docs.sparkSession.sparkContext.broadcast((self.code, self.odds, self.levels))
        weights = self.weights

        def newton(texts: pa.Array) -> np.ndarray:
            mixer = Mixer(*held.value, weights)
            slope, bend = np.zeros((_GATES, n)), np.zeros((_GATES, len(upper[0])))
            for _, words, places in text_words(texts, most=1 << 17):
                steps = steps_of(mixer.code, words, places)
                inputs, gate = mixer.inputs(steps)
                chance = 1 / (1 + np.exp(-np.clip(np.einsum("ij,ij->i", inputs, weights.take(gate, axis=0)), -30, 30)))
                error, spread = steps.bit - chance, chance * (1 - chance)
                columns = np.ascontiguousarray(inputs.T)
                at = iter(range(len(upper[0])))
                for i in range(n):
                    slope[:, i] += np.bincount(gate, error * columns[i], _GATES)
                    spread_i = spread * columns[i]
                    for j in range(i, n):
                        bend[:, next(at)] += np.bincount(gate, spread_i * columns[j], _GATES)
            return np.concatenate([slope, bend], axis=1).ravel()

        for _ in range(rounds):
            found = _summed(docs, newton, _GATES * (n + len(upper[0]))).reshape(_GATES, -1)
            slope = prior * (start - weights) + found[:, :n]
            bend = np.zeros((_GATES, n, n))
            bend[:, upper[0], upper[1]] = bend[:, upper[1], upper[0]] = found[:, n:]
            bend += np.eye(n) * prior
            weights = (weights + np.linalg.solve(bend, slope[:, :, None])[:, :, 0]).astype(np.float32)
        rates = (0.0, 0.001, 0.003, 0.01, 0.03)

        def gains(texts: pa.Array) -> np.ndarray:
            total = np.zeros(len(rates))
            for _, words, places in text_words(texts, most=1 << 19):
                mixer = Mixer(*held.value, weights)
                steps = steps_of(mixer.code, words, places)
                inputs = mixer.inputs(steps)
                for k, mixer.rate in enumerate(rates):
                    total[k] += mixer.log10_probability(steps, inputs).sum()
            return total

        self.rate = max(zip(_summed(docs, gains, len(rates)).tolist(), rates))[1]
        self.weights = weights
        held.destroy()
        return self


def _summed(docs: DataFrame, work, size: int) -> np.ndarray:
    """Sum of what `work` makes, an array of `size` numbers, of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += work(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "value"])

    out = np.zeros(size)
    for row in docs.select("text").mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[row.at] = row.value
    return out


def counted_words(docs: DataFrame) -> DataFrame:
    """(word, spelling, n): every distinct word by 64-bit hash, in lower case, with its count in rows that are not `held_out`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), dtype=bool)
            for first, data, offsets in pieces(batch.column(1), 3 << 19):
                words, starts, ends, which, places = distinct_words(data, offsets)
                counted = np.repeat(~held[first : first + len(places) - 1], np.diff(places))
                n = np.bincount(which, counted, len(words)).astype(np.int64)
                to = np.concatenate([[0], np.cumsum(ends - starts)])
                letters = LOWER[data[np.repeat(starts - to[:-1], ends - starts) + np.arange(to[-1])]]
                spelling = pa.Array.from_buffers(
                    pa.large_string(), len(words), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(letters)]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(words)), spelling.cast(pa.string()), pa.array(n)], names=["word", "spelling", "n"]
                )

    rows = docs.select("held_out", "text").mapInArrow(count, "word long, spelling string, n long")
    return rows.groupBy("word", "spelling").agg(F.sum("n").alias("n"))


def spelled_words(words: DataFrame, spelling: list[np.ndarray]) -> DataFrame:
    """(word, n, spelled): `counted_words` with log10 of each word's spelling in place of the letters."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in pieces(batch.column(1), 1 << 18):
                own = batch.slice(first, len(offsets) - 1)
                spelled = spelling_log10(spelling, data, offsets[:-1], offsets[1:]).astype(np.float32)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(2), pa.array(spelled)], names=["word", "n", "spelled"])

    return words.select("word", "spelling", "n").mapInArrow(spell, "word long, n long, spelled float")


def word_counts(docs: DataFrame, spelling: list[np.ndarray]) -> DataFrame:
    """(word, n, spelled): every word's 64-bit hash, its count in rows that are not `held_out`, and log10 of its spelling."""
    return spelled_words(counted_words(docs), spelling)


def spelled_share(rest: DataFrame, total: int) -> float:
    """Share of the spelling in naming an escaped word: the best with each occurrence left out of its count."""
    shares = [0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98]
    if total < 2:
        return 1.0
    others = (F.col("n") - 1) / F.lit(float(total - 1))
    gains = [F.sum(F.col("n") * F.log((1 - s) * others + s * F.pow(F.lit(10.0), F.col("spelled")))) for s in shares]
    found = rest.agg(*[g.alias(f"g{i}") for i, g in enumerate(gains)]).first()
    return max(zip([x if x is not None else -np.inf for x in found], shares))[1]


def fit(docs: DataFrame, counts: DataFrame, *, frequent: int = 4096, tenth: int = 10, power: int = 20) -> Mixer:
    """Learn from all rows of `docs` that are not `held_out`; `counts` are their word counts.

    `frequent` words are symbols. The tables' size, 2 ** `power` slots for each context, is
    fixed. Of the documents, one in `tenth` by a hash of the id, however many, is set apart: its counts
    are no part of the tables while the gated weights are fitted on all of it, since weights fitted on
    counted texts would trust the counts too much. Then its counts join the tables, which so hold every row.
    """
    learn = docs.where(~F.col("held_out"))
    sums = counts.where(F.col("n") > 0).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    texts = learn.count()
    top = counts.where(F.col("n") > 0).orderBy(F.desc("n"), "word").limit(frequent).toPandas()
    hashes = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    code = Code(
        Vocabulary(hashes), top["n"].to_numpy(np.int64)[order],
        int(sums[0]) + texts, int(sums[1]) + (texts > 0), texts, power,
    )
    apart = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), F.lit(tenth)) == 0
    tables = count_tables(learn.where(~apart).select("text"), code)
    weights = np.zeros((_GATES, len(CONTEXTS) + 1), dtype=np.float32)
    weights[:, 0] = 1.0
    tuning = learn.where(apart).select("text")
    mixer = Mixer(code, *_read_off(tables), weights).tune(tuning)
    tables = [own + more for own, more in zip(tables, count_tables(tuning, code))]
    return Mixer(code, *_read_off(tables), mixer.weights, mixer.rate)


def _read_off(tables: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """What the mixer reads of the counts: log odds by slot, and levels of the first two contexts."""
    odds = [np.log((t[:, 1] + 0.4) / (t[:, 0] + 0.4)).astype(np.float32) for t in tables]
    return odds, [np.digitize(t.sum(axis=1), _LEVELS).astype(np.int8) for t in tables[:2]]


def score(docs: DataFrame, *, folds: int = 5, held: int = 1, **options) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from the documents whose crc32 of the id as text, modulo `folds`, is not `held`,
    and scores all. `base_score` adds log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens,
    from exact counts of words; `score` is the model's log10 probability. `bits_per_byte` is
    null for a text of no bytes.

    Null and empty texts are an end alone. A null id counts as the text "null". Equal ids keep
    their rows. Without any training text all tokens are unknown. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing-model")
    held_out = fold_of("doc_id", folds) == held
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out.alias("held_out"), "text")
    words = scratch.put(counted_words(rows), "words")
    spelling = spelling_tables(words.where(F.col("n") > 0).select(F.col("spelling").alias("text")))
    counts = scratch.put(spelled_words(words, spelling), "counts")
    mixer = fit(rows, counts, **options)
    code = mixer.code
    rest = counts.where(F.col("n") > 0).join(
        F.broadcast(spark.createDataFrame([(x,) for x in signed(code.vocabulary.hashes).tolist()], "word long")), "word", "left_anti"
    )
    spelled = spelled_share(rest, code.rest_total)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, places in text_words(batch.column(1), most=1 << 19):
                steps = steps_of(code, words, places)
                n = len(steps.n_tokens)
                row = batch.column(0).slice(first, n)
                n_bytes = pc.binary_length(batch.column(1).slice(first, n)).fill_null(0).to_numpy()
                facts = [mixer.log10_probability(steps), steps.frequent_log, steps.n_tokens, n_bytes]
                # A fact needs no partner; a hash of its row spreads it over the join's tasks.
                spread = pa.array(signed(mixed(row.to_numpy().view(np.uint64) + U64(1))))
                for kind, values in enumerate(facts, 1):
                    # The first fact brings what the result says of the row: a number made anew in another branch may differ.
                    told = [x.slice(first, n) for x in batch.columns[2:]] if kind == 1 else [pa.nulls(n, x.type) for x in batch.columns[2:]]
                    yield _parts(row, spread, kind, values, told)
                told = [pa.nulls(len(steps.rare), x.type) for x in batch.columns[2:]]
                yield _parts(row.take(pa.array(steps.rare_text)), pa.array(signed(steps.rare)), 0, np.zeros(len(steps.rare)), told)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    parts = rows.select("row", "text", "doc_id", "held_out").mapInArrow(
        apply, f"row long, word long, kind int, value double, doc_id {id_type}, held_out boolean"
    )
    known = parts.join(counts.hint("shuffle_hash"), "word", "left")
    is_rare = F.col("kind") == 0
    share = F.col("n") / F.lit(float(max(code.rest_total, 1)))
    named = (1 - spelled) * share + spelled * F.pow(F.lit(10.0), F.col("spelled"))

    def fact(kind: int):
        return F.sum(F.when(F.col("kind") == kind, F.col("value")))

    summed = known.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
        fact(1).alias("_coded"), fact(2).alias("_frequent_log"),
        fact(3).cast("long").alias("n_tokens"), fact(4).alias("_bytes"),
        F.coalesce(F.sum(F.when(is_rare, F.log10(F.col("n") + F.lit(0.5)))), F.lit(0.0)).alias("_rare_log"),
        F.coalesce(F.sum(F.when(is_rare, F.log10(named))), F.lit(0.0)).alias("_named"),
        F.count(F.when(is_rare & (F.col("n") == 0), 1)).alias("_unknown"),
    )
    all_log = float(np.log10(code.total + 0.5 * (code.distinct + 1)))
    score = F.col("_coded") + F.col("_named")
    return summed.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_tokens") - F.col("_unknown") - F.lit(0 if code.documents else 1)).alias("n_known"),
        F.lit(code.total).cast("long").alias("train_tokens"),
        (F.col("_frequent_log") + F.col("_rare_log") - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        score.alias("score"),
        F.when(F.col("_bytes") > 0, -score * F.lit(float(np.log2(10))) / F.col("_bytes")).alias("bits_per_byte"),
    )


def _parts(row: pa.Array, word: pa.Array, kind: int, values: np.ndarray, told: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [row, word, pa.array(np.full(len(row), kind, np.int32)), pa.array(values.astype(np.float64)), *told],
        names=["row", "word", "kind", "value", "doc_id", "held_out"],
    )
