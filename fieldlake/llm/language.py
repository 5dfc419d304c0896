"""Language of texts by cross-parsing with suffix automata.

Each language has a suffix automaton of a bounded number of labelled documents, taken whole. A
text is cut into the longest phrases that occur in a language's text; the language that needs the fewest
phrases, normalised by the logarithm of its text's length, wins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.llm.common import fold_of
from fieldlake.llm.words import U64, pieces

UNKNOWN = "und"
_SEGMENT = 1024


def transitions(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Suffix automaton of a sequence: (state, symbol, next state) of each transition, and the number of states.

    There are at most two states and three transitions a symbol, whatever the alphabet.
    """
    steps: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols.tolist():
        new = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at != -1 and symbol not in steps[at]:
            steps[at][symbol] = new
            at = link[at]
        if at != -1:
            to = steps[at][symbol]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(steps)
                steps.append(dict(steps[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at != -1 and steps[at].get(symbol) == to:
                    steps[at][symbol] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    sizes = np.fromiter(map(len, steps), np.int64, len(steps))
    total = int(sizes.sum())
    by = np.fromiter(chain.from_iterable(steps), np.int64, total)
    to = np.fromiter(chain.from_iterable(x.values() for x in steps), np.int64, total)
    return np.repeat(np.arange(len(steps)), sizes), by, to, len(steps)


def suffix_automaton(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """Transitions (state, symbol) -> state of the suffix automaton of a sequence, -1 for none."""
    state, symbol, to, n = transitions(symbols)
    steps = np.full((n, alphabet), -1, dtype=np.int32)
    steps[state, symbol] = to
    return steps


class Lookup:
    """Non-negative integer keys -> state, -1 for others, by open addressing in tables at most half full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.power = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.power, -1, dtype=np.int64)
        self.values = np.full(1 << self.power, -1, dtype=np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[left[free]]
            lost = self.keys[slot] != keys[left]
            self.values[slot[~lost]] = values[left[~lost]]
            left, slot = left[lost], (slot[lost] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * U64(0x9E3779B97F4A7C15) >> U64(64 - self.power)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        there = self.keys[slot]
        out = self.values[slot]
        left = np.flatnonzero(there != keys)
        out[left] = -1
        left = left[there[left] >= 0]
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.keys) - 1)
            there = self.keys[slot]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            left, slot = left[on], slot[on]
        return out


@dataclass
class Parser:
    """Automata of all languages in one table by state * alphabet + symbol; `first` has the steps from each root."""

    languages: list[str]
    symbol_of: np.ndarray
    alphabet: int
    steps: Lookup
    roots: np.ndarray
    first: np.ndarray
    scale: np.ndarray

    def symbols(self, points: np.ndarray) -> np.ndarray:
        return self.symbol_of[points]

    def phrases(self, segments: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each segment in each language; segments are columns, longest first."""
        count = np.zeros((len(self.languages), len(lengths)), dtype=np.int32)
        state = np.repeat(self.roots[:, None], len(lengths), axis=1)
        active = np.searchsorted(-lengths, -np.arange(segments.shape[0]), "left")
        for t in range(segments.shape[0]):
            n = active[t]
            if not n:
                break
            symbol = segments[t, :n]
            own = state[:, :n]
            following = self.steps.find((own * self.alphabet + symbol).ravel()).reshape(own.shape)
            ended = following < 0
            count[:, :n] += ended
            if ended.any():
                lang, column = np.nonzero(ended)
                again = self.first[lang, symbol[column]]
                following[lang, column] = np.where(again < 0, self.roots[lang], again)
            state[:, :n] = following
        return count + 1

    def rates(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Normalised phrases of each text by language, and whether it has a letter."""
        total = np.zeros((len(texts), len(self.languages)))
        letters = np.zeros(len(texts), dtype=bool)
        for first, data, offsets in pieces(texts):
            points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
            symbols = self.symbols(points)
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(starts))
            letter = symbols > 0
            own = np.bincount(owner[letter], minlength=len(offsets) - 1) > 0
            letters[first : first + len(own)] = own
            # Runs of what is no letter count as one space.
            keep = np.ones(len(symbols), dtype=bool)
            keep[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0) | (owner[1:] != owner[:-1])
            symbols, owner = symbols[keep], owner[keep]
            begin = np.searchsorted(owner, np.arange(len(offsets)))
            size = np.diff(begin)
            parts = -(-size // _SEGMENT)
            text = np.repeat(np.arange(len(size)), parts)
            nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
            at = begin[:-1][text] + nth * _SEGMENT
            length = np.minimum(_SEGMENT, begin[1:][text] - at)
            order = np.argsort(-length, kind="stable")
            at, length, text = at[order], length[order], text[order]
            if not len(at):
                continue
            table = np.zeros((int(length[0]), len(at)), dtype=np.int64)
            column = np.repeat(np.arange(len(at)), length)
            row = np.arange(len(column)) - np.repeat(np.cumsum(length) - length, length)
            table[row, column] = symbols[at[column] + row]
            count = self.phrases(table, length)
            for k in range(len(self.languages)):
                total[first : first + len(size), k] += np.bincount(text, count[k], len(size)) * self.scale[k]
        return total, letters

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text: how far the second language is behind, from 0.5 to 1."""
        n = len(texts)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        total, letters = self.rates(texts)
        best = total.argmin(axis=1)
        ranked = np.sort(total, axis=1)
        first = ranked[:, 0]
        second = ranked[:, 1] if len(self.languages) > 1 else np.full(n, np.inf)
        score = np.where(np.isinf(second), 1.0, second / np.maximum(first + second, 1e-9))
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)], np.where(letters, score, 0.0)


def parser_of(texts: dict[str, list[str]]) -> Parser:
    """Automata of all of the texts.

    The alphabet has every letter of the texts in lower case, one symbol for all other
    letters, and the space.
    """
    languages = sorted(texts)
    joined = {x: "\n".join(texts[x]).lower() for x in languages}
    number = {c: i + 2 for i, c in enumerate(sorted({c for x in joined.values() for c in set(x) if c.isalpha()}))}
    symbol_of = np.zeros(sys.maxunicode + 1, dtype=np.int32)
    for point in range(sys.maxunicode + 1):
        c = chr(point)
        if c.isalpha():
            symbol_of[point] = number.get(c.lower()[:1], 1)
    alphabet = len(number) + 2
    keys, values, roots, at = [], [], [], 0
    first = np.full((len(languages), alphabet), -1, dtype=np.int32)
    for k, x in enumerate(languages):
        symbols = symbol_of[np.frombuffer(joined[x].encode("utf-32-le", "surrogatepass"), np.uint32)]
        keep = np.ones(len(symbols), dtype=bool)
        keep[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0)
        state, symbol, to, n = transitions(symbols[keep])
        keys.append((state + at) * alphabet + symbol)
        values.append(to + at)
        first[k, symbol[state == 0]] = to[state == 0] + at
        roots.append(at)
        at += n
    scale = np.array([np.log2(max(2, len(joined[x]))) for x in languages])
    none = [np.zeros(0, np.int64)]
    steps = Lookup(np.concatenate(keys or none), np.concatenate(values or none))
    return Parser(languages, symbol_of, alphabet, steps, np.array(roots, dtype=np.int64), first, scale)


def fit(
    docs: DataFrame, *, folds: int = 3, held: int = 1, per_language: int = 60, longest: int = 4000, most: int = 1_000_000
) -> Parser:
    """Learn from at most `per_language` documents of each language, never of the held-out fold.

    The documents are those of up to `longest` characters whose ids hash smallest; a language
    with fewer of that size learns from longer ones too, short ones first, which are also taken
    whole. Together they have at most `most` characters. A language whose shortest document has
    more learns from 16 even pieces of it, `most` characters in all. Repeated rows count once.
    Documents are chosen by length and hash; only the texts of the chosen ones move.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id", folds) != held))
    known = known.select("lang", "doc_id", "text", F.length("text").cast("long").alias("_size"), F.xxhash64("text").alias("_text"))
    thin = known.select("lang", "doc_id", "_size", "_text", F.xxhash64("doc_id").alias("_h")).distinct()
    first = Window.partitionBy("lang").orderBy(F.greatest("_size", F.lit(longest)), "_h", "doc_id", "_text")
    chosen = thin.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= per_language)
    chosen = chosen.withColumn("_sum", F.sum("_size").over(first.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    chosen = chosen.where((F.col("_sum") <= most) | (F.col("_n") == 1)).alias("c")
    # A small number of rows a language.
    same = [F.col(f"k.{x}") == F.col(f"c.{x}") for x in ("lang", "_size", "_text")]
    found = known.alias("k").join(F.broadcast(chosen), [F.col("k.doc_id").eqNullSafe(F.col("c.doc_id")), *same])
    size = F.col("k._size")
    parts = [
        F.substring(F.col("text"), (F.floor(size * k / 16) + 1).cast("int"), F.lit(max(1, most // 16))) for k in range(16)
    ]
    text = F.when(size > most, F.concat_ws("\n", *parts)).otherwise(F.col("text"))
    rows = found.groupBy("c.lang", "c._n").agg(F.first(text).alias("text")).collect()
    texts: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["_n"])):
        texts.setdefault(row["lang"], []).append(row["text"])
    return parser_of(texts)


def identify(docs: DataFrame, parser: Parser) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every document, from its whole text alone.

    Null texts and texts without a letter: `und`, score 0. Ties go to the first language by
    code point. Null and repeated ids keep their rows. Other columns are ignored.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = parser.predict(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {kind}, lang_pred string, score double")
