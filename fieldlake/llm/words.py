"""Words of a batch of texts as 64-bit hashes, computed for whole Arrow buffers at once."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE_BYTES = 1 << 20


def _byte_classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    spaced = np.ones(256, dtype=bool)
    spaced[[0x20, 9, 10, 11, 12, 13]] = False
    plain = np.zeros(256, dtype=bool)
    plain[0x30:0x3A] = plain[0x61:0x7B] = plain[0x41:0x5B] = True
    plain[0x80:] = True
    return lower, spaced, plain


#: Lower case of A-Z; bytes of words split at white space; bytes of words of letters and digits.
LOWER, SPACED, PLAIN = _byte_classes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * U64(_BASE))


def process_cache() -> dict:
    """Values that live as long as the process; no job carries them along, unlike a module's own globals."""
    return vars(sys.modules.setdefault("fieldlake_process", types.ModuleType("fieldlake_process")))


def _powers(name: str, factor: int, size: int) -> np.ndarray:
    cache = process_cache()
    known = cache.get(name)
    if known is None or len(known) < size:
        steps = np.full(max(size, _PIECE_BYTES), factor, dtype=np.uint64)
        steps[0] = 1
        known = cache[name] = np.multiply.accumulate(steps)
    return known[:size]


def pieces(texts: pa.Array, most: int = _PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `most` bytes: (first index, bytes, offsets)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = SPACED):
    """Starts and ends of words in bytes, and for each text the index of its first word (one more at the end)."""
    within = inside[data]
    first, last = within.copy(), within.copy()
    if len(data):
        first[1:] &= ~within[:-1]
        last[:-1] &= ~within[1:]
        cuts = offsets[:-1][offsets[:-1] < len(data)]
        first[cuts] = within[cuts]
        cuts = cuts[cuts > 0] - 1
        last[cuts] = within[cuts]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = LOWER) -> np.ndarray:
    """64-bit hash of each word, lower-cased in A-Z unless `fold` says otherwise."""
    return prefix_hashes(data, starts, [ends], fold)[0]


def prefix_hashes(data: np.ndarray, starts: np.ndarray, several: list[np.ndarray], fold: np.ndarray | None = LOWER) -> list[np.ndarray]:
    """`word_hashes` for several ends of the same words, from one pass over the bytes."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    values = (_VALUES if fold is None else _VALUES[fold]).take(data)
    values *= _powers("up", _BASE, len(data))
    np.cumsum(values, out=total[1:])
    before, down = total.take(starts), _powers("down", _INVERSE, len(data) + 1).take(starts)
    return [mixed((total.take(ends) - before) * down + (ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93)) for ends in several]


def hash_word(word: str) -> int:
    """The hash of one word, as `word_hashes` computes it."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(data)]))[0])


def text_words(texts: pa.Array, inside: np.ndarray = SPACED, most: int = _PIECE_BYTES):
    """Runs of texts: (first index, word hashes, index of each text's first word)."""
    for first, data, offsets in pieces(texts, most):
        starts, ends, places = word_bounds(data, offsets, inside)
        yield first, word_hashes(data, starts, ends), places


def grams(words: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each `n` consecutive words within a text, and for each text the index of its first.

    A text with fewer words, but at least one, gives one hash of all its words.
    """
    counts = np.diff(places)
    size = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(size, out=out[1:])
    rolled = np.zeros(max(len(words) - n + 1, 0), dtype=np.uint64)
    for k in range(n):
        rolled = rolled * U64(_BASE) + words[k : k + len(rolled)]
    full = counts >= n
    where = np.repeat(places[:-1] - out[:-1], size) + np.arange(out[-1])
    value = np.zeros(out[-1], dtype=np.uint64)
    is_full = np.repeat(full, size)
    value[is_full] = mixed(rolled[where[is_full]])
    short = np.flatnonzero((counts > 0) & ~full)
    own = counts[short].astype(np.uint64)
    for k in range(n - 1):
        more = counts[short] > k
        own[more] = mixed(own[more] * U64(_BASE) + words[places[:-1][short[more]] + k])
    value[out[:-1][short]] = own
    return value, out


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as Spark's long."""
    return values.view(np.int64)
