"""Byte-level BPE over rank files as a monoid: encode parts, join neighbours, reduce as a tree.

A pattern cuts a text into pieces; each piece is encoded by itself: neighbouring tokens whose
joined bytes have the lowest rank merge first, the leftmost among equals, until no joined pair
has a rank. A piece is halved down to `leaf` bytes, leaves are merged plainly, and neighbours are
joined upwards. To join, the tokens next to the boundary are merged anew from their bytes; the
window grows on a side until its outermost token comes out as it went in, or the side ends.

Why this is exact: a sequence of tokens is the encoding of its bytes if and only if each
neighbouring pair is the encoding of the pair's bytes. The merges of a whole piece, looked at
between two tokens only, run in the order in which they run for that pair alone, until a merge
crosses some boundary; so none crosses first if none does for any pair, and none crosses for a
pair if none does in the whole. When the outermost token of a window is unchanged, its pair with
the token outside stood in an encoding before, so all pairs hold.

A text is halved at places where white space follows something else. The pattern begins a piece
there whatever stands around, so the join of such halves has an empty window. Decoding joins the
bytes of halves up the same kind of tree.

Texts of all sizes cost about n log n; memory is that of one text and of 300,000 to 600,000
remembered pieces a process. Null and empty texts have no ids. Equal rows and null ids stay as
they are. Columns that are not asked for are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator, Sequence
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.words import process_cache

T = TypeVar("T")
_PLAIN = 64
_TEXT_LEAF = 1 << 15
_IDS_LEAF = 1 << 14
_YIELD_BYTES = 4 << 20


def reduce_tree(parts: Sequence[T], join: Callable[[T, T], T], empty: T) -> T:
    """Join neighbours level by level."""
    parts = list(parts)
    while len(parts) > 1:
        joined = [join(a, b) for a, b in zip(parts[::2], parts[1::2])]
        parts = joined + parts[len(parts) - len(parts) % 2 :]
    return parts[0] if parts else empty


class Ranks:
    """Tokens of single pieces by a table of ranks; a rank is the token's id."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = 16):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte has no rank")
        self.ranks, self.leaf = ranks, leaf
        self.token_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token_of[rank] = token

    def merge(self, data: bytes) -> list[bytes]:
        """Merge a run of bytes plainly."""
        return self._short(data) if len(data) <= _PLAIN else self._long(data)

    def _short(self, data: bytes) -> list[bytes]:
        rank = self.ranks.get
        tokens = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2]) for i in range(len(data) - 1)]
        while True:
            best = min((p for p in pairs if p is not None), default=None)
            if best is None:
                return tokens
            i = pairs.index(best)
            tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(tokens[i] + tokens[i + 1])
            if i:
                pairs[i - 1] = rank(tokens[i - 1] + tokens[i])

    def _long(self, data: bytes) -> list[bytes]:
        """The same with a heap of pairs; an entry is stale if its tokens have changed since."""
        rank, n = self.ranks.get, len(data)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = after[i]
            if middle < 0 or middle >= n or after[middle] != end:
                continue
            after[i], after[middle] = end, -1
            if end < n:
                before[end] = i
                if (r := rank(data[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (left := before[i]) >= 0 and (r := rank(data[left:end])) is not None:
                heapq.heappush(heap, (r, left, end))
        tokens, i = [], 0
        while i < n:
            tokens.append(data[i : after[i]])
            i = after[i]
        return tokens

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """Encoding of the bytes of two encodings."""
        if not left or not right:
            return left + right
        a = b = 1
        while True:
            first, last = max(0, len(left) - a), min(len(right), b)
            window = self.merge(b"".join(left[first:] + right[:last]))
            stays = first == 0 or window[0] == left[first]
            ends = last == len(right) or window[-1] == right[last - 1]
            if stays and ends:
                return left[:first] + window + right[last:]
            a, b = (a if stays else 2 * a), (b if ends else 2 * b)

    def tokens(self, data: bytes) -> list[bytes]:
        """Encoding of a run of bytes by halving and joining."""
        parts = max(1, -(-len(data) // self.leaf))
        cuts = [len(data) * k // parts for k in range(parts + 1)]
        return reduce_tree([self.merge(data[i:j]) for i, j in zip(cuts, cuts[1:])], self.join, [])

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece; a piece that has a rank itself is one token."""
        own = self.ranks.get(data)
        return [own] if own is not None else [self.ranks[t] for t in self.tokens(data)]


class Coder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers, and back."""

    def __init__(self, ranks: Ranks, pattern: str, limit: int = 300_000):
        import regex

        self.ranks, self.limit = ranks, limit
        self.pattern = regex.compile(pattern)
        self.cut, self.cut_before = regex.compile(r"(?<=\S)(?=\s)"), regex.compile(r"(?r)(?<=\S)(?=\s)")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(self.ranks.piece(piece.encode()), "<u4").tobytes()
        # Long pieces come once; the rest is kept while it keeps being used.
        if len(piece) <= 64:
            if len(self.known) >= self.limit:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def _leaf(self, text: str) -> bytes:
        known = self.known
        return b"".join([known.get(p) or self._piece(p) for p in self.pattern.findall(text)])

    def _leaves(self, text: str) -> Iterator[str]:
        """Parts of a text of about the leaf size, cut where a piece begins in any surroundings."""
        todo = [(0, len(text))]
        while todo:
            first, last = todo.pop()
            found = None
            if last - first > _TEXT_LEAF:
                middle = (first + last) // 2
                found = self.cut.search(text, middle, last) or self.cut_before.search(text, first + 1, middle)
            at = found.start() if found else last
            if found and first < at < last:
                todo += [(at, last), (first, at)]
            else:
                yield text[first:last]

    def encode(self, text: str) -> bytes:
        if len(text) <= _TEXT_LEAF:
            return self._leaf(text)
        return reduce_tree([self._leaf(part) for part in self._leaves(text)], bytes.__add__, b"")

    def decode(self, ids: bytes) -> bytes:
        token_of = self.ranks.token_of
        numbers = np.frombuffer(ids, "<u4")
        leaves = [
            b"".join([token_of[i] for i in numbers[k : k + _IDS_LEAF].tolist()]) for k in range(0, len(numbers), _IDS_LEAF)
        ]
        return reduce_tree(leaves, bytes.__add__, b"")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def coder(path: str, pattern: str) -> Coder:
    """The worker's coder of a file: it outlives the task."""
    cache = process_cache()
    if ("coder", path, pattern) not in cache:
        cache["coder", path, pattern] = Coder(Ranks(read_ranks(path)), pattern)
    return cache["coder", path, pattern]


def _mapped(frame: DataFrame, column: str, added: str, work: Callable[[], Callable[[object], bytes]]) -> DataFrame:
    """Replace `column` by a binary column: the result of a function for each value, null as it stands."""
    rest = [c for c in frame.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = work()
        for batch in batches:
            kept, first, out, size = batch.select(rest), 0, [], 0
            values = batch.column(len(rest))
            for k in range(len(values)):
                out.append(apply(values[k].as_py()))
                size += len(out[-1])
                if size > _YIELD_BYTES or k + 1 == len(values):
                    own = kept.slice(first, k + 1 - first)
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(out, pa.binary())], [*rest, added])
                    first, out, size = k + 1, [], 0

    source = frame.select(*(F.col(f"`{c}`") for c in [*rest, column]))
    schema = source.drop(column).schema.add(added, "binary")
    return source.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: str, pattern: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and `ids` of every text: unsigned 32-bit integers, little-endian. A null text counts as empty."""

    def work():
        own = coder(ranks, pattern)
        return lambda value: own.encode(value or "")

    return _mapped(docs.select(F.col(key), F.col(text)), text, "ids", work)


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """`encoded` and the `bytes` that its ids stand for."""

    def work():
        own = coder(ranks, pattern)
        return lambda value: own.decode(value or b"")

    # The ids go in twice: once to be replaced, once to stay.
    return _mapped(encoded.withColumn("_decoded", F.col("ids")), "_decoded", "bytes", work)
