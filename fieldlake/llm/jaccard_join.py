"""Documents whose word shingles overlap by a Jaccard similarity, joined by T-occurrence search.

Two documents link when 100 * |intersection| >= percent * |union|. The steps:

1. Equal sets are one node; all that follows works on nodes.
2. Shingles are ordered rare first: those that no two nodes were seen to share, those that
   some share, and those of a table of the most frequent ones. Table and set are bounded in
   size; any order that all documents share gives the same links. So what many documents have
   in common, such as a passage, makes candidates only of documents that have little else.
3. A node's short inverted lists are those of its first shingles in that order: as many as it
   must share one of with any partner. Lists with one node are dropped before they are built.
4. In rounds, each node is compared with one node of another component: of the nodes that head
   its lists, the one that heads most. Linked nodes are contracted, so a group of copies costs
   its size, not its square. Rounds only save work; how many there are changes no result.
5. What is left is searched list by list, in divisions of set size and cells of bounded blocks.
   A list is never joined with itself: a cell's task holds its members and writes only pairs of
   different components that the order, the sizes and the parity sketches of both sets let
   reach the overlap. The sketches differ in no more bits than the sets in shingles, so no link
   between components is lost. First a search writes one such pair of each member alone, and
   what links is contracted, in turns until members have few candidates in other components;
   then a search writes every candidate that is left. A member that met no candidate in a list
   leaves it, so that later searches move only what may still link.
6. Comparing is DivideSkip: for one query node and a block of candidates, counts from merged
   short lists, then binary probes into the long lists for those still in reach.

The result has components, and each link that joins different components was tested exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.common import Scratch
from fieldlake.llm.graph import components
from fieldlake.llm.words import U64, grams, mixed, signed, text_words

_BLOCK = 512
_RUN_BYTES = 1 << 20
#: Members of a list in one block; pairs that a search looks at together; bits of a sketch, as a power of two, and of a folded one at least.
_CELL, _PAIRS, _SKETCH, _FOLDED = 2048, 1 << 18, 11, 8
#: Searches for one candidate each, at most; they end when a member has at most so many, or so small a share of them links.
_TURNS, _FEW, _SHARE = 6, 1.5, 1 / 16


class Sets:
    """Distinct sorted shingle hashes of a run of texts."""

    def __init__(self, words: np.ndarray, places: np.ndarray, n: int):
        values, starts = grams(words, places, n)
        for a, b in zip(starts[:-1], starts[1:]):
            values[a:b].sort()
        keep = np.ones(len(values), dtype=bool)
        keep[1:] = values[1:] != values[:-1]
        keep[starts[:-1][starts[:-1] < len(values)]] = True
        kept = np.concatenate([[0], np.cumsum(keep)])
        self.values, self.starts = values[keep], kept[starts]
        self.sizes = np.diff(self.starts)
        total = np.zeros(len(self.values) + 1, dtype=np.uint64)
        np.cumsum(mixed(self.values), out=total[1:])
        self.digests = mixed((total[self.starts[1:]] - total[self.starts[:-1]]) ^ mixed(self.sizes.astype(np.uint64)))

    def of(self, i: int) -> np.ndarray:
        return self.values[self.starts[i] : self.starts[i + 1]]

    def distinct(self) -> np.ndarray:
        """Indexes of the first text of each nonempty set."""
        full = np.flatnonzero(self.sizes > 0)
        return full[np.sort(np.unique(self.digests[full], return_index=True)[1])]


def sketches(sets: Sets, chosen: np.ndarray) -> np.ndarray:
    """For each chosen set, which of 2 ** `_SKETCH` classes of hashes hold an odd number of its shingles, as bits."""
    number = np.full(len(sets.sizes), -1)
    number[chosen] = np.arange(len(chosen))
    owner = np.repeat(number, sets.sizes)
    own = owner >= 0
    keys = (owner[own] << _SKETCH) | (sets.values[own] & U64((1 << _SKETCH) - 1)).astype(np.int64)
    found, times = np.unique(keys, return_counts=True)
    odd = found[times & 1 == 1]
    out = np.zeros((len(chosen) << _SKETCH) >> 6, dtype=np.uint64)
    if len(odd):
        first = np.flatnonzero(np.concatenate([[True], (odd[1:] >> 6) != (odd[:-1] >> 6)]))
        out[odd[first] >> 6] = np.bitwise_or.reduceat(U64(1) << (odd & 63).astype(np.uint64), first)
    return out.reshape(len(chosen), -1)


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch in half as many classes, and again, while these are as many as the set's shingles: few bytes for small sets."""
    while len(sketch) << 5 >= max(size, 1 << _FOLDED):
        sketch = _halved(sketch)
    return sketch


def _halved(sketches: np.ndarray) -> np.ndarray:
    """Sketches by one bit less of the hashes. They still differ in no more bits than the sets in shingles."""
    half = sketches.shape[-1] // 2
    return sketches[..., :half] ^ sketches[..., half:]


class Sketches:
    """Folded sketches of different lengths; two are compared at the length of the shorter."""

    def __init__(self, sketches: pa.Array):
        self.words = pc.binary_length(sketches).to_numpy(zero_copy_only=False) >> 3
        raw, self.at = sketches.to_pylist(), {}
        rows, matrix = np.zeros(0, dtype=np.int64), None
        for words in np.unique(self.words)[::-1].tolist():
            own = np.flatnonzero(self.words == words)
            same = np.frombuffer(b"".join(raw[i] for i in own.tolist()), np.uint64).reshape(len(own), words)
            while matrix is not None and matrix.shape[1] > words:
                matrix = _halved(matrix)
            matrix = same if matrix is None else np.concatenate([matrix, same])
            rows = np.concatenate([rows, own])
            place = np.full(len(raw), -1)
            place[rows] = np.arange(len(rows))
            self.at[words] = place, matrix

    def differ(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """In how many bits the sketches of each two rows differ."""
        out = np.zeros(len(x), dtype=np.int64)
        words = np.minimum(self.words[x], self.words[y])
        for length, (place, matrix) in self.at.items():
            here = np.flatnonzero(words == length)
            for k in range(0, len(here), 1 << 14):
                own = here[k : k + (1 << 14)]
                out[own] = np.bitwise_count(matrix[place[x[own]]] ^ matrix[place[y[own]]]).sum(axis=1, dtype=np.int64)
        return out


class Order:
    """Rare shingles first: by hash those that are not `seen`, then those that are, then the table's by count."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray, seen: "Bits | None" = None):
        self.seen = seen
        order = np.argsort(shingles)
        self.shingles, self.counts = shingles[order], counts[order]
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(shingles >> U64(40)).astype(np.int64) & 0xFFFFF] = True

    def frequent(self, values: np.ndarray) -> np.ndarray:
        out = self.bits[(values >> U64(40)).astype(np.int64) & 0xFFFFF]
        if out.any():
            asked = values[out]
            at = np.minimum(np.searchsorted(self.shingles, asked), len(self.shingles) - 1)
            out[out] = self.shingles[at] == asked
        return out

    def prefixes(self, sets: Sets, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First shingles of each distinct set: (text index, shingle, position in the order)."""
        chosen = sets.distinct()
        often = self.frequent(sets.values)
        seen = ~often & self.seen.may_hold(sets.values) if self.seen else np.zeros(len(often), dtype=bool)
        owner = np.repeat(np.arange(len(sets.sizes)), sets.sizes)

        def counted(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of each set's marked shingles: how many stand before each shingle, and how many there are."""
            before = np.concatenate([[0], np.cumsum(mark)])
            return before[:-1] - before[sets.starts[:-1]][owner], before[sets.starts[1:]] - before[sets.starts[:-1]]

        new_before, new_size = counted(~often & ~seen)
        seen_before, seen_size = counted(seen)
        place = np.where(seen, new_size[owner] + seen_before, new_before)
        length = prefix_length(sets.sizes, percent)
        wanted = np.zeros(len(sets.sizes), dtype=bool)
        wanted[chosen] = True
        rare = ~often & wanted[owner] & (place < length[owner])
        owners, values, places = [owner[rare]], [sets.values[rare]], [place[rare]]
        rare_size = new_size + seen_size
        for i in np.flatnonzero(wanted & (rare_size < length)):
            own = slice(sets.starts[i], sets.starts[i + 1])
            rest = sets.values[own][often[own]]
            rest = rest[np.lexsort((rest, self.counts[np.searchsorted(self.shingles, rest)]))]
            rest = rest[: length[i] - rare_size[i]]
            owners.append(np.full(len(rest), i))
            values.append(rest)
            places.append(rare_size[i] + np.arange(len(rest)))
        return np.concatenate(owners), np.concatenate(values), np.concatenate(places)


def least_overlap(size_a, size_b, percent: int):
    """Overlap that sets of these sizes must reach."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def prefix_length(sizes: np.ndarray, percent: int) -> np.ndarray:
    return sizes - (-(-percent * sizes // 100)) + 1


def divide_skip(query: np.ndarray, sets: list[np.ndarray], needs: np.ndarray, mu: float = 0.5) -> np.ndarray:
    """Overlap of a sorted set with each of `sets` that reaches its need, else 0.

    The inverted lists of the query's elements over the candidates are divided by length. The
    short ones are merged to counts; the `skipped` longest are probed by binary search, and
    only for candidates that could still reach their need.
    """
    n = len(sets)
    if not n or not len(query):
        return np.zeros(n, dtype=np.int64)
    everything = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    element = np.minimum(np.searchsorted(query, everything), len(query) - 1)
    hit = query[element] == everything
    element, owner = element[hit], owner[hit]
    lengths = np.bincount(element, minlength=len(query))
    least = int(max(1, needs.min()))
    skipped = max(0, min(least - 1, int(least / (mu * np.log2(max(2, lengths.max(initial=1))) + 1))))
    is_long = np.zeros(len(query), dtype=bool)
    is_long[np.argsort(lengths, kind="stable")[len(query) - skipped :]] = True
    counts = np.bincount(owner[~is_long[element]], minlength=n)
    alive = np.flatnonzero(counts >= np.maximum(needs - skipped, 0))
    if skipped and len(alive):
        posted = is_long[element]
        lists = np.sort(element[posted] * n + owner[posted])
        if len(lists):
            asked = (np.flatnonzero(is_long)[:, None] * n + alive[None, :]).ravel()
            at = np.minimum(np.searchsorted(lists, asked), len(lists) - 1)
            found = (lists[at] == asked).reshape(-1, len(alive))
            counts[alive] += found.sum(axis=0)
    out = np.zeros(n, dtype=np.int64)
    reached = alive[counts[alive] >= needs[alive]]
    out[reached] = counts[reached]
    return out


def shingle_sets(docs: DataFrame, n: int = 5, common_run: int = 1_000_000) -> DataFrame:
    """doc_id, n_shingles, digest of the set, and shingles that several texts of a run share.

    `common` stands at the first text of each run of about `common_run` shingles: those that
    at least two different sets of the run have, with their number there.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, held = [], 0
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            digests = np.zeros(batch.num_rows, dtype=np.uint64)
            common: list = [None] * batch.num_rows

            def settle(at: int) -> None:
                nonlocal kept, held
                if kept:
                    values, n_sets = np.unique(np.concatenate(kept), return_counts=True)
                    several = n_sets > 1
                    common[at] = list(zip(signed(values[several]).tolist(), n_sets[several].tolist()))
                kept, held = [], 0

            for first, words, places in text_words(batch.column(1), most=_RUN_BYTES):
                sets = Sets(words, places, n)
                counts[first : first + len(sets.sizes)] = sets.sizes
                digests[first : first + len(sets.sizes)] = sets.digests
                wanted = np.zeros(len(sets.sizes), dtype=bool)
                wanted[sets.distinct()] = True
                kept.append(sets.values[np.repeat(wanted, sets.sizes)])
                held += len(kept[-1])
                if held >= common_run:
                    settle(first)
            if batch.num_rows:
                settle(batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(signed(digests)), pa.array(common, _COMMON)],
                names=["doc_id", "n_shingles", "digest", "common"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        summarise, f"doc_id {_id_type(docs)}, n_shingles long, digest long, common array<struct<shingle:long,n:long>>"
    )


_COMMON = pa.list_(pa.struct([("shingle", pa.int64()), ("n", pa.int64())]))


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def frequent_shingles(sets: DataFrame, most: int = 1 << 17, least: int = 16) -> Order:
    """The order of shingles; at most `most` of them are listed, which bounds its size."""
    counted = sets.select(F.explode("common").alias("c")).groupBy("c.shingle").agg(F.sum("c.n").alias("n"))
    found = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "shingle").limit(most).toPandas()
    return Order(found["shingle"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64))


def _prefix_counts(docs: DataFrame, order: Order, n: int, percent: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, places in text_words(batch.column(0), most=_RUN_BYTES):
                values, times = np.unique(order.prefixes(Sets(words, places, n), percent)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(values)), pa.array(times)], names=["shingle", "n"])

    return docs.select("text").mapInArrow(count, "shingle long, n long")


class Bits:
    """Set of hashes as bits, with false positives; its size stops at 2 ** `most_power` bits.

    Tasks get it as a broadcast of that size; `release` ends it once the tables made with it are stored.
    """

    def __init__(self, hashes: DataFrame, count: int, most_power: int = 27):
        self.power = min(most_power, max(16, (8 * count).bit_length()))
        place = F.shiftrightunsigned("shingle", 64 - self.power) + 1
        blocks = hashes.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
        )
        words = np.zeros(1 << (self.power - 3), dtype=np.uint8)
        # At most 2 ** (most_power - 15) rows of 4 kB.
        for row in blocks.collect():
            at = (row.block - 1) * len(row.bits)
            words[at : at + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
        self.words = hashes.sparkSession.sparkContext.broadcast(words.view(np.uint32))

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        at = (values >> U64(64 - self.power)).astype(np.int64)
        return (self.words.value[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1

    def release(self) -> None:
        self.words.destroy()


def _postings(docs: DataFrame, order: Order, shared: Bits, n: int, percent: int) -> DataFrame:
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, places in text_words(batch.column(0), most=_RUN_BYTES):
                sets = Sets(words, places, n)
                owner, values, at = order.prefixes(sets, percent)
                keep = shared.may_hold(values)
                owner, values, at = owner[keep], values[keep], at[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(values)), pa.array(signed(sets.digests[owner])),
                     pa.array(sets.sizes[owner].astype(np.int32)), pa.array(at.astype(np.int32))],
                    names=["shingle", "node", "size", "at"],
                )

    return docs.select("text").mapInArrow(post, "shingle long, node long, size int, at int")


def _may_link(a: str, b: str, percent: int) -> F.Column:
    """By component, by size, and by what can follow the first shingle that both have."""
    size_a, size_b = F.col(f"{a}.size"), F.col(f"{b}.size")
    need = F.ceil(F.lit(percent) * (size_a + size_b) / F.lit(100 + percent))
    ahead = F.least(size_a - F.col(f"{a}.at"), size_b - F.col(f"{b}.at"))
    fits = (F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * percent) & (ahead >= need)
    return fits & (F.col(f"{a}.component") != F.col(f"{b}.component"))


def _open_lists(lists: DataFrame, merged: DataFrame) -> DataFrame:
    """The postings of lists with several components, with components."""
    own = lists.join(merged, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = own.groupBy("shingle").agg(F.min("component").alias("_a"), F.max("component").alias("_b"))
    return own.join(several.where("_a < _b").select("shingle"), "shingle")


def _met_heads(lists: DataFrame, turn: int) -> DataFrame:
    """Every posting (y) with the head (x) of its list in this turn, but for the head itself."""
    heads = lists.groupBy("shingle").agg(
        F.min(F.struct(F.xxhash64(F.col("node"), F.lit(turn)).alias("_turn"), "node", "component", "size", "at")).alias("h")
    )
    met = lists.alias("y").join(heads.select("shingle", "h.*").alias("x"), "shingle")
    return met.where(F.col("x.node") != F.col("y.node"))


def _head_pairs(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """Heads and members (a, b), with the number of their common lists in which they may link."""
    return _met_heads(lists, turn).groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(
        F.count_if(_may_link("x", "y", percent)).alias("n")
    )


def _one_each(pairs: DataFrame) -> DataFrame:
    """For every node at most one candidate (a, b): the head of most of its lists."""
    best = pairs.where(F.col("n") > 0).groupBy("b").agg(F.max(F.struct("n", "a")).alias("best"))
    return best.select("best.a", "b", F.col("best.a").alias("place"))


def _still_open(lists: DataFrame, pairs: DataFrame, merged: DataFrame, scratch: Scratch) -> DataFrame:
    """The lists that may still hold several components after the first turn, whole.

    A list does if a member is not in its head's component. Those pairs are known from the
    first turn; a bounded set of bits finds their lists without moving the postings.
    """
    a, b = (merged.select(F.col("node").alias(x), F.col("component").alias(f"_{x}")) for x in "ab")
    crossing = pairs.join(a, "a", "left").join(b, "b", "left")
    crossing = crossing.where(F.coalesce("_a", "a") != F.coalesce("_b", "b"))
    crossing = scratch.put(crossing.select(F.xxhash64("a", "b").alias("shingle")), "crossing")
    wanted = Bits(crossing, crossing.count())

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = wanted.may_hold(batch.column(1).to_numpy().view(np.uint64))
            yield batch.select([0]).filter(pa.array(kept))

    keyed = _met_heads(lists, 0).select("shingle", F.xxhash64("x.node", "y.node").alias("pair"))
    found = keyed.mapInArrow(choose, "shingle long").distinct()
    return lists.join(found, "shingle", "left_semi").drop("component")


def _cells(lists: DataFrame, percent: int) -> DataFrame:
    """The postings by cell: list, division of set size, and two blocks of the list's members there.

    Sets of linked documents lie in one division or in neighbours, so a member is at home in its
    own division and a guest in the one below. A cell holds two blocks at most.
    """
    size = F.col("size").cast("long")
    # A little wider than the ratio of sizes that may link, against rounding.
    division = F.floor(F.log("size") / F.lit(float(np.log(100 / percent)) * (1 + 1e-9))) if percent < 100 else size
    homes = F.array(
        F.struct(division.alias("division"), F.lit(False).alias("guest")),
        F.struct((division - 1).alias("division"), F.lit(True).alias("guest")),
    )
    posted = lists.withColumn("_home", F.explode(homes)).select("shingle", "_home.*", "node", "size", "at", "component")
    held = posted.groupBy("shingle", "division").agg(
        F.count("*").alias("_n"), F.min("component").alias("_a"), F.max("component").alias("_b"), F.min("guest").alias("_g")
    )
    held = held.where(~F.col("_g") & (F.col("_a") < F.col("_b")))
    blocks = F.ceil(F.col("_n") / _CELL).cast("int")
    dealt = posted.join(held.select("shingle", "division", blocks.alias("_k")), ["shingle", "division"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), "_k").cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    low, high = F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high")
    return dealt.select("shingle", "division", low, high, "block", "guest", "node", "size", "at", "component")


def _searched(rows: pa.RecordBatch, percent: int, turn: int | None) -> Iterator[pa.RecordBatch]:
    """Candidates (a, b, place, n, rank) of the whole cells in `rows`, which are ordered by cell and node.

    Without a `turn` all of them. With one, each member (b) has at most one of its cell's candidates
    (a) that stand after it, and their number: in the first turn the one whose sketch is nearest,
    later any by a hash. A member whose candidates all stand before it has itself, and n is 0.
    """
    if not rows.num_rows:
        return
    shingle, division, low, high, block, node, size, at, component = (
        rows.column(name).to_numpy() for name in ("shingle", "division", "low", "high", "block", "node", "size", "at", "component")
    )
    guest = rows.column("guest").to_numpy(zero_copy_only=False)
    sketch = Sketches(rows.column("sketch"))
    met, told = np.zeros(len(node), dtype=bool), np.zeros(len(node), dtype=bool)
    size, at = size.astype(np.int64), at.astype(np.int64)
    ends = np.append(_cell_starts(rows)[1:], len(node))
    here = np.arange(len(node))
    partners = ends[np.searchsorted(ends, here, "right")] - here - 1
    before = np.concatenate([[0], np.cumsum(partners)])
    first = 0
    while first < len(node):
        last = max(first + 1, int(np.searchsorted(before, before[first] + _PAIRS, "right")) - 1)
        x = np.repeat(here[first:last], partners[first:last])
        y = x + 1 + np.arange(len(x)) - (before[x] - before[first])
        small, large = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
        need = least_overlap(size[x], size[y], percent)
        able = (component[x] != component[y]) & (small * 100 >= large * percent) & ~(guest[x] & guest[y])
        able &= np.minimum(size[x] - at[x], size[y] - at[y]) >= need
        able &= (low[x] == high[x]) | (block[x] != block[y])
        x, y, need = x[able], y[able], need[able]
        differ = sketch.differ(x, y)
        near = size[x] + size[y] - differ >= 2 * need
        x, y, rank = x[near], y[near], differ[near]
        n = np.ones(len(x), dtype=np.int64)
        if turn is None:
            a, b = np.minimum(node[x], node[y]), np.maximum(node[x], node[y])
        else:
            met[x] = met[y] = told[x] = True
            if turn:
                rank = signed(mixed(node[y].view(np.uint64) + U64(turn)))
            order = np.lexsort((rank, x))
            start = np.flatnonzero(np.diff(x[order], prepend=-1))
            n = np.diff(np.append(start, len(order)))
            x, y, rank = x[order[start]], y[order[start]], rank[order[start]]
            a, b = node[y], node[x]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (a, b, shingle[x], n, rank)], names=_FOUND)
        first = last
    if turn is not None:
        rest = np.flatnonzero(met & ~told)
        none = np.zeros(len(rest), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (node[rest], node[rest], shingle[rest], none, none)], names=_FOUND)


_FOUND = ["a", "b", "place", "n", "rank"]


def _cell_starts(rows: pa.RecordBatch) -> np.ndarray:
    new = np.zeros(rows.num_rows, dtype=bool)
    new[:1] = True
    for name in ("shingle", "division", "low", "high"):
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _search(lists: DataFrame, texts: DataFrame, percent: int, turn: int | None = None) -> DataFrame:
    """All candidates (a, b) of different components that may link, each with one list (place) in which they meet.

    In a `turn` the members (b) of every cell that met a candidate, as `_searched` gives them.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None and held.num_rows:
                batch = pa.concat_batches([held, batch])
            # The last cell may go on in the next batch.
            whole = int(_cell_starts(batch)[-1]) if batch.num_rows else 0
            yield from _searched(batch.slice(0, whole), percent, turn)
            held = batch.slice(whole)
        if held is not None:
            yield from _searched(held, percent, turn)

    rows = _cells(lists, percent).join(texts.select("node", "sketch"), "node")
    cell = ["shingle", "division", "low", "high"]
    ordered = rows.repartition(*cell).sortWithinPartitions(*cell, "node")
    found = ordered.mapInArrow(search, "a long, b long, place long, n long, rank long")
    if turn is None:
        return found.groupBy("a", "b").agg(F.min("place").alias("place"))
    return found


def _picks(found: DataFrame) -> DataFrame:
    """Of what a turn found, one candidate (a, b, place) of each member (b) at most, with how many it has at least (n)."""
    best = found.where("n > 0").groupBy("b").agg(F.min(F.struct("rank", "a", "place")).alias("best"), F.max("n").alias("n"))
    return best.select("best.a", "b", "best.place", "n")


def _living(lists: DataFrame, found: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """The postings, stored, that met a candidate in a turn: the others never will, as components only grow.

    A bounded set of bits finds them without moving the postings; one too many stays and is harmless.
    """
    wanted = Bits(found.select(F.xxhash64("place", "b").alias("shingle")), found.count())
    last = len(lists.columns)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = wanted.may_hold(batch.column(last).to_numpy().view(np.uint64))
            yield batch.select(list(range(last))).filter(pa.array(kept))

    out = scratch.put(lists.withColumn("_key", F.xxhash64("shingle", "node")).mapInArrow(choose, lists.schema), label)
    wanted.release()
    return out


def _contract(lists: DataFrame, links: DataFrame | None, texts: DataFrame, n: int, percent: int, scratch: Scratch):
    """The lists that stay open and all links, after turns of search in which each member is compared with one candidate."""
    for turn in range(_TURNS):
        if lists.isEmpty():
            break
        found = scratch.put(_search(lists, texts, percent, turn), f"found-{turn}")
        lists = _living(lists, found, scratch, f"living-{turn}")
        picks = scratch.put(_picks(found), f"picks-{turn}")
        scratch.drop(f"found-{turn}")
        picked, candidates = picks.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if candidates <= _FEW * picked:
            break
        more = _compare(picks.drop("n"), texts, n, percent, scratch, f"pick-{turn}")
        links = more if links is None else links.unionByName(more)
        merged = components(links, scratch, f"picked-{turn}", most=4)
        lists = scratch.put(_open_lists(lists.drop("component"), merged), f"left-{turn}")
        if more.count() < _SHARE * picked:
            break
    return lists, links


def _hop(links: DataFrame) -> DataFrame:
    """(node, component) after the first turn: a node's head, or that head's own head."""
    heads = links.select(F.col("b").alias("node"), F.col("a").alias("head"))
    above = heads.select(F.col("node").alias("head"), F.col("head").alias("_above"))
    return heads.join(above, "head", "left").select("node", F.coalesce("_above", "head").alias("component"))


def _only(texts: DataFrame, wanted: Bits) -> DataFrame:
    """The texts of nodes that may be wanted; fewer texts then move to a join."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted.may_hold(batch.column(0).to_numpy().view(np.uint64))))

    return texts.mapInArrow(choose, texts.schema)


def _compare(pairs: DataFrame, texts: DataFrame, n: int, percent: int, scratch: Scratch, label: str) -> DataFrame:
    """Links (a, b), stored, among the candidate pairs (a, b, place).

    Pairs of one place meet in blocks of about `_BLOCK` pairs, where each text comes once,
    however many pairs it is in.
    """

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sets, asked = None, {}, {}

        def links() -> pa.RecordBatch:
            found = []
            for a, others in asked.items():
                own = [sets[b] for b in others]
                needs = least_overlap(len(sets[a]), np.array([len(x) for x in own]), percent)
                found += [(a, b) for b, overlap in zip(others, divide_skip(sets[a], own, needs)) if overlap]
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                names=["a", "b"],
            )

        for batch in batches:
            place, block, node, other = (batch.column(i).to_pylist() for i in range(4))
            runs = [(first, Sets(words, places, n)) for first, words, places in text_words(batch.column(4), most=_RUN_BYTES)]
            found = ((sets_of, i) for first, sets_of in runs for i in range(len(sets_of.sizes)))
            for row, (sets_of, i) in enumerate(found):
                if (place[row], block[row]) != here:
                    if asked:
                        yield links()
                    here, sets, asked = (place[row], block[row]), {}, {}
                if other[row] is None:
                    sets[node[row]] = sets_of.of(i).copy()
                else:
                    asked.setdefault(node[row], []).append(other[row])
        if asked:
            yield links()

    sizes = pairs.groupBy("place").agg(F.count("*").alias("_n"))
    placed = pairs.join(sizes, "place").select(
        "place", F.pmod(F.xxhash64("b"), F.ceil(F.col("_n") / _BLOCK)).cast("int").alias("block"), "a", "b"
    )
    placed = scratch.put(placed, f"{label}-pairs")
    node = F.explode(F.array("a", "b")).alias("node")
    needed = scratch.put(placed.select("place", "block", node).distinct(), f"{label}-nodes")
    wanted = Bits(needed.select(F.col("node").alias("shingle")), needed.count())
    held = _only(texts.select("node", "text"), wanted)
    whole = needed.hint("merge").join(held, "node").select("place", "block", "node", F.lit(None).cast("long").alias("other"), "text")
    only = placed.select("place", "block", F.col("a").alias("node"), F.col("b").alias("other"), F.lit(None).cast("string").alias("text"))
    rows = whole.unionByName(only).repartition("place", "block")
    # A block's texts come before its pairs.
    ordered = rows.sortWithinPartitions("place", "block", F.col("other").asc_nulls_first())
    found = scratch.put(ordered.mapInArrow(test, "a long, b long"), f"{label}-links")
    wanted.release()
    return found


def link_components(docs: DataFrame, *, n: int = 5, percent: int = 75, rounds: int = 2) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every document.

    Null and empty texts, and texts of white space, have no shingles and link with nothing: each
    is its own component. Fewer than `n` words are one shingle. Equal sets always link. Rows
    with equal ids count as one document whose links are joined. A null id is no smallest id:
    a component of null ids only has a null component_id. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = docs.select("doc_id", "text")
    sets = scratch.put(shingle_sets(docs, n), "sets")
    order = frequent_shingles(sets)
    for turn in ("seen", "shared"):
        counts = _prefix_counts(docs, order, n, percent).groupBy("shingle").agg(F.sum("n").alias("n"))
        shared = scratch.put(counts.where(F.col("n") > 1).select("shingle"), turn)
        if turn == "seen":
            order = Order(order.shingles, order.counts, Bits(shared, shared.count()))
    held = Bits(shared, shared.count())
    postings = _postings(docs, order, held, n, percent)
    # Different tasks may have posted copies of one set.
    lists = scratch.put_bucketed(postings.join(shared, "shingle").distinct(), "lists", "shingle")
    held.release()
    order.seen.release()

    nodes = sets.where(F.col("n_shingles") > 0).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    nodes = scratch.put(nodes, "nodes")
    wanted = nodes.join(lists.select(F.col("node").alias("digest")).distinct(), "digest", "left_semi")
    wanted = scratch.put(wanted.select(F.xxhash64("doc_id").alias("shingle")), "wanted")
    held = Bits(wanted, wanted.count())
    texts = scratch.put(_digested(docs, held, n), "texts")
    held.release()

    links, merged, own = None, None, lists.withColumn("component", F.col("node"))
    for turn in range(rounds):
        if turn:
            own = scratch.put(_open_lists(own.drop("component"), merged), f"open-{turn}")
            if own.isEmpty():
                break
        met = scratch.put(_head_pairs(own, turn, percent), f"met-{turn}")
        chosen = scratch.put(_one_each(met), f"pairs-{turn}")
        more = _compare(chosen, texts, n, percent, scratch, f"compare-{turn}")
        links = more if links is None else links.unionByName(more)
        # Nodes of one component that are not known to be may cost a comparison, never a link.
        merged = components(links, scratch, f"merged-{turn}", most=2) if turn else scratch.put(_hop(links), "merged-0")
        if not turn:
            own = _still_open(own, met, merged, scratch)
    if rounds:
        own = scratch.put(_open_lists(own.drop("component"), merged), "open")
    own, links = _contract(own, links, texts, n, percent, scratch)
    if links is None or not own.isEmpty():
        chosen = scratch.put(_search(own, texts, percent), "searched")
        more = _compare(chosen, texts, n, percent, scratch, "compare")
        links = more if links is None else links.unionByName(more)
    # A document with several rows joins the links of all its sets.
    again = sets.where(F.col("n_shingles") > 0).groupBy("doc_id").agg(
        F.min("digest").alias("a"), F.max("digest").alias("b")
    )
    several_sets = again.where("doc_id is not null and a <> b").select("doc_id", "a")
    joined = sets.where(F.col("n_shingles") > 0).join(several_sets, "doc_id").select("a", F.col("digest").alias("b"))
    merged = components(links.unionByName(joined), scratch, "merged")

    labels = nodes.join(merged.withColumnRenamed("node", "digest"), "digest", "left")
    labels = labels.withColumn("component", F.coalesce("component", "digest"))
    smallest = labels.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = scratch.put(labels.join(smallest, "component").select("digest", "component_id"), "labels")
    scratch.keep_only("sets", "labels")
    return (
        sets.join(labels, "digest", "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def _digested(docs: DataFrame, wanted: Bits, n: int) -> DataFrame:
    """(node, sketch, text) of the documents whose ids may be wanted."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(wanted.may_hold(batch.column(0).to_numpy().view(np.uint64))))
            for first, words, places in text_words(batch.column(1), most=_RUN_BYTES):
                sets = Sets(words, places, n)
                chosen = sets.distinct()
                own = batch.column(1).slice(first, len(sets.sizes)).take(pa.array(chosen))
                bits = pa.array([folded(x, n).tobytes() for x, n in zip(sketches(sets, chosen), sets.sizes[chosen].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(sets.digests[chosen])), bits, own], names=["node", "sketch", "text"]
                )

    return docs.select(F.xxhash64("doc_id").alias("key"), "text").mapInArrow(digest, "node long, sketch binary, text string")


def keep_one(docs: DataFrame, *, n: int = 5, percent: int = 75) -> DataFrame:
    """The documents without all but the first (by id) of each component, columns unchanged.

    Of rows with equal id in a component one is kept: null ids stay all, since nothing tells
    which of them is meant.
    """
    linked = link_components(docs, n=n, percent=percent)
    dropped = linked.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
