"""Documents as raw token ids in shards, each with a minimal perfect hash index.

File format, one binary value per shard, little-endian:
  header   8 uint32: magic, version, documents, buckets, seed, bytes per id, 0, 0
  keys     documents x int64: hashed keys in document order, for scans
  pilots   buckets x uint32: the minimal perfect hash
  prints   documents x uint32, starts documents x uint64, counts documents x uint32: by hash slot
  payload  ids
Looking up a key costs one pilot, one fingerprint and one slice, whatever the shard's size.
Shards are rows of a Parquet table, so that Spark's commit protocol makes rewriting after a
lost executor safe and any file system will do.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.llm.common import Scratch
from fieldlake.llm.words import U64, mixed, pieces, process_cache, word_hashes

MAGIC, VERSION = 0x464C5453, 1
SHARD_SCHEMA = "part int, seq int, n_docs int, n_ids long, doc_ids array<bigint>, shard binary"
_SPACE, _LINE = 0x20, 0x0A
_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_MARK = np.isin(np.arange(256), [ord(x) for x in ".,;:!?)"])


class Encoder:
    """Ids of texts by a byte-level BPE file, with the ids of recent words kept.

    The pre-tokenizer always starts a new token at a single space after another character, at
    a mark after an ASCII letter, and on both sides of a single line feed between letters or
    marks. A text may be cut there and equal parts encoded once; parts are known by a 64-bit
    hash. Missing parts are encoded together, and each part's ids are told apart by the bytes
    that ids stand for. Texts with a space at either end or next to another, or with a special
    token's string, are encoded whole. Beyond `limit` parts, those used once are forgotten.
    """

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        # A byte-level vocabulary writes one character for each byte.
        self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.bytes_of[number] = len(token)
        self.limit = limit
        self.known: dict[int, int] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.starts, self.counts, self.hits = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype=np.uint32)

    def _add(self, keys: list[int], ids: list[np.ndarray], counts: np.ndarray) -> None:
        """Keep the ids of parts; without keys they are kept for this run only."""
        first = len(self.counts)
        self.known.update(zip(keys, range(first, first + len(keys))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.hits = np.concatenate([self.hits, np.zeros(len(counts), dtype=np.int64)])
        self.ids = np.concatenate([self.ids, *ids])

    def _forget(self) -> None:
        """Keep the parts that were used again."""
        at = np.fromiter(self.known.values(), np.int64, len(self.known))
        stay = self.hits[at] > 1
        kept = at[stay]
        counts = self.counts[kept]
        ids = self._gather(kept)
        keys = [k for k, s in zip(self.known, stay.tolist()) if s]
        self.known, self.ids = {}, np.zeros(0, dtype=np.uint32)
        self.starts, self.counts, self.hits = (np.zeros(0, dtype=np.int64) for _ in range(3))
        if len(keys) < self.limit // 2:
            self._add(keys, [ids], counts)

    def _gather(self, at: np.ndarray) -> np.ndarray:
        counts = self.counts[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[at] - (ends - counts), counts) + np.arange(total)]

    def _learn(self, keys: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> None:
        codes = np.frombuffer(data, np.uint8)
        spaced = codes[starts] == _SPACE
        # Words without a space may stand in lines of their own.
        lined = _LETTER[codes[starts]] & (_LETTER[codes[ends - 1]] | _MARK[codes[ends - 1]])
        alone = np.flatnonzero(~spaced & ~lined)
        if len(alone):
            ids = [self._whole(data[a:b]) for a, b in zip(starts[alone].tolist(), ends[alone].tolist())]
            self._add(keys[alone].tolist(), ids, np.array([len(x) for x in ids]))
        for chosen, between in ((spaced, b""), (lined & ~spaced, b"\n")):
            rest = np.flatnonzero(chosen)
            for part in np.array_split(rest, max(1, len(rest) // 8192)):
                if not len(part):
                    continue
                ids = self._whole(between.join([data[a:b] for a, b in zip(starts[part].tolist(), ends[part].tolist())]))
                sizes = ends[part] - starts[part]
                places = np.cumsum(self.bytes_of[ids])
                stops = np.cumsum(sizes + len(between)) - len(between)
                last = np.searchsorted(places, stops) + 1
                first = np.searchsorted(places, stops - sizes, "right")
                counts = last - first
                kept = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
                self._add(keys[part].tolist(), [ids[kept]], counts)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a run in order, and the number of ids of each."""
        if len(self.known) > self.limit:
            self._forget()
        whole = data.tobytes()
        n = len(offsets) - 1
        space = data == _SPACE
        odd = np.zeros(n, dtype=bool)
        double = np.flatnonzero(space[1:] & space[:-1])
        odd[np.searchsorted(offsets, double, "right") - 1] = True
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        odd[full] |= space[offsets[full]] | space[offsets[full + 1] - 1]
        for mark in self.special:
            at = whole.find(mark)
            while at >= 0:
                odd[np.searchsorted(offsets, at, "right") - 1] = True
                at = whole.find(mark, at + 1)
        owner_odd = np.repeat(odd, np.diff(offsets))
        cut = space.copy()
        letter, mark, line = _LETTER[data], _MARK[data], data == _LINE
        plain = letter | mark
        cut[1:] |= letter[:-1] & mark[1:]
        single = np.flatnonzero(line[1:-1] & plain[:-2] & letter[2:]) + 1
        cut[single] = cut[single + 1] = True
        cut &= ~owner_odd
        cut[offsets[full]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        sizes = np.diff(np.searchsorted(starts, offsets))
        stays = ~owner_odd[starts]
        starts, ends = starts[stays], ends[stays]
        keys = word_hashes(data, starts, ends, None)
        found, at, which = np.unique(keys, return_index=True, return_inverse=True)
        number = np.fromiter(map(self.known.get, found.tolist(), repeat(-1)), np.int64, len(found))
        missing = number < 0
        if missing.any():
            at = at[missing]
            self._learn(found[missing], whole, starts[at], ends[at])
            number[missing] = np.fromiter(map(self.known.__getitem__, found[missing].tolist()), np.int64, len(at))
        self.hits[number] += np.bincount(which, minlength=len(found))
        parts = np.zeros(int(sizes.sum()), dtype=np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        is_odd = np.repeat(odd, sizes)
        parts[~is_odd] = number[which]
        if odd.any():
            own = [self._whole(whole[offsets[i] : offsets[i + 1]]) for i in np.flatnonzero(odd)]
            # These ids are no part of the table of words.
            parts[is_odd] = len(self.counts) + np.arange(len(own))
            self._add([], own, np.array([len(x) for x in own]))
        ends = np.concatenate([[0], np.cumsum(self.counts[parts])])
        return self._gather(parts), np.diff(ends[bounds])


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file: it outlives the task, whose own globals do not."""
    cache = process_cache()
    if path not in cache:
        cache[path] = Encoder(path)
    return cache[path]


def key_hashes(doc_ids: list[int | None]) -> np.ndarray:
    """64-bit keys: the id, a null mark, and how often the id stood before in the shard."""
    seen: dict[int | None, int] = {}
    rank = np.zeros(len(doc_ids), dtype=np.uint64)
    if len(set(doc_ids)) < len(doc_ids):
        for i, x in enumerate(doc_ids):
            rank[i] = seen[x] = seen.get(x, -1) + 1
    ids = np.array([0 if x is None else x for x in doc_ids], dtype=np.int64).view(np.uint64)
    null = np.array([x is None for x in doc_ids], dtype=np.uint64)
    return mixed(mixed(ids + U64(0x9E3779B97F4A7C15)) + rank * U64(2) + null)


def _slots(keys: np.ndarray, pilots: np.ndarray, n: int, seed: int) -> np.ndarray:
    own = mixed(keys ^ mixed(pilots.astype(np.uint64) + U64(seed + 1)))
    return (own % U64(n)).astype(np.int64)


def _buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys + U64(0x632BE59BD9B4E019)) % U64(buckets)).astype(np.int64)


def perfect_hash(keys: np.ndarray, per_bucket: float = 3.0) -> tuple[np.ndarray, int]:
    """Pilots and seed of a minimal perfect hash of distinct 64-bit keys (hash and displace).

    Buckets are placed largest first; each takes the first pilot that sends its keys to free
    slots.
    """
    n = len(keys)
    count = max(1, int(np.ceil(n / per_bucket)))
    bucket = _buckets(keys, count)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=count)
    starts = np.cumsum(sizes) - sizes
    for seed in range(1 << 16):
        pilots = np.zeros(count, dtype=np.uint32)
        taken = np.zeros(n, dtype=bool)
        for b in np.argsort(-sizes, kind="stable"):
            if not sizes[b]:
                break
            own = keys[order[starts[b] : starts[b] + sizes[b]]]
            placed = False
            for base in range(0, 1 << 20, 64):
                tried = np.arange(base, base + 64, dtype=np.uint32)
                slots = _slots(own[None, :], tried[:, None], n, seed)
                free = ~taken[slots].any(axis=1)
                if len(own) > 1:
                    ranked = np.sort(slots, axis=1)
                    free &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                if free.any():
                    hit = int(np.argmax(free))
                    pilots[b] = tried[hit]
                    taken[slots[hit]] = True
                    placed = True
                    break
            if not placed:
                break
        else:
            return pilots, seed
        if taken.all():
            return pilots, seed
    raise ValueError("keys are not distinct")


def write_shard(doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    n = len(doc_ids)
    keys = key_hashes(doc_ids)
    pilots, seed = perfect_hash(keys)
    slots = _slots(keys, pilots[_buckets(keys, len(pilots))], n, seed)
    prints, starts, sizes = np.zeros(n, "<u4"), np.zeros(n, "<u8"), np.zeros(n, "<u4")
    prints[slots] = (keys >> U64(32)).astype(np.uint32)
    starts[slots] = np.cumsum(counts) - counts
    sizes[slots] = counts
    head = np.array([MAGIC, VERSION, n, len(pilots), seed, width, 0, 0], "<u4")
    parts = [head, keys.astype("<u8"), pilots.astype("<u4"), prints, starts, sizes, ids.astype(f"<u{width}")]
    return b"".join(x.tobytes() for x in parts)


class Shard:
    """Keyed access to a shard's bytes."""

    def __init__(self, data: bytes):
        head = np.frombuffer(data, "<u4", 8)
        if head[0] != MAGIC or head[1] != VERSION:
            raise ValueError("not a token shard")
        self.n, buckets, self.seed, width = (int(x) for x in head[2:6])
        at = 32
        for name, kind, size in (
            ("keys", "<u8", self.n), ("pilots", "<u4", buckets), ("prints", "<u4", self.n),
            ("starts", "<u8", self.n), ("counts", "<u4", self.n),
        ):
            setattr(self, name, np.frombuffer(data, kind, size, at))
            at += size * int(kind[2])
        self.payload = np.frombuffer(data, f"<u{width}", offset=at)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where the stored fingerprint differs."""
        if not self.n:
            return np.full(len(keys), -1, dtype=np.int64)
        slots = _slots(keys, self.pilots[_buckets(keys, len(self.pilots))], self.n, self.seed)
        same = self.prints[slots] == (keys >> U64(32)).astype(np.uint32)
        return np.where(same, slots, -1)

    def ids(self, slot: int) -> np.ndarray:
        start = int(self.starts[slot])
        return self.payload[start : start + int(self.counts[slot])]


def write(
    docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 0, shard_bytes: int = 2 << 20, shard_docs: int = 4096
) -> None:
    """Encode every document and write shards in ascending doc_id order to a table at `path`.

    Order: null ids first, equal ids by a hash of the text. `end_id` ends each document. A
    shard holds documents of about `shard_bytes` of text, at most `shard_docs`; a longer document
    is a shard of its own. Null and empty texts give the end id alone. Other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, data, offsets in pieces(batch.column(1), shard_bytes):
                for at in range(0, len(offsets) - 1, shard_docs):
                    own = offsets[at : at + shard_docs + 1]
                    ids, counts = coder.encode(data[own[0] : own[-1]], own - own[0])
                    ids = np.insert(ids, np.cumsum(counts), end_id)
                    keys = doc_ids[first + at : first + at + len(counts)]
                    row = {
                        "part": [part], "seq": [seq], "n_docs": [len(keys)], "n_ids": [len(ids)],
                        "doc_ids": [keys], "shard": [write_shard(keys, ids, counts + 1, coder.width)],
                    }
                    seq += 1
                    yield pa.RecordBatch.from_pydict(row, schema=_SHARD_ARROW)

    tie = F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id", tie)
    shards = ordered.sortWithinPartitions("doc_id", tie).mapInArrow(encode, SHARD_SCHEMA)
    shards.write.option("compression", "zstd").parquet(path)


_SHARD_ARROW = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int32()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("shard", pa.binary()),
])


def shard_starts(shards: DataFrame) -> DataFrame:
    """Ids before each shard: sums of whole parts first, then of the shards in a part."""
    sizes = shards.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_part_start"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    return sizes.withColumn("_inside", inside).join(parts, "part").select(
        "part", "seq", (F.col("_part_start") + F.col("_inside")).alias("_shard_start")
    )


def read_index(shards: DataFrame) -> DataFrame:
    """Every document, found by key through its shard's hash: doc_id, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before it; the checksum is of the ids as
    little-endian unsigned 32-bit integers.
    """

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, keys, data in zip(*(batch.column(i) for i in range(4))):
                shard, doc_ids = Shard(data.as_py()), keys.as_py()
                slots = shard.find(key_hashes(doc_ids))
                if (slots < 0).any():
                    raise ValueError("a document is missing from its shard")
                n = len(doc_ids)
                sums = [zlib.crc32(shard.ids(s).astype("<u4").tobytes()) for s in slots]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part.as_py()] * n, pa.int32()), "seq": pa.array([seq.as_py()] * n, pa.int32()),
                    "doc_id": pa.array(doc_ids, pa.int64()), "_start": pa.array(shard.starts[slots].astype(np.int64)),
                    "n_tokens": pa.array(shard.counts[slots].astype(np.int64)), "ids_crc32": pa.array(sums, pa.int64()),
                })

    rows = shards.select("part", "seq", "doc_ids", "shard").mapInArrow(
        look_up, "part int, seq int, doc_id long, _start long, n_tokens long, ids_crc32 long"
    )
    starts = Scratch(shards.sparkSession, "starts").put(shard_starts(shards), "shards")
    return rows.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("_shard_start") + F.col("_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_and_read(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write `docs` to a token table in the shared folder and read its index back."""
    spark = docs.sparkSession
    path = f"{Scratch(spark, 'tokens').path}/shards"
    write(docs, path, tokenizer, **options)
    return read_index(spark.read.parquet(path))
