"""Two tokenizers' tokens of the same texts, linked by bytes, and how often ids are linked in the corpus.

Side A is a byte-level BPE file, side B a sentence-piece BPE model. Both see a space and the
text. Where tokens of both end, a group ends; tokens whose bytes overlap are linked. Between two
neighbouring ends of either side lies exactly one link, so there are as many links as distinct ends.

External counting, by side B's ids:

1. Tasks align texts and gather records (pair of ids, document, links). A full buffer is sorted
   side-major (B's id before A's), cut by a radix of B's id, and spilled as zstd runs, one row of
   a stored table for each bucket: a head (pairs and their links) and a body (documents and links
   of each pair).
2. Heads of a bucket are merged k ways with a heap, in rounds of at most about `fan_in` runs, into
   the corpus count of each pair. Only heads travel, so a pair that is in every document costs one entry a run.
3. In side-major order a B id's pairs stand together, so one pass gives its highest count.
   Counts and marks of the highest stream back to the runs, in the order of each head.
4. A run's bodies turn them into sums for its documents. Texts are read once, documents never shuffled by pair.

No step holds more than one run, `fan_in` heads of a bucket or one bucket's distinct pairs; a
bucket has one in 2**`radix` of B's ids. A frequent pair or id makes no step larger.

Texts are cut before a space that follows something else than white space: there both
tokenizers start a token whatever stands around (checked for B's pieces when the model is read), so a part is
encoded and aligned once a process and remembered. A text is held whole; a long one's records are counted by
distinct part.

Defined results for odd input: null and empty texts, and texts whose tokens do not spell the
space and the text byte for byte (U+2581 in a text, for instance), have zeros and an empty digest
and link nothing. Equal rows and null keys are documents of their own. Other columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import Scratch
from fieldlake.llm.words import process_cache

_CUT = re.compile(r"(?<=\S) ")
_ODD = re.compile(r"  |[^\S ] ")
_LONG = 100_000
_CHUNK = 8192


def byte_characters() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: its own if it shows, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as one zstd block: their lengths, then their values in the fewest bytes."""
    import zstandard

    parts = [np.array([len(arrays)], "<u1").tobytes()]
    for values in arrays:
        kind = np.min_scalar_type(int(values.max())) if len(values) else np.dtype(np.uint8)
        kind = kind if kind.itemsize > 1 else np.dtype(np.uint8)
        parts += [np.array([len(values), kind.itemsize], "<u8").tobytes(), values.astype(f"<u{kind.itemsize}").tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(block: bytes) -> list[np.ndarray]:
    import zstandard

    data, at, out = zstandard.ZstdDecompressor().decompress(block), 1, []
    for _ in range(data[0]):
        n, width = (int(x) for x in np.frombuffer(data, "<u8", 2, at))
        out.append(np.frombuffer(data, f"<u{width}", n, at + 16).astype(np.int64))
        at += 16 + n * width
    return out


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=0)


class Layout:
    """Pairs as integers: B's id with its radix bits first, then A's id. Ordered by bucket, B's id, A's id."""

    def __init__(self, a_size: int, b_size: int, radix: int):
        self.a_bits = max(1, (a_size - 1).bit_length())
        self.b_bits = max(radix, (b_size - 1).bit_length())
        self.radix = radix
        self.doc_bits = 63 - self.a_bits - self.b_bits

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        turned = (b & ((1 << self.radix) - 1)) << (self.b_bits - self.radix) | b >> self.radix
        return turned << self.a_bits | a

    def bucket(self, pairs: np.ndarray) -> np.ndarray:
        return pairs >> (self.a_bits + self.b_bits - self.radix)

    def side(self, pairs: np.ndarray) -> np.ndarray:
        return pairs >> self.a_bits


class Aligner:
    """Links and groups of texts; remembers parts of texts, at most about `limit` of them between runs."""

    def __init__(self, a_path: str, b_path: str, radix: int, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        characters = byte_characters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, number in self.a.get_vocab().items():
            self.a_bytes[number] = bytes(characters[c] for c in token) if all(c in characters for c in token) else b"\0"
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.split = not any("▁" in p.lstrip("▁") for p in pieces)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.layout = Layout(len(self.a_bytes), len(self.b_bytes), radix)
        self.a_length, self.b_length = (np.array([len(x) for x in own], dtype=np.int64) for own in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = ([b"%d" % i for i in range(len(own))] for own in (self.a_bytes, self.b_bytes))
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        #: Number of each part; -1 where tokens do not spell the part.
        self.known: dict[str, int] = {}
        self.groups: list[bytes] = []
        #: Of each part: tokens of A and of B, groups, links.
        self.counts = np.zeros((0, 4), dtype=np.int64)
        self.starts, self.pairs = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def parts(self, text: str) -> list[str]:
        """Parts of a space and the text, each without its first space."""
        if not self.split:
            return [text]
        if text[:1] != " " and not _ODD.search(text):
            return text.split(" ")
        first, *rest = _CUT.split(" " + text)
        return [first[1:], *rest]

    def _a_ids(self, parts: list[str]) -> list[list[int] | np.ndarray]:
        """Ids of each part; parts that end without white space are encoded in one string."""
        out: list = [None] * len(parts)
        joined = [k for k, p in enumerate(parts) if p and not p[-1].isspace()]
        for k in set(range(len(parts))) - set(joined):
            out[k] = self.a.encode(" " + parts[k], add_special_tokens=False).ids
        if joined:
            ids = np.array(self.a.encode("".join([" " + parts[k] for k in joined]), add_special_tokens=False).ids)
            ends = np.cumsum([len(parts[k].encode()) + 1 for k in joined])
            cuts = np.searchsorted(np.cumsum(self.a_length[ids]), ends) + 1
            for k, own in zip(joined, np.split(ids, cuts[:-1])):
                out[k] = own
        return out

    def learn(self, parts: list[str], names: list | None = None) -> None:
        """Align new parts and remember them under their text, or under `names`."""
        names = parts if names is None else names
        for at in range(0, len(parts), _CHUNK):
            self._learn(parts[at : at + _CHUNK], names[at : at + _CHUNK])

    def _learn(self, parts: list[str], names: list) -> None:
        a_ids, b_ids = self._a_ids(parts), self.b.encode(parts)
        sound = []
        for k, (part, a, b) in enumerate(zip(parts, a_ids, b_ids)):
            data = b" " + part.encode()
            spelled = b"".join([self.b_bytes[i] for i in b]) == data and b"".join([self.a_bytes[i] for i in a]) == data
            if spelled:
                sound.append(k)
            else:
                self.known[names[k]] = -1
        if not sound:
            return
        a, b = (np.concatenate([np.asarray(own[k], dtype=np.int64) for k in sound]) for own in (a_ids, b_ids))
        a_sizes, b_sizes = (np.array([len(own[k]) for k in sound]) for own in (a_ids, b_ids))
        a_ends, b_ends = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        part_ends = a_ends[np.cumsum(a_sizes) - 1]
        links, common = np.union1d(a_ends, b_ends), np.intersect1d(a_ends, b_ends, assume_unique=True)
        pairs = self.layout.pair(a[np.searchsorted(a_ends, links)], b[np.searchsorted(b_ends, links)])
        per_part = [np.bincount(np.searchsorted(part_ends, ends), minlength=len(sound)) for ends in (common, links)]
        # Names in the order group, side, place; each with the mark that follows it.
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable").tolist()
        a_last, b_last = np.diff(a_group, append=-1) != 0, np.diff(b_group, append=-1) != 0
        words = [self.a_names[i] + (b"|" if last else b",") for i, last in zip(a.tolist(), a_last.tolist())]
        words += [self.b_names[i] + (b";" if last else b",") for i, last in zip(b.tolist(), b_last.tolist())]
        words = [words[i] for i in order]
        at, first = 0, len(self.groups)
        for k, size in zip(sound, (a_sizes + b_sizes).tolist()):
            self.known[names[k]] = len(self.groups)
            self.groups.append(b"".join(words[at : at + size])[:-1])
            at += size
        self.counts = np.concatenate([self.counts, np.stack([a_sizes, b_sizes, *per_part], axis=1)])
        before = np.cumsum(per_part[1]) - per_part[1]
        self.starts = np.concatenate([self.starts, len(self.pairs) + before])
        self.pairs = np.concatenate([self.pairs, pairs])
        assert len(self.groups) == len(self.counts) == first + len(sound)

    def align(self, texts: list[str]) -> list[np.ndarray | None]:
        """Part numbers of each text; None if its tokens do not spell it, or it is empty."""
        cut = [self.parts(t) if t else [] for t in texts]
        missing = {p for own in cut for p in own}.difference(self.known)
        if missing:
            self.learn(sorted(missing))
        out: list[np.ndarray | None] = []
        for text, own in zip(texts, cut):
            numbers = np.fromiter(map(self.known.__getitem__, own), np.int64, len(own))
            if len(own) > 1 and (numbers < 0).any():
                # Parts that are not spelled alone: the whole text decides.
                self.learn([text], [("whole", text)])
                numbers = np.array([self.known.pop(("whole", text))])
            out.append(numbers if len(own) and (numbers >= 0).all() else None)
        return out


def aligner(a_path: str, b_path: str, radix: int) -> Aligner:
    """The worker's aligner: it outlives the task."""
    cache, key = process_cache(), ("aligner", a_path, b_path, radix)
    if key not in cache:
        cache[key] = Aligner(a_path, b_path, radix)
    return cache[key]


class Run:
    """Records of some documents before they are spilled."""

    def __init__(self, own: Aligner):
        self.aligner, self.keys, self.rows = own, [], []
        self.numbers: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.docs: list[int] = []
        self.size = 0

    def add(self, key, numbers: np.ndarray | None) -> None:
        own = self.aligner
        if numbers is None:
            self.rows.append((0, 0, 0, 0, ""))
        else:
            text = b";".join([own.groups[i] for i in numbers.tolist()])
            self.rows.append((*own.counts[numbers].sum(axis=0).tolist(), hashlib.sha256(text).hexdigest()))
            weights = np.ones(len(numbers), dtype=np.int64)
            if len(numbers) > _LONG:
                numbers, weights = np.unique(numbers, return_counts=True)
            self.numbers.append(numbers)
            self.weights.append(weights)
            self.docs.append(len(self.keys))
            self.size += int(own.counts[numbers, 3].sum())
        self.keys.append(key)

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted by pair, then document: pairs, documents, links."""
        own = self.aligner
        if not self.numbers:
            return (np.zeros(0, dtype=np.int64),) * 3
        numbers, weights = np.concatenate(self.numbers), np.concatenate(self.weights)
        docs = np.repeat(self.docs, [len(x) for x in self.numbers])
        sizes = own.counts[numbers, 3]
        ends = np.cumsum(sizes)
        pairs = own.pairs[np.repeat(own.starts[numbers] - (ends - sizes), sizes) + np.arange(ends[-1])]
        code = pairs << own.layout.doc_bits | np.repeat(docs, sizes)
        order = np.argsort(code)
        code, weights = code[order], np.repeat(weights, sizes)[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        code = code[first]
        return code >> own.layout.doc_bits, code & ((1 << own.layout.doc_bits) - 1), np.add.reduceat(weights, first)

    def spill(self) -> Iterator[tuple[int, bytes, bytes]]:
        """Bucket, head and body of each bucket with records."""
        pairs, docs, links = self.records()
        if not len(pairs):
            return
        layout = self.aligner.layout
        cuts = np.flatnonzero(np.diff(layout.bucket(pairs))) + 1
        for p, d, n in zip(np.split(pairs, cuts), np.split(docs, cuts), np.split(links, cuts)):
            first = np.flatnonzero(np.diff(p, prepend=-1))
            sizes = np.diff(np.append(first, len(p)))
            steps = _steps(d)
            steps[first] = d[first]
            yield int(layout.bucket(p[:1])[0]), pack(_steps(p[first]), np.add.reduceat(n, first)), pack(sizes, steps, n)


def _spilled(docs: DataFrame, a_path: str, b_path: str, radix: int, spill_links: int) -> DataFrame:
    """Rows of documents, and rows of buckets with a head and a body."""
    key_type = docs.schema["key"].dataType
    names = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seq = aligner(a_path, b_path, radix), TaskContext.get().partitionId(), 0

        def emptied(full: Run, number: int) -> Iterator[pa.RecordBatch]:
            n = len(full.keys)
            columns = list(zip(*full.rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(full.keys, kind)]
                + [pa.array(c, pa.int64()) for c in columns[:4]]
                + [pa.array(columns[4], pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
                [*("run", "at", "key"), *names, "groups_sha256", "bucket", "head", "body"],
            )
            for bucket, head, body in full.spill():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, kind)]
                    + [pa.nulls(1, pa.int64())] * 4
                    + [pa.nulls(1, pa.string()), pa.array([bucket], pa.int32()), pa.array([head], pa.binary()), pa.array([body], pa.binary())],
                    [*("run", "at", "key"), *names, "groups_sha256", "bucket", "head", "body"],
                )

        now = Run(own)
        for batch in batches:
            kind = batch.schema.field(0).type
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for at, some in _blocks(texts):
                for key, numbers in zip(keys[at:], own.align(some)):
                    now.add(key, numbers)
                # A run ends between blocks, where nothing refers to the remembered parts.
                if now.size >= spill_links or len(own.known) > own.limit:
                    yield from emptied(now, part << 32 | seq)
                    now, seq = Run(own), seq + 1
                    if len(own.known) > own.limit:
                        own.forget()
        if now.keys:
            yield from emptied(now, part << 32 | seq)

    schema = f"run long, at int, key {key_type.simpleString()}, {', '.join(f'{n} long' for n in names)}, "
    return docs.mapInArrow(run, schema + "groups_sha256 string, bucket int, head binary, body binary")


def _blocks(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about `most` characters, nulls as empty: (first index, texts)."""
    first, some, size = 0, [], 0
    for k in range(len(texts)):
        some.append(texts[k].as_py() or "")
        size += len(some[-1])
        if size >= most or k + 1 == len(texts):
            yield first, some
            first, some, size = k + 1, [], 0


def merge_heads(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order and their sums over all heads: a k-way merge with a heap."""

    def stream(block: bytes) -> Iterator[tuple[int, int]]:
        steps, links = unpack(block)
        return zip(np.cumsum(steps).tolist(), links.tolist())

    pairs: list[int] = []
    sums: list[int] = []
    last = -1
    for pair, links in heapq.merge(*map(stream, blocks)):
        if pair == last:
            sums[-1] += links
        else:
            pairs.append(pair)
            sums.append(links)
            last = pair
    return np.array(pairs, dtype=np.int64), np.array(sums, dtype=np.int64)


def _merged(heads: DataFrame) -> DataFrame:
    """One head for each bucket and group of runs."""

    def merge(rows: pa.Table) -> pa.Table:
        pairs, sums = merge_heads(rows["head"].to_pylist())
        return pa.table({
            "bucket": rows["bucket"][:1], "part": rows["part"][:1], "head": pa.array([pack(_steps(pairs), sums)], pa.binary()),
        })

    return heads.select("bucket", "part", "head").groupBy("bucket", "part").applyInArrow(merge, "bucket int, part int, head binary")


def count_pairs(heads: DataFrame, scratch: Scratch, runs: int, fan_in: int) -> DataFrame:
    """One head for each bucket with the counts of the whole corpus."""
    level, parts = 0, -(-runs // fan_in)
    heads = heads.select("bucket", F.pmod(F.xxhash64("run"), F.lit(max(parts, 1))).cast("int").alias("part"), "head")
    while True:
        heads = scratch.put(_merged(heads), f"counts{level}")
        if parts <= 1:
            return heads
        parts, level = -(-parts // fan_in), level + 1
        heads = heads.select("bucket", F.pmod(F.col("part"), F.lit(parts)).cast("int").alias("part"), "head")


def _returned(heads: DataFrame, counts: DataFrame, layout: Layout, parts: int) -> DataFrame:
    """For each head of a run the corpus counts of its pairs and whether they are their B id's highest."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = sums = best = None
        for batch in batches:
            for run, bucket, head in zip(*(batch.column(k) for k in (1, 2, 3))):
                steps, links = unpack(head.as_py())
                own = np.cumsum(steps)
                if run.as_py() is None:
                    # The bucket's counts come before its heads. Side-major: a B id's pairs stand together.
                    pairs, sums = own, links
                    first = np.flatnonzero(np.diff(layout.side(pairs), prepend=-1))
                    highest = np.maximum.reduceat(sums, first)
                    best = sums == np.repeat(highest, np.diff(np.append(first, len(pairs))))
                    continue
                at = np.searchsorted(pairs, own)
                yield pa.RecordBatch.from_pydict({
                    "run": pa.array([run.as_py()], pa.int64()), "bucket": pa.array([bucket.as_py()], pa.int32()),
                    "back": pa.array([pack(sums[at], best[at].astype(np.int64))], pa.binary()),
                })

    salted = heads.select(F.pmod(F.xxhash64("run"), F.lit(parts)).cast("int").alias("part"), "run", "bucket", "head")
    copies = counts.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(None).cast("long").alias("run"), "bucket", "head"
    )
    rows = salted.unionByName(copies).repartition("bucket", "part")
    rows = rows.sortWithinPartitions("bucket", "part", F.col("run").asc_nulls_first())
    return rows.mapInArrow(stream, "run long, bucket int, back binary")


def _summed(spilled: DataFrame, returned: DataFrame) -> DataFrame:
    """Documents with the sums of what came back to their run."""

    def finish(rows: pa.Table) -> pa.Table:
        docs = rows.filter(rows["at"].is_valid()).sort_by("at")
        best, total = np.zeros(len(docs), dtype=np.int64), np.zeros(len(docs), dtype=np.int64)
        filled = rows.filter(rows["bucket"].is_valid())
        bodies: dict[int, list] = {}
        for bucket, body, back in zip(*(filled[c].to_pylist() for c in ("bucket", "body", "back"))):
            bodies.setdefault(bucket, []).append((body, back))
        for own in bodies.values():
            (body,), (back,) = [x for x, _ in own if x is not None], [x for _, x in own if x is not None]
            (sizes, steps, links), (sums, highest) = unpack(body), unpack(back)
            pair = np.repeat(np.arange(len(sizes)), sizes)
            # Steps restart with each pair.
            places = np.cumsum(steps)
            first = np.cumsum(sizes) - sizes
            at = places - (places[first] - steps[first])[pair]
            np.add.at(total, at, links * sums[pair])
            np.add.at(best, at, links * highest[pair])
        kept = docs.select(["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
        return kept.append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(total))

    none = F.lit(None)
    rows = spilled.drop("head").withColumn("back", none.cast("binary"))
    rows = rows.unionByName(returned, allowMissingColumns=True)
    key = spilled.schema["key"].dataType.simpleString()
    schema = f"key {key}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return rows.groupBy("run").applyInArrow(finish, schema)


def align(
    docs: DataFrame, a_path: str, b_path: str, *, key: str = "doc_id", text: str = "text",
    radix: int = 8, spill_links: int = 3_000_000, fan_in: int = 64,
) -> DataFrame:
    """Every document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    spilled = scratch.put(_spilled(source, a_path, b_path, radix, spill_links), "runs", compression="uncompressed")
    heads = spilled.where("bucket IS NOT NULL").select("run", "bucket", "head")
    runs = spilled.where("at = 0").count()
    counts = count_pairs(heads, scratch, runs, fan_in)
    layout = aligner(a_path, b_path, radix).layout
    returned = _returned(heads, counts, layout, max(1, -(-runs // fan_in)))
    found = _summed(spilled, returned)
    return found.select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def pair_counts(docs: DataFrame, a_path: str, b_path: str, *, key: str = "doc_id", text: str = "text", radix: int = 8) -> DataFrame:
    """The corpus's linked pairs of ids: a, b, links, highest (of its b)."""
    scratch = Scratch(docs.sparkSession, "pairs")
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    spilled = scratch.put(_spilled(source, a_path, b_path, radix, 3_000_000).where("at = 0 OR head IS NOT NULL"), "runs", "uncompressed")
    heads = spilled.where("bucket IS NOT NULL").select("run", "bucket", "head")
    counts = count_pairs(heads, scratch, spilled.where("at = 0").count(), 64)
    layout = aligner(a_path, b_path, radix).layout

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for head in batch.column(0):
                steps, links = unpack(head.as_py())
                pairs = np.cumsum(steps)
                side = layout.side(pairs)
                low = layout.b_bits - layout.radix
                b = (side & ((1 << low) - 1)) << layout.radix | side >> low
                first = np.flatnonzero(np.diff(side, prepend=-1))
                highest = np.repeat(np.maximum.reduceat(links, first), np.diff(np.append(first, len(pairs))))
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array((pairs & ((1 << layout.a_bits) - 1)).astype(np.int32)), "b": pa.array(b.astype(np.int32)),
                    "links": pa.array(links), "highest": pa.array(links == highest),
                })

    return counts.select("head").mapInArrow(rows, "a int, b int, links long, highest boolean")
