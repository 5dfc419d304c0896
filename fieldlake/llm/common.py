"""What several operators share: tables, stored intermediate results, fixed document shape."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.words import _PIECE_BYTES, pieces
from fieldlake.sinks.files import remove
from fieldlake.sinks.settle import shared_dir

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


class Scratch:
    """Tables of one operator call in the folder that `spark.checkpoint.dir` names.

    `put` computes a frame once and reads it back, which cuts its lineage: tables survive
    lost executors. `keep_only` deletes those that no later frame reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self.names: list[str] = []
        self.tables: list[str] = []

    def put(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        path = f"{self.path}/{name}"
        self.names.append(name)
        df.write.option("compression", compression).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def put_bucketed(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """Like `put`, in as many buckets as a shuffle has partitions: joins and groups on the key stay in place."""
        table = f"scratch_{name}_{uuid.uuid4().hex[:12]}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.names.append(name)
        self.tables.append(table)
        writer = df.repartition(buckets, key).write.format("parquet").option("path", f"{self.path}/{name}")
        writer.option("compression", "zstd").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
        return self.spark.table(table)

    def drop(self, name: str) -> None:
        """Delete a stored table that nothing reads any more."""
        remove(self.spark, f"{self.path}/{name}")
        self.names.remove(name)

    def keep_only(self, *names: str) -> None:
        """Delete all tables but those that frames still to be computed read."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for name in set(self.names) - set(names):
            remove(self.spark, f"{self.path}/{name}")
        self.names, self.tables = list(names), []


def fold_of(key: str, folds: int) -> F.Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the text "null"."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("null"))), F.lit(folds))


_BLOCKS = 16


def gather_tables(docs: DataFrame, sizes: list[int], fill, most: int = _PIECE_BYTES) -> list[np.ndarray]:
    """Counts in tables of fixed sizes, over the texts of all of `docs`.

    `fill(tables, data, offsets)` adds a run of texts, of about `most` bytes, to a task's tables. Few tasks, two for
    each core, fill one set of tables each; groups of tables are added up level by level, so
    no task or driver sees more than a few at a time.
    """
    docs = docs.select("text").coalesce(2 * docs.sparkSession.sparkContext.defaultParallelism)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(size, dtype=np.uint64) for size in sizes]
        for batch in batches:
            for _, data, offsets in pieces(batch.column(0), most):
                fill(tables, data, offsets)
        part = TaskContext.get().partitionId()
        for number, table in enumerate(tables):
            for block, own in enumerate(np.array_split(table, _BLOCKS)):
                yield _packed(number, block, part, own)

    def add(key: tuple, group: pa.Table) -> pa.Table:
        total = np.uint64(0)
        for data in group.column("data"):
            total = total + _unpacked(data.as_py())
        return pa.Table.from_batches([_packed(key[0].as_py(), key[1].as_py(), key[2].as_py(), total)])

    schema = "number int, block int, part int, data binary"
    left = docs.rdd.getNumPartitions()
    parts = docs.mapInArrow(count, schema)
    while True:
        parts = parts.withColumn("part", F.floor(F.col("part") / 32).cast("int"))
        parts = parts.groupBy("number", "block", "part").applyInArrow(add, schema)
        left = -(-left // 32)
        if left <= 1:
            break
    found = {(r.number, r.block): _unpacked(r.data) for r in parts.toLocalIterator()}
    return [
        np.concatenate([found[number, block] for block in range(_BLOCKS)]) if found else np.zeros(size, np.uint64)
        for number, size in enumerate(sizes)
    ]


def _packed(number: int, block: int, part: int, table: np.ndarray) -> pa.RecordBatch:
    """Counts as compressed bytes, four each where all fit, else eight."""
    wide = int(table.max(initial=0)) >> 32 > 0
    raw = np.asarray(table, np.uint64 if wide else np.uint32)
    head = bytes([8 if wide else 4]) + len(raw).to_bytes(8, "little")
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.array([block], pa.int32()), pa.array([part], pa.int32()),
         pa.array([head + pa.compress(raw.tobytes(), "zstd", asbytes=True)], pa.binary())],
        names=["number", "block", "part", "data"],
    )


def _unpacked(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    raw = pa.decompress(data[9:], width * n, "zstd", asbytes=True)
    return np.frombuffer(raw, np.uint64 if width == 8 else np.uint32).astype(np.uint64)
