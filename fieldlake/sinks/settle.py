"""Write an intermediate result once to shared storage and read it back.

Three things need this: results that several queries use, small lookups whose
real size should decide between a broadcast and a shuffled join (the planner
sees the file size), and row-to-partition assignments that must not change
between two passes. The files live under `spark.checkpoint.dir`, so the loss of
an executor costs nothing.

Settling runs a job at once, also while a query is only being built. What is
settled belongs to the innermost open `Owner`, which deletes it when released;
without one it belongs to the application's own, released by `release_all`.
"""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from fieldlake.sinks.files import file_state, remove

_CONF = "spark.checkpoint.dir"
_LOCAL_BASES: dict[str, str] = {}
_OPEN: ContextVar[tuple["Owner", ...]] = ContextVar("open_owners", default=())
_UNOWNED: dict[str, "Owner"] = {}


class Owner:
    """Folders and catalog tables that were settled while it was open.

    Frames read from them must not be used after `release`. As a context manager
    it is open for the block and released at its end; `open` only opens it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.tables: list[str] = []
        self._tokens: list = []

    def open(self) -> "_Opened":
        return _Opened(self)

    def __enter__(self) -> "Owner":
        self._tokens.append(_OPEN.set((*_OPEN.get(), self)))
        return self

    def __exit__(self, *error) -> None:
        _OPEN.reset(self._tokens.pop())
        self.release()

    def release(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self.paths:
            remove(self.spark, path)
        self.tables, self.paths = [], []


class _Opened:
    def __init__(self, owner: Owner):
        self.owner = owner

    def __enter__(self) -> Owner:
        self.token = _OPEN.set((*_OPEN.get(), self.owner))
        return self.owner

    def __exit__(self, *error) -> None:
        _OPEN.reset(self.token)


def _owner(spark: SparkSession) -> Owner:
    opened = _OPEN.get()
    return opened[-1] if opened else _UNOWNED.setdefault(spark.sparkContext.applicationId, Owner(spark))


def release_all(spark: SparkSession) -> None:
    """Delete what was settled in this application outside any owner."""
    owner = _UNOWNED.pop(spark.sparkContext.applicationId, None)
    if owner:
        owner.release()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables of this application.

    The cluster names it in `spark.checkpoint.dir`. Only a local master without
    that setting gets a temporary folder, one for the application; the session's
    settings stay as they are.
    """
    context = spark.sparkContext
    base = spark.conf.get(_CONF, None) or context.getConf().get(_CONF) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_CONF} to a folder that all executors can reach")
        base = _LOCAL_BASES.get(context.applicationId) or tempfile.mkdtemp(prefix="fieldlake-")
        _LOCAL_BASES[context.applicationId] = base
    return f"{base.rstrip('/')}/fieldlake/{context.applicationId}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """`df`, computed once and stored as Parquet."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _owner(spark).paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_table(
    df: DataFrame,
    name: str,
    partition_by: str | None = None,
    bucket_by: str | None = None,
    buckets: int = 1,
) -> str:
    """Store `df` as a catalog table with a layout and return the table's name.

    Bucketing puts the same keys of several tables in files of the same number,
    so joining them on that key needs no shuffle. The table is external: its
    files stay in the shared folder.
    """
    spark = df.sparkSession
    table = f"fieldlake_{name}_{uuid.uuid4().hex[:12]}"
    path = f"{shared_dir(spark)}/{table}"
    owner = _owner(spark)
    owner.tables.append(table)
    owner.paths.append(path)
    if bucket_by:
        df = df.repartition(buckets, bucket_by)
    elif partition_by:
        # Evens out the files of small and of dominant partition values.
        df = df.hint("rebalance", partition_by)
    writer = df.write.format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)
    # Without statistics a partitioned table counts as infinitely large.
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")
    return table


def bucket_count(spark: SparkSession, stored: DataFrame, bucket_bytes: int = 16 << 20) -> int:
    """Buckets of about `bucket_bytes` of a stored frame, at least a few to share the work.

    One task sorts a bucket to write it, and rows in memory take many times their Parquet size.
    """
    least = min(8, spark.sparkContext.defaultParallelism)
    return max(least, min(-(-stored_bytes(spark, stored) // bucket_bytes), 50_000))


def stored_bytes(spark: SparkSession, df: DataFrame) -> int:
    """Bytes of the folders whose files a frame reads; 0 if it reads none."""
    return sum(file_state(spark, path)[0] for path in _folders(df))


def source_state(spark: SparkSession, paths: list[str]) -> tuple:
    """Size, file count and modification time of each path."""
    return tuple(file_state(spark, path) for path in paths)


def _folders(stored: DataFrame) -> list[str]:
    return sorted({path.rsplit("/", 1)[0] for path in stored.inputFiles()})
