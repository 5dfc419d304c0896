"""Refresh when new CSV files arrive.

A file stream notices each file once. Its rows land in a Parquet folder, one
sub-folder per micro-batch; a batch that runs again after a failure overwrites
its own sub-folder, and a file delivered twice only adds rows that the
per-key resolution removes. So repeats change nothing downstream.

Landed batches are merged into a snapshot of each feed, one row per key, so that
a refresh reads the snapshot and never the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldlake.contracts import FEEDS, Contract
from fieldlake.operators.dedup import first_per_key
from fieldlake.plans.pipeline import refresh
from fieldlake.sinks.files import read_text, write_text
from fieldlake.sources.feeds import FEED_FILES
from fieldlake.streaming.snapshots import KeyedSnapshot

_ARRIVED, _FILE, _BATCH = "_arrived", "_file", "_batch"
_METADATA = f"{_ARRIVED} TIMESTAMP, {_FILE} STRING, {_BATCH} BIGINT"

Handler = Callable[[DataFrame, int], None]


def read_new_files(
    spark: SparkSession, raw_dir: str, contract: Contract, pattern: str = "*.csv"
) -> DataFrame:
    """Stream of the CSV files in a folder with each row's file and arrival time.

    Only names that fit the pattern count, so files the job writes cannot start it.
    """
    files = (
        spark.readStream.schema(contract.schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", pattern)
        .csv(raw_dir)
    )
    return files.select(
        "*",
        F.col("_metadata.file_modification_time").alias(_ARRIVED),
        F.col("_metadata.file_path").alias(_FILE),
    )


def land(batch: DataFrame, batch_id: int, landing: str) -> None:
    batch.write.mode("overwrite").parquet(f"{landing.rstrip('/')}/{_BATCH}={batch_id}")


def newest_first() -> list[Column]:
    return [F.col(_ARRIVED).desc_nulls_last(), F.col(_BATCH).desc_nulls_last()]


def landed(spark: SparkSession, landing: str, contract: Contract) -> DataFrame:
    """One row per key from all landed files: the newest file wins. Reads the whole history."""
    rows = spark.read.schema(f"{contract.ddl}, {_METADATA}").parquet(landing)
    return first_per_key(rows, contract.key, newest_first()).select(*contract.columns)


def feed_snapshot(spark: SparkSession, path: str, contract: Contract, **options) -> KeyedSnapshot:
    """The snapshot that holds the same rows as `landed`, merged batch by batch."""
    return KeyedSnapshot(spark, path, contract, _METADATA, newest_first(), **options)


def refresh_stream(
    spark: SparkSession,
    raw_dir: str,
    contract: Contract,
    checkpoint: str,
    handler: Handler,
    pattern: str = "*.csv",
) -> StreamingQuery:
    """Pass all files not yet seen to `handler` as micro-batches, then stop."""
    return (
        read_new_files(spark, raw_dir, contract, pattern)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(handler)
        .trigger(availableNow=True)
        .start()
    )


def refresh_on_arrival(
    spark: SparkSession, raw_dir: str, landing: str, checkpoint: str, target: str, keep_landed: bool = False, **options
) -> dict[str, int] | None:
    """Land all new feed files, merge them, then rebuild and publish the model if anything changed.

    A feed's files are those whose name starts like its usual file. Nothing is
    published before every feed has landed once. Which snapshots were published is
    noted after publication, so a run that stops half-way is made up for by the next one.
    Landed batches go once they are merged, but the last of each feed, unless `keep_landed`.
    Returns the rows read per feed, or None if there was nothing to do.
    """
    snapshots = {}
    for name, file in FEED_FILES.items():
        folder = f"{landing.rstrip('/')}/{name}"
        refresh_stream(
            spark,
            raw_dir,
            FEEDS[name],
            f"{checkpoint.rstrip('/')}/{name}",
            lambda batch, batch_id, folder=folder: land(batch, batch_id, folder),
            pattern=file.replace(".csv", "*.csv"),
        ).awaitTermination()
        snapshots[name] = feed_snapshot(spark, f"{landing.rstrip('/')}/_snapshots/{name}", FEEDS[name])
        snapshots[name].merge(folder)
        if not keep_landed:
            snapshots[name].drop_covered(folder)

    note = f"{target.rstrip('/')}/LANDED"
    versions = {name: snapshot.version() for name, snapshot in snapshots.items()}
    state = " ".join(f"{name}:{version}" for name, version in versions.items())
    if not all(versions.values()) or read_text(spark, note) == state:
        return None
    counts = refresh({name: snapshot.rows() for name, snapshot in snapshots.items()}, target, unique=True, **options)
    write_text(spark, note, state)
    return counts
