"""Published tables from Parquet folders or a database."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from fieldlake.contracts import STAR
from fieldlake.sinks.files import child_names, create_empty
from fieldlake.sinks.manifest import FOLDER as MANIFESTS
from fieldlake.sinks.manifest import TableManifest, part_path, read_manifest

_LOG = logging.getLogger(__name__)


class MissingTableError(LookupError):
    """A table that the caller needs is not where it should be."""


@dataclass(frozen=True)
class Files:
    """One Parquet folder per table."""

    path: str


@dataclass(frozen=True)
class Layout:
    """How a table's files are bucketed; Parquet files do not say so themselves."""

    table: str
    key: str
    buckets: int
    partition: str | None = None


_LAYOUTS = "LAYOUT"


def note_layout(spark: SparkSession, source: Files, layout: Layout) -> None:
    """Note a layout as the name of an empty file, which is there whole or not at all."""
    note = f"{layout.table}.{layout.key}.{layout.buckets}.{layout.partition or ''}"
    create_empty(spark, f"{source.path.rstrip('/')}/{_LAYOUTS}/{note}")


def layouts(spark: SparkSession, source: Files) -> dict[str, Layout]:
    found = {}
    for note in child_names(spark, f"{source.path.rstrip('/')}/{_LAYOUTS}"):
        table, key, buckets, partition = note.split(".")
        found[table] = Layout(table, key, int(buckets), partition or None)
    return found


def _entry(path: str) -> str:
    return f"fieldlake_read_{hashlib.md5(path.encode()).hexdigest()}"


def forget_layouts(spark: SparkSession, source: Files) -> None:
    """Drop the session's catalog entries of a source's bucketed and assembled tables."""
    noted = child_names(spark, f"{source.path.rstrip('/')}/{MANIFESTS}")
    for table in {*layouts(spark, source), *noted}:
        spark.sql(f"DROP TABLE IF EXISTS {_entry(source.path.rstrip('/') + '/' + table)}")


def _bucketed(spark: SparkSession, source: Files, layout: Layout, found: DataFrame) -> DataFrame:
    """The table through an entry in the session's catalog, which is where Spark keeps bucketing."""
    path = f"{source.path.rstrip('/')}/{layout.table}"
    name = _entry(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            + (f" PARTITIONED BY (`{layout.partition}`)" if layout.partition else "")
            + f" CLUSTERED BY (`{layout.key}`) SORTED BY (`{layout.key}`) INTO {layout.buckets} BUCKETS"
            + f" LOCATION '{path}'"
        )
        if layout.partition:
            spark.catalog.recoverPartitions(name)
        # Without statistics a partitioned table counts as infinitely large.
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    return spark.table(name)


def _assembled(spark: SparkSession, source: Files, manifest: TableManifest) -> DataFrame:
    """A table whose partitions may lie in several runs, through an entry in the session's catalog."""
    target = source.path.rstrip("/").rpartition("/")[0]
    name = _entry(f"{source.path.rstrip('/')}/{manifest.table}")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in manifest.columns)
        # A whole table is where its one part is; partitions say so each for itself.
        place = f"{source.path.rstrip('/')}/{manifest.table}"
        if not manifest.partition and manifest.parts:
            place = part_path(spark, target, manifest, manifest.parts[0])
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            + (f" PARTITIONED BY (`{manifest.partition}`)" if manifest.partition else "")
            + (f" CLUSTERED BY (`{manifest.key}`) SORTED BY (`{manifest.key}`) INTO {manifest.buckets} BUCKETS" if manifest.key else "")
            + f" LOCATION '{place}'"
        )
        if manifest.partition:
            for part in manifest.parts:
                value = "null" if part.value is None else "'" + part.value.replace("\\", "\\\\").replace("'", "\\'") + "'"
                spark.sql(
                    f"ALTER TABLE {name} ADD PARTITION (`{manifest.partition}`={value})"
                    f" LOCATION '{part_path(spark, target, manifest, part)}'"
                )
        # Without statistics a partitioned table counts as infinitely large.
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    return spark.table(name)


@dataclass(frozen=True)
class Split:
    """How a parallel database read divides a table: a number or date column and its range."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class Database:
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    splits: dict[str, Split] = field(default_factory=dict)
    fetch_rows: int = 10_000


def jdbc_options(source: Database, table: str) -> dict[str, str]:
    """Options of the JDBC reader; without a split one connection reads the table."""
    options = {"url": source.url, "dbtable": table, "fetchsize": str(source.fetch_rows)}
    options.update(source.properties)
    split = source.splits.get(table)
    if split:
        options.update(
            partitionColumn=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=str(split.partitions),
        )
    return options


def read_table(spark: SparkSession, source: Files | Database, table: str) -> DataFrame:
    if isinstance(source, Database):
        return spark.read.format("jdbc").options(**jdbc_options(source, table)).load()
    contract = STAR.get(table)
    manifest = read_manifest(spark, source.path, table)
    if manifest:
        found = _assembled(spark, source, manifest)
        return found.select(*contract.columns) if contract and set(contract.columns) == set(found.columns) else found
    try:
        found = spark.read.parquet(f"{source.path.rstrip('/')}/{table}")
    except AnalysisException as error:
        raise MissingTableError(f"no table {table} under {source.path}") from error
    layout = layouts(spark, source).get(table)
    if layout:
        found = _bucketed(spark, source, layout, found)
    # Partition columns come back last; return the declared order.
    if contract and set(contract.columns) == set(found.columns):
        return found.select(*contract.columns)
    return found


def load_tables(
    spark: SparkSession,
    source: Files | Database,
    tables: Sequence[str] = tuple(STAR),
    fallback: Files | None = None,
) -> dict[str, DataFrame]:
    """The named tables; from `fallback` when the database cannot be reached.

    Which source was used is logged, a fallback as a warning. A missing table, a
    refused login or a mistake in a query is an error, never a fallback.
    """
    try:
        found = {name: read_table(spark, source, name) for name in tables}
        _LOG.info("read %s from %s", ", ".join(tables), _place(source))
        return found
    except Exception as error:  # errors of a JDBC driver arrive in the bridge's own types
        if fallback is None or not isinstance(source, Database) or not _unreachable(error):
            raise
        _LOG.warning("%s cannot be reached, reading %s: %s", _place(source), fallback.path, _first_line(error))
    return load_tables(spark, fallback, tables)


# What JVM connection and driver-loading errors are called or say, and the SQL
# states of class 08, connection exceptions.
_UNREACHABLE = (
    "ConnectException", "UnknownHostException", "NoRouteToHost", "SocketTimeout", "CommunicationsException",
    "Connection refused", "ClassNotFoundException", "SQLSTATE 08", "SQLState: 08",
    "Connection attempt failed", "The connection attempt failed",
)


def _unreachable(error: Exception) -> bool:
    return any(sign in f"{type(error).__name__} {error}" for sign in _UNREACHABLE)


def _place(source: Files | Database) -> str:
    return source.url.split("?")[0] if isinstance(source, Database) else source.path


def _first_line(error: Exception) -> str:
    return (str(error).strip().splitlines() or [type(error).__name__])[0]
