"""Publish a consistent set of Parquet tables.

A run writes into its own folder. Readers follow the newest pointer, a file that
is created only after every table of the run is written and validated and is
never rewritten, so they see the old set or the new one and never a mixture.

A run may carry over what has not changed: partitions whose content is that of
the run before stay where they are, and the run's manifest refers to them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.contracts import PUBLISH_ORDER, ROLLUPS, STAR
from fieldlake.sinks import manifest as listing
from fieldlake.sinks.manifest import Part, TableManifest
from fieldlake.plans.checks import contract_faults
from fieldlake.plans.quality import same_columns
from fieldlake.sinks.files import child_names, create_empty, next_pointer, pointers, remove
from fieldlake.sources.tables import Files, Layout, MissingTableError, forget_layouts, note_layout, read_table

_POINTER, _RETIRED = "CURRENT", "RETIRED"


class PublishError(RuntimeError):
    """A run broke its contracts and was not made current."""


class Snapshot:
    """One run: write tables, read them back, make them current.

    With `carry` the run notes what each partition holds and writes only those
    partitions that differ from the current run's. A frame is then computed twice
    where it has changed, once for its digests, and must give the same rows both times.
    """

    def __init__(self, spark: SparkSession, target: str, carry: bool = False):
        self.spark = spark
        self.target = target.rstrip("/")
        self.run = uuid.uuid4().hex[:12]
        self.written: list[str] = []
        self.carry = carry
        #: By table: values of the partitions that this run wrote.
        self.changed: dict[str, list[str | None]] = {}
        found = pointers(spark, f"{self.target}/{_POINTER}") if carry else []
        self.base = listing.manifests(spark, f"{self.target}/run={found[-1][1]}") if found else {}

    @property
    def files(self) -> Files:
        return Files(f"{self.target}/run={self.run}")

    def write(self, name: str, df: DataFrame, buckets: int | None = None) -> DataFrame:
        """Store a table and return it as stored.

        With `buckets` a table whose contract names a bucket column is stored in
        that many: tables of one run with the same number join without a shuffle,
        because readers find the layout noted beside the tables.
        """
        contract = STAR.get(name)
        partition = contract.partition_by if contract else None
        key = contract.bucket_by if contract and buckets else None
        if self.carry:
            self._write_changed(name, df, partition, key, buckets)
        else:
            self._write(name, df, partition, key, buckets)
            if key:
                note_layout(self.spark, self.files, Layout(name, key, buckets, partition))
        self.written.append(name)
        return self.table(name)

    def _write(self, name: str, df: DataFrame, partition: str | None, key: str | None, buckets: int | None) -> None:
        path = f"{self.files.path}/{name}"
        if key:
            table = f"fieldlake_write_{name}_{uuid.uuid4().hex[:12]}"
            writer = df.repartition(buckets, key).write.format("parquet").option("path", path)
            writer = writer.partitionBy(partition) if partition else writer
            writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
            # The table's files stay: they are outside the catalog.
            self.spark.sql(f"DROP TABLE {table}")
        elif partition:
            # Splits dominant partition values over several files, merges tiny ones.
            df.hint("rebalance", partition).write.partitionBy(partition).parquet(path)
        else:
            df.write.parquet(path)

    def _write_changed(self, name: str, df: DataFrame, partition: str | None, key: str | None, buckets: int | None) -> None:
        if partition:
            df = df.select(*[c for c in df.columns if c != partition], partition)
        new = TableManifest(name, df.schema.json(), partition, key, buckets if key else 0, ())
        before = self.base.get(name)
        known = {part.value: part for part in before.parts} if before and before.fits(new) else None
        if known is None:
            self._write(name, df, partition, key, buckets)
            found = listing.content(self._stored(name, df), partition)
            same: dict[str | None, Part] = {}
        else:
            found = listing.content(df, partition)
            same = {v: known[v] for v, (_, digest) in found.items() if v in known and known[v].digest == digest}
            differs = [v for v in found if v not in same]
            if differs:
                self._write(name, df.where(_any_of(partition, differs)) if partition else df, partition, key, buckets)
        self.changed[name] = sorted((v for v in found if v not in same), key=str)
        parts = tuple(same.get(v) or Part(v, rows, digest, self.run) for v, (rows, digest) in sorted(found.items(), key=str))
        listing.write_manifest(self.spark, self.files.path, replace(new, parts=parts))

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(f"{self.files.path}/{name}")

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.files, name)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.written}

    def commit(
        self,
        validate: Callable[[dict[str, DataFrame]], None] | None = None,
        keep: int | None = None,
    ) -> str:
        """Make the run current unless `validate` raises; `keep` runs stay, all without it."""
        if validate:
            validate(self.tables())
        next_pointer(self.spark, f"{self.target}/{_POINTER}", self.run)
        if keep is not None:
            retire(self.spark, self.target, keep)
        return self.run


def publish(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    target: str,
    validate: Callable[[dict[str, DataFrame]], None] | None = None,
    carry: bool = False,
) -> str:
    """Write all tables, dimensions first, and make them current together."""
    snapshot = Snapshot(spark, target, carry)
    for name in sorted(tables, key=_position):
        snapshot.write(name, tables[name])
    return snapshot.commit(validate)


def current(spark: SparkSession, target: str) -> Files:
    """The tables readers should use."""
    found = pointers(spark, f"{target.rstrip('/')}/{_POINTER}")
    if not found:
        raise MissingTableError(f"nothing published under {target}")
    return Files(f"{target.rstrip('/')}/run={found[-1][1]}")


def retire(spark: SparkSession, target: str, keep: int) -> list[str]:
    """Retire all published runs but the newest `keep`; returns the retired.

    Their pointers and files go, except partitions that a later run has carried
    over; those go when no run refers to them any more. Runs without a pointer stay: one may be in the making. Readers of a deleted
    run fail, so `keep` should cover the longest reader.
    """
    if keep < 1:
        raise ValueError("the current run stays")
    target = target.rstrip("/")
    folder = f"{target}/{_POINTER}"
    old = pointers(spark, folder)[:-keep]
    for number, run in old:
        forget_layouts(spark, Files(f"{target}/run={run}"))
        remove(spark, f"{folder}/{number:012d}-{run}")
        create_empty(spark, f"{target}/run={run}/{_RETIRED}")
    _sweep(spark, target)
    return [run for _, run in old]


def _sweep(spark: SparkSession, target: str) -> None:
    """Delete what retired runs hold, but for partitions to which another run refers."""
    runs = [name.partition("=")[2] for name in child_names(spark, target) if name.startswith("run=")]
    retired = {run for run in runs if _RETIRED in child_names(spark, f"{target}/run={run}")}
    used: set[tuple[str, str, str | None]] = set()
    # A run in the making has no pointer yet, but its manifests count.
    for run in set(runs) - retired:
        for table, manifest in listing.manifests(spark, f"{target}/run={run}").items():
            used |= {(part.run, table, part.value) for part in manifest.parts}
    for run in retired:
        if not any(holder == run for holder, _, _ in used):
            remove(spark, f"{target}/run={run}")
            continue
        for table, manifest in listing.manifests(spark, f"{target}/run={run}").items():
            for part in manifest.parts:
                if part.run == run and (run, table, part.value) not in used:
                    remove(spark, listing.part_path(spark, target, manifest, part))


def _any_of(partition: str, values: list[str | None]) -> Column:
    value = listing.partition_value(partition)
    chosen = value.isin([v for v in values if v is not None])
    return F.coalesce(chosen, F.lit(None in values))


def require_clean_contracts(tables: dict[str, DataFrame]) -> None:
    """Raise unless every table has its declared columns and keeps every column rule."""
    contracts = {**STAR, **ROLLUPS}
    shapes = [n for n, df in tables.items() if n in contracts and not same_columns(df, contracts[n])]
    if shapes:
        raise PublishError(f"columns differ from the contract: {shapes}")
    # One row per declared column at most.
    known = {n: df for n, df in tables.items() if n in contracts}
    broken = contract_faults(known, contracts).where("nulls + too_long + out_of_range > 0").collect() if known else []
    if broken:
        found = ", ".join(f"{row.table_name}.{row.column_name}" for row in broken)
        raise PublishError(f"contract violations in {found}")


def _position(name: str) -> int:
    return PUBLISH_ORDER.index(name) if name in PUBLISH_ORDER else len(PUBLISH_ORDER)
