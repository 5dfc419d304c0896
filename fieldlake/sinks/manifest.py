"""What a published run consists of: per table partition a content digest and the run that holds its files.

A partition whose digest equals that of the run before is not written again: the
new run refers to the files that are there. A digest is the number of rows, the
sum of one 64-bit hash of every row and the exclusive or of another, so it does not depend on
the order of rows or on how they are spread over files.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldlake.sinks.files import child_names, read_text, write_text

FOLDER = "MANIFEST"


@dataclass(frozen=True)
class Part:
    """A partition: its value (None for null, and for a whole table without partitions), content and place."""

    value: str | None
    rows: int
    digest: str
    run: str


@dataclass(frozen=True)
class TableManifest:
    table: str
    schema: str
    partition: str | None
    key: str | None
    buckets: int
    parts: tuple[Part, ...]

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))

    def fits(self, other: "TableManifest") -> bool:
        """Whether files of one can stand beside files of the other."""
        return (self.schema, self.partition, self.key, self.buckets) == (
            other.schema, other.partition, other.key, other.buckets
        )

    def text(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def parse(cls, text: str) -> "TableManifest":
        found = json.loads(text)
        return cls(**{**found, "parts": tuple(Part(**part) for part in found["parts"])})


def partition_value(column: str) -> Column:
    """A partition column's value as its folder says it: empty text is null."""
    return F.nullif(F.col(column).cast("string"), F.lit(""))


def content(df: DataFrame, partition: str | None) -> dict[str | None, tuple[int, str]]:
    """Rows and digest of each partition of a frame; one aggregate, one row a partition."""
    columns = sorted(c for c in df.columns if c != partition)
    # A hash passes over nulls, so each null is said as well.
    told = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    first, second = F.xxhash64(*told), F.xxhash64(F.lit("second"), *told)
    sums = [
        F.count(F.lit(1)).alias("rows"),
        F.sum(first.cast("decimal(20,0)")).cast("string").alias("sum"),
        F.bit_xor(second).cast("string").alias("xor"),
    ]
    by = [partition_value(partition).alias("value")] if partition else [F.lit(None).cast("string").alias("value")]
    found = df.select(*by, "*").groupBy("value").agg(*sums).collect() if partition else df.agg(*sums).select(*by, "*").collect()
    return {r["value"]: (r["rows"], f"{r['rows']}:{r['sum']}:{r['xor']}") for r in found}


def partition_folder(spark: SparkSession, column: str, value: str | None) -> str:
    """The name of a partition's folder, as Spark writes it."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return names.getPartitionPathString(column, value)


def part_path(spark: SparkSession, target: str, manifest: TableManifest, part: Part) -> str:
    path = f"{target.rstrip('/')}/run={part.run}/{manifest.table}"
    return f"{path}/{partition_folder(spark, manifest.partition, part.value)}" if manifest.partition else path


def write_manifest(spark: SparkSession, run_path: str, manifest: TableManifest) -> None:
    write_text(spark, f"{run_path.rstrip('/')}/{FOLDER}/{manifest.table}", manifest.text())


def read_manifest(spark: SparkSession, run_path: str, table: str) -> TableManifest | None:
    text = read_text(spark, f"{run_path.rstrip('/')}/{FOLDER}/{table}")
    return TableManifest.parse(text) if text else None


def manifests(spark: SparkSession, run_path: str) -> dict[str, TableManifest]:
    names = child_names(spark, f"{run_path.rstrip('/')}/{FOLDER}")
    found = {name: read_manifest(spark, run_path, name) for name in names}
    return {name: manifest for name, manifest in found.items() if manifest}
