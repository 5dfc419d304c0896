"""The newest row per key of all that has landed, kept compact and merged in place of being recomputed.

A snapshot holds one row per key, in hash buckets of the key. A merge reads the
batches that it has not seen and those buckets that their keys fall into, keeps
the newest row of each key and writes these buckets anew; all other buckets are
carried over by reference. So the work follows the new rows and the buckets they
touch, not the history, and merged batches are needed no more.

Every version has a folder with the buckets it wrote and a manifest of all buckets. A
version becomes current by the creation of a pointer, as a published run does;
a merge that stops half-way leaves the old version and is simply done again.
Merging a batch twice, or rows that came before, changes no row's winner.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.contracts import Contract
from fieldlake.operators.dedup import first_per_key
from fieldlake.sinks.files import child_names, file_state, next_pointer, pointers, read_text, remove, write_text

_BUCKET, _MANIFEST, _POINTER = "_bucket", "MANIFEST", "CURRENT"


@dataclass
class Manifest:
    """Where each bucket of a version is, and the state of the landed batches it covers."""

    buckets: int
    places: dict[int, str] = field(default_factory=dict)
    batches: dict[str, list[int]] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"buckets": self.buckets, "places": self.places, "batches": self.batches}, sort_keys=True)

    @classmethod
    def parse(cls, text: str) -> "Manifest":
        found = json.loads(text)
        return cls(found["buckets"], {int(b): place for b, place in found["places"].items()}, found["batches"])


class KeyedSnapshot:
    """One row per key of a feed under `path`.

    `metadata` are columns beside the contract's that rank rows, as DDL; `newest` orders the
    rows of a key, the winner first, and every remaining column breaks ties, as in
    `first_per_key`. `bucket_bytes` is the size buckets should have: a snapshot that has
    outgrown four times that is dealt into more buckets by its next merge.
    """

    def __init__(
        self, spark: SparkSession, path: str, contract: Contract, metadata: str, newest: Sequence[Column],
        bucket_bytes: int = 128 << 20, least_buckets: int = 16,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.contract = contract
        self.schema = f"{contract.ddl}, {metadata}"
        self.newest = list(newest)
        self.bucket_bytes = bucket_bytes
        self.least_buckets = least_buckets

    # Versions -----------------------------------------------------------------

    def version(self) -> str | None:
        """The current version, None before the first merge."""
        found = pointers(self.spark, f"{self.path}/{_POINTER}")
        return found[-1][1] if found else None

    def manifest(self, version: str | None = None) -> Manifest | None:
        version = version or self.version()
        text = read_text(self.spark, f"{self._folder(version)}/{_MANIFEST}") if version else None
        return Manifest.parse(text) if text else None

    def _folder(self, version: str) -> str:
        return f"{self.path}/version={version}"

    def _read(self, manifest: Manifest, buckets: Sequence[int]) -> DataFrame:
        paths = [f"{self._folder(manifest.places[b])}/{_BUCKET}={b}" for b in buckets if b in manifest.places]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rows(self) -> DataFrame:
        """The newest row of each key, contract columns only."""
        manifest = self.manifest()
        if manifest is None:
            return self.spark.createDataFrame([], self.contract.ddl)
        return self._read(manifest, sorted(manifest.places)).select(*self.contract.columns)

    def bytes(self) -> int:
        manifest = self.manifest()
        places = manifest.places.items() if manifest else ()
        return sum(file_state(self.spark, f"{self._folder(v)}/{_BUCKET}={b}")[0] for b, v in places)

    # Merging ------------------------------------------------------------------

    def pending(self, landing: str) -> dict[str, list[int]]:
        """Batches of a landing folder that the current version does not cover, with their state.

        A batch that was landed again, after a failure between landing and
        checkpoint, has another state and counts as new.
        """
        manifest = self.manifest()
        covered = manifest.batches if manifest else {}
        found = {name: list(file_state(self.spark, f"{landing.rstrip('/')}/{name}")) for name in child_names(self.spark, landing) if "=" in name}
        return {name: state for name, state in found.items() if covered.get(name) != state}

    def merge(self, landing: str, keep: int = 2) -> str | None:
        """Merge all pending batches into a new version; returns it, or None if there was nothing to do.

        `keep` versions stay readable. Batches may be removed once they are covered: see `drop_covered`.
        """
        landing = landing.rstrip("/")
        new = self.pending(landing)
        if not new:
            return None
        before = self.manifest() or Manifest(0)
        arriving = (
            self.spark.read.schema(self.schema).option("basePath", landing)
            .parquet(*(f"{landing}/{name}" for name in sorted(new)))
        )
        incoming = sum(state[0] for state in new.values())
        wanted = max(self.least_buckets, -(-(self.bytes() + incoming) // self.bucket_bytes))
        if before.places and wanted <= 4 * before.buckets:
            buckets = before.buckets
            # At most as many rows as buckets.
            touched = sorted(r[0] for r in arriving.select(self._bucket(buckets)).distinct().collect())
            stored = self._read(before, touched)
        else:
            buckets, touched = wanted, None
            stored = self._read(before, sorted(before.places))
        merged = first_per_key(stored.unionByName(arriving), self.contract.key, self.newest)
        version = uuid.uuid4().hex[:12]
        folder = self._folder(version)
        merged = merged.withColumn(_BUCKET, self._bucket(buckets))
        merged.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(folder)
        written = [int(name.partition("=")[2]) for name in child_names(self.spark, folder) if name.startswith(f"{_BUCKET}=")]
        carried = {} if touched is None else before.places
        after = Manifest(buckets, carried | {b: version for b in written}, self._covered(landing, before, new))
        write_text(self.spark, f"{folder}/{_MANIFEST}", after.text())
        next_pointer(self.spark, f"{self.path}/{_POINTER}", version)
        self.retire(keep)
        return version

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.contract.key), F.lit(buckets)).cast("int").alias(_BUCKET)

    def _covered(self, landing: str, before: Manifest, new: dict[str, list[int]]) -> dict[str, list[int]]:
        there = set(child_names(self.spark, landing))
        return {name: state for name, state in (before.batches | new).items() if name in there}

    def drop_covered(self, landing: str) -> list[str]:
        """Remove landed batches whose rows the current version holds; the newest stays, as it may be landed again."""
        landing, manifest = landing.rstrip("/"), self.manifest()
        pending = self.pending(landing)
        covered = [name for name in (manifest.batches if manifest else {}) if name not in pending]
        old = sorted(covered, key=lambda name: int(name.partition("=")[2]))[:-1]
        for name in old:
            remove(self.spark, f"{landing}/{name}")
        return old

    def retire(self, keep: int) -> None:
        """Forget all but the newest `keep` versions, and delete the buckets that none of those refers to."""
        if keep < 1:
            raise ValueError("the current version stays")
        found = pointers(self.spark, f"{self.path}/{_POINTER}")
        kept = [version for _, version in found[-keep:]]
        used = {(v, b) for version in kept for b, v in self.manifest(version).places.items()}
        for number, version in found[:-keep]:
            remove(self.spark, f"{self.path}/{_POINTER}/{number:012d}-{version}")
        forgotten = {name.partition("=")[2] for name in child_names(self.spark, self.path) if name.startswith("version=")}
        for version in forgotten - set(kept):
            folder = self._folder(version)
            # A folder without a manifest may be in the making.
            if _MANIFEST not in child_names(self.spark, folder):
                continue
            own = {int(n.partition("=")[2]) for n in child_names(self.spark, folder) if n.startswith(f"{_BUCKET}=")}
            for bucket in own:
                if (version, bucket) not in used:
                    remove(self.spark, f"{folder}/{_BUCKET}={bucket}")
            if not any((version, bucket) in used for bucket in own):
                remove(self.spark, folder)
