"""Whitening of embeddings from exact integer cross-products (bit-sliced scatter).

Entries become integers. Each dimension's integers, shifted to start at 0, are cut into bit
planes; a plane holds one bit a row, packed into 64-bit words. The sum over rows of the product
of two dimensions is then the sum, over pairs of their planes, of a power of two times the
popcount of the planes' AND: integers throughout. A constant dimension of ones gives the sums and
the number of rows the same way. Tasks add their blocks up and emit one row a pair of dimensions;
Spark sums those rows; the driver sees one matrix, never vectors. The covariance is centred as
integers, n * sum(x y) - sum(x) sum(y), and only then divided.

Defined results for odd input: a null vector, and one with a null, NaN or infinite entry, is
dropped. Entries beyond the range of a long are taken as its ends. Vectors of different lengths
are fitted apart, each length as a list of its own. An empty vector has no components and gives
no rows; so does an empty table. Repeated vectors count once in the fit, but every row is
returned, rows of equal or null ids included. A component without variance (all vectors equal, or
fewer distinct vectors than dimensions) has whitened null and is left out of the identity error.
Columns other than the id and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.common import Scratch

_LIMBS = 5
_ROWS = 8192


def integers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """The key, and `x`: floor(scale * entry) of each sound vector."""
    entry = F.col(vector)
    sound = entry.isNotNull() & F.forall(entry, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(entry, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return vectors.where(sound).select(F.col(key).alias("key"), x.alias("x"))


def planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of a block of rows: words by plane, each plane's dimension and power, each dimension's shift.

    The last dimension is the constant 1. Planes are in order of dimension and power.
    """
    m, d = x.shape
    low = x.min(axis=0)
    # Differences of longs fit unsigned longs, also where the signed difference wraps.
    raised = (x - low).view(np.uint64)
    width = [int(v).bit_length() for v in raised.max(axis=0)]
    padded = -(-m // 64) * 64
    words = np.zeros((sum(width) + 1, padded // 64), dtype=np.uint64)
    dims = np.repeat(np.arange(d + 1), [*width, 1])
    powers = np.concatenate([*(np.arange(w) for w in width), [0]]).astype(np.int64)
    bits = np.zeros((padded, d + 1), dtype=np.uint8)
    bits[:m, d] = 1
    for p in range(max([1, *width])):
        own = np.flatnonzero(powers == p)
        bits[:m, :d] = (raised >> np.uint64(p)) & np.uint64(1)
        packed = np.packbits(bits[:, dims[own]], axis=0, bitorder="little")
        words[own] = np.ascontiguousarray(packed.T).view(np.uint64)
    return words, dims, powers, np.append(low, 0)


def scatter(x: np.ndarray) -> np.ndarray:
    """Exact sums over rows of products of columns; the last column is the constant 1.

    The corner is the number of rows, the last column beside it the sums. Python integers
    above the diagonal, zero below.
    """
    m, d = x.shape
    total = np.zeros((d + 1, d + 1), dtype=object)
    for first in range(0, m, _ROWS):
        words, dims, powers, low = planes(x[first : first + _ROWS])
        starts = np.searchsorted(dims, np.arange(d + 1))
        # Weighted counts of a plane stay below 2 ** (power + 1 + bits of the row count).
        kind = np.int64 if int(powers.max()) < 40 else object
        weight = np.array([1 << int(p) for p in powers], dtype=kind)
        own = np.zeros((d + 1, d + 1), dtype=object)
        for k, dim in enumerate(dims.tolist()):
            hits = np.bitwise_count(words[k] & words[k:]).sum(axis=1, dtype=np.int64).astype(kind) * weight[k:]
            # Two planes of one dimension meet twice in its square.
            hits[1 : np.searchsorted(dims, dim, "right") - k] *= 2
            present = np.flatnonzero(np.append(starts[1:], len(dims))[dim:] > np.maximum(starts[dim:], k)) + dim
            sums = np.add.reduceat(hits, np.maximum(starts[present], k) - k)
            own[dim, present] += sums.astype(object) * (1 << int(powers[k]))
        shift = low.astype(object)
        rows, sums = own[d, d], own[:, d]
        own = own + np.outer(shift, sums) + np.outer(sums, shift) + rows * np.outer(shift, shift)
        total += np.triu(own)
    return total


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by length: (row numbers, matrix)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = np.asarray(column.flatten())
    lengths = np.asarray(column.value_lengths())
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        yield rows, values[starts[rows][:, None] + np.arange(d)].reshape(len(rows), d)


def cross_products(fit_list: DataFrame) -> DataFrame:
    """Sums of products by length and pair of dimensions, each in limbs of 32 bits, the last signed."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                if x.shape[1]:
                    sums[x.shape[1]] = sums.get(x.shape[1], 0) + scatter(x)
        for d, total in sums.items():
            for i in range(d + 1):
                values = [int(v) for v in total[i, i:]]
                limbs = {f"l{k}": pa.array([(v >> 32 * k) & 0xFFFFFFFF for v in values], pa.int64()) for k in range(_LIMBS - 1)}
                limbs[f"l{_LIMBS - 1}"] = pa.array([v >> 32 * (_LIMBS - 1) for v in values], pa.int64())
                own = {"dims": pa.array([d] * len(values), pa.int32()), "i": pa.array([i] * len(values), pa.int32())}
                yield pa.RecordBatch.from_pydict(own | {"j": pa.array(range(i, d + 1), pa.int32())} | limbs)

    names = [f"l{k}" for k in range(_LIMBS)]
    schema = "dims int, i int, j int, " + ", ".join(f"{n} long" for n in names)
    return fit_list.select("x").mapInArrow(partial, schema).groupBy("dims", "i", "j").agg(*(F.sum(n).alias(n) for n in names))


@dataclass
class Whitening:
    """Of one length: distinct vectors, their sums, and by component axis, eigenvalue and share of the trace."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    def project(self, x: np.ndarray) -> tuple[list[Decimal | None], np.ndarray]:
        """Sum of squares of n * x - sums of each row, exact, and its whitened components (NaN without variance)."""
        most = max(abs(int(x.min())), abs(int(x.max()))) * self.n + max(map(abs, self.sums))
        exact = np.int64 if most < 1 << 62 else object
        moved = x.astype(exact) * self.n - np.array(self.sums, dtype=exact)
        squares = moved if most * most * len(self.sums) < 1 << 63 else moved.astype(object)
        deviation = [Decimal(v) if v < 10**38 else None for v in map(int, (squares * squares).sum(axis=1))]
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = np.where(self.values > 0, 1 / np.sqrt(self.values), np.nan)
        # Row by row, so that equal vectors give equal doubles in any batch.
        centred = moved.astype(np.float64) / self.n
        return deviation, np.stack([(centred * axis).sum(axis=1) for axis in self.axes], axis=1) * scaled


def solve(products: np.ndarray, components: int) -> Whitening:
    """Eigenvectors of the covariance, from the exact sums of products."""
    d = len(products) - 1
    n, sums = int(products[d, d]), [int(v) for v in products[:d, d]]
    covariance = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            # Python divides integers of any size to the nearest double.
            covariance[i, j] = covariance[j, i] = (n * int(products[i, j]) - sums[i] * sums[j]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    trace = float(np.trace(covariance))
    kept = np.argsort(-values, kind="stable")[:components]
    values = np.where(values[kept] > d * np.finfo(np.float64).eps * trace, values[kept], 0.0)
    share = values / trace if trace > 0 else np.zeros(len(kept))
    return Whitening(n, sums, np.ascontiguousarray(vectors[:, kept].T), values, share)


def project(rows: DataFrame, models: dict[int, Whitening]) -> DataFrame:
    """Of each row of `integers`: key, dims, deviation, and the whitened components as an array."""
    key_type = rows.schema["key"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, x in _matrices(batch.column(1)):
                model = models.get(x.shape[1])
                if model is None:
                    continue
                deviation, white = model.project(x)
                flat = pa.array(white.ravel(), pa.float64(), from_pandas=True)
                size = white.shape[1]
                yield pa.RecordBatch.from_pydict({
                    "key": batch.column(0).take(pa.array(own)), "dims": pa.array([x.shape[1]] * len(own), pa.int32()),
                    "deviation": pa.array(deviation, pa.decimal128(38, 0)),
                    "whitened": pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * size, pa.int32()), flat),
                })

    schema = f"key {key_type}, dims int, deviation decimal(38,0), whitened array<double>"
    return rows.select("key", "x").mapInArrow(apply, schema)


def _identity_errors(fit_list: DataFrame, models: dict[int, Whitening]) -> None:
    """Largest entry of the covariance of the whitened fit list minus the identity, by Spark's centred co-moments."""
    size = max((len(m.values) for m in models.values()), default=0)
    pairs = [(a, b) for a in range(size) for b in range(a, size)]
    if not pairs:
        return
    white = project(fit_list.select(F.lit(0).alias("key"), "x"), models).select(
        "dims", *(F.get("whitened", F.lit(a)).alias(f"w{a}") for a in range(size))
    )
    moments = white.groupBy("dims").agg(*(F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs))
    for row in moments.collect():
        alive = [k for k, v in enumerate(models[row.dims].values) if v > 0]
        errors = [abs(row[f"c{a}_{b}"] - (a == b)) for a, b in pairs if a in alive and b in alive]
        models[row.dims].identity_error = max(errors, default=None)


def fit(rows: DataFrame, components: int = 4) -> dict[int, Whitening]:
    """Whitening by vector length, from the distinct vectors of `integers`."""
    scratch = Scratch(rows.sparkSession, "whitening")
    fit_list = scratch.put(rows.select("x").distinct(), "fit")
    products: dict[int, np.ndarray] = {}
    for row in cross_products(fit_list).collect():
        own = products.setdefault(row.dims, np.zeros((row.dims + 1, row.dims + 1), dtype=object))
        own[row.i, row.j] = sum(row[f"l{k}"] << 32 * k for k in range(_LIMBS))
    models = {d: solve(own, components) for d, own in products.items()}
    _identity_errors(fit_list, models)
    scratch.keep_only()
    return models


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", *, scale: int = 256, components: int = 4) -> DataFrame:
    """Every sound row and component: key, component, n, deviation, whitened, explained, identity_error.

    `deviation` is decimal(38,0), null from 10**38 on.
    """
    rows = integers(vectors, key, vector, scale)
    models = fit(rows, components)
    facts = {
        d: F.struct(
            F.lit(m.n).cast("long").alias("n"), F.array(*(F.lit(float(v)) for v in m.explained)).alias("explained"),
            F.lit(m.identity_error).cast("double").alias("identity_error"),
        )
        for d, m in models.items()
    }
    found = project(rows, models)
    if not facts:
        fact = F.lit(None).cast("struct<n:bigint,explained:array<double>,identity_error:double>")
    else:
        fact = F.coalesce(*(F.when(F.col("dims") == d, own) for d, own in facts.items()))
    found = found.withColumn("fact", fact).select("key", "deviation", "fact", F.posexplode("whitened").alias("at", "whitened"))
    return found.select(
        F.col("key").alias(key), (F.col("at") + 1).alias("component"), F.col("fact.n").alias("n"), "deviation", "whitened",
        F.get("fact.explained", F.col("at")).alias("explained"), F.col("fact.identity_error").alias("identity_error"),
    )
