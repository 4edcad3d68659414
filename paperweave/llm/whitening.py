"""Whitening of embeddings by bit-sliced scatter: exact covariance from AND-popcounts, then eigh.

An entry c becomes the integer x = floor(64 c) + 1000000. Shifted by its dimension's least value,
it is a small number of bits; bit a of dimension d over many rows is a bit plane, packed 64 rows to
a word. The cross-product of two dimensions is the sum over their planes of 2^(a+b) times the
popcount of the AND of plane a and plane b: whole numbers, exact in any order, so partitions, reruns and lost
tasks cannot change them. Every task emits one sum per pair of dimensions, Spark adds them as
decimals, and the driver gets dimensions^2 / 2 of them (at most MAX_DIMENSIONS^2 / 2, whatever the number of
rows). They are centred as integers, n * sum(xy) - sum(x) sum(y), and divided once, which
rounds each covariance once, before eigh. A last pass projects the rows.

Defined results
* rows whose vector is null, or holds a null, NaN or infinite entry, are dropped; so are empty vectors and
  vectors of another length than most rows have (the longer length on ties).
* repeated rows and identifiers: every row counts and gets its own result rows; null identifiers are kept.
* components: unit eigenvectors with eigenvalue above LEAST_SHARE of the largest, 32 at most; so fewer
  where the rows span fewer dimensions, and none for a single row, equal rows or an empty table (empty result).
* an eigenvector's sign is that which makes its entry of greatest magnitude positive.
* entries whose x spans more than 2^62, or sums that pass 38 digits, raise ArithmeticError, and so does a deviation that is no long.
* other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import workers_import

# fixed values: the integer grid and the number of components
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32

BLOCK_ROWS = 1 << 16  # rows whose bit planes a task holds at a time
MAX_DIMENSIONS = 2048  # the driver holds their covariance
LEAST_SHARE = 1e-11  # of the greatest eigenvalue; what lies below is rounding of a rank-deficient matrix
FINE = 2.0**40  # steps of one, in which sums of whitened products are added

_DECIMAL = pa.decimal128(38, 0)
_MOST = 10**38


@dataclass(frozen=True)
class Whitening:
    """``n`` rows, exact sums of x, unit ``axes`` (dimension x component), their eigenvalues, trace of the covariance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float


def clean_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): the rows that remain, as doubles."""
    doubles = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = doubles.filter(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    usual = sizes.orderBy(F.desc("rows"), F.desc("d")).first()
    return rows.filter(F.size("v") == (usual["d"] if usual else 0))


def grid(column: pa.Array, dimensions: int) -> np.ndarray:
    """x of a list column: one row per vector, int64."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * flat).astype(np.int64) + SHIFT).reshape(-1, dimensions)


def _spans(rows: DataFrame) -> list[tuple[int, int]]:
    """Least and greatest x of every dimension."""
    entries = rows.select(F.posexplode("v").alias("d", "c"))
    ends = entries.groupBy("d").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).orderBy("d").collect()
    spans = [(int(np.floor(SCALE * r["lo"])) + SHIFT, int(np.floor(SCALE * r["hi"])) + SHIFT) for r in ends]
    if any(max(abs(lo), abs(hi)) >= 1 << 62 for lo, hi in spans):
        raise ArithmeticError("an entry is too large for the integer grid")
    return spans


def bit_planes(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """All planes of the shifted integers, 64 rows to a word: plane (d, a) follows those of earlier dimensions."""
    padded = np.zeros((-(-len(y) // 64) * 64, y.shape[1]), np.int64)
    padded[:len(y)] = y
    planes = [np.packbits(((padded[:, d] >> a) & 1).astype(np.uint8)).view(np.uint64) for d, b in enumerate(bits) for a in range(b)]
    return np.array(planes, np.uint64).reshape(len(planes), len(padded) // 64)


def popcounts(planes: np.ndarray) -> np.ndarray:
    """Rows set in both planes, for every pair of planes (upper triangle)."""
    out = np.zeros((len(planes), len(planes)), np.int64)
    for i, plane in enumerate(planes):
        out[i, i:] = np.bitwise_count(planes[i:] & plane).sum(axis=1, dtype=np.int64)
    return out


def cross_products(counts: np.ndarray, bits: list[int]) -> tuple[list[int], list[list[int]]]:
    """Sums and cross-products (upper triangle) of the dimensions, as whole numbers, from the planes' counts."""
    first = np.concatenate([[0], np.cumsum(bits)]).astype(int)
    full = np.triu(counts) + np.triu(counts, 1).T
    sums = [sum(int(full[first[d] + a, first[d] + a]) << a for a in range(b)) for d, b in enumerate(bits)]
    # columns of one dimension weighted first: a (planes x dimensions) table of whole numbers
    half = [[sum(int(c) << a for a, c in enumerate(row[first[e]:first[e + 1]])) for e in range(len(bits))] for row in full]
    return sums, [[sum(half[first[d] + a][e] << a for a in range(bits[d])) for e in range(d, len(bits))] for d in range(len(bits))]


def _scatter(rows: DataFrame, spans: list[tuple[int, int]]) -> tuple[int, list[int], list[list[int]]]:
    """n, sums and cross-products (upper triangle) of the shifted integers over all rows."""
    lows = np.array([lo for lo, _ in spans], np.int64)
    bits = [(hi - lo).bit_length() for lo, hi in spans]
    size = len(spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, counts = 0, np.zeros((sum(bits), sum(bits)), np.int64)
        waiting: list[np.ndarray] = []

        def counted() -> np.ndarray:
            y = np.concatenate(waiting) - lows
            waiting.clear()
            return popcounts(bit_planes(y, bits))

        for batch in batches:
            if batch.num_rows:
                waiting.append(grid(batch.column(0), size))
                n += batch.num_rows
                if sum(map(len, waiting)) >= BLOCK_ROWS:
                    counts += counted()
        if waiting:
            counts += counted()
        sums, products = cross_products(counts, bits)
        cells = [(-1, -1, n), *((d, -1, s) for d, s in enumerate(sums))]
        cells += [(d, d + k, p) for d, row in enumerate(products) for k, p in enumerate(row)]
        yield pa.RecordBatch.from_arrays([
            pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
            pa.array([decimal.Decimal(c[2]) for c in cells], _DECIMAL)], ["i", "j", "total"])

    parts = rows.select("v").mapInArrow(run, "i int, j int, total decimal(38,0)")
    totals = {(r["i"], r["j"]): int(r["total"]) for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    return totals[-1, -1], [totals[d, -1] for d in range(size)], [[totals[d, e] for e in range(d, size)] for d in range(size)]


def fit(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all remaining rows; None without rows."""
    rows = clean_vectors(workers_import(vectors), key, vector)
    spans = _spans(rows)
    if not spans:
        return None
    if len(spans) > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {len(spans)} dimensions; {MAX_DIMENSIONS} at most")
    widest = max(hi - lo for lo, hi in spans)
    if rows.count() * max(widest, 1) ** 2 >= _MOST:
        raise ArithmeticError("cross-products would pass 38 digits")
    n, sums, products = _scatter(rows, spans)
    size = len(spans)
    covariance = np.zeros((size, size))
    trace = 0
    for d in range(size):
        for e in range(d, size):
            centred = n * products[d][e - d] - sums[d] * sums[e]
            covariance[d, e] = covariance[e, d] = centred / n**2  # one rounding
            trace += centred if d == e else 0
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, int((values > max(values[0], 0) * LEAST_SHARE).sum())) if values[0] > 0 else 0
    axes = axes[:, :kept] * np.where(np.take_along_axis(axes[:, :kept], np.abs(axes[:, :kept]).argmax(axis=0)[None, :], 0) < 0, -1.0, 1.0)
    return Whitening(n, [s + n * lo for s, (lo, _) in zip(sums, spans)], axes, values[:kept], trace / n**2)


def project(vectors: DataFrame, model: Whitening, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, deviation, whitened array) of every remaining row."""
    rows = clean_vectors(workers_import(vectors), key, vector)
    n, size = model.n, len(model.sums)
    sums = np.array(model.sums, object)
    scaled = model.axes / np.sqrt(model.values)
    fields = ["id", "deviation", "z"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = grid(batch.column(1), size)
            most = max(abs(n * int(v) - s) for end in (x.min(axis=0), x.max(axis=0)) for v, s in zip(end, model.sums))
            if n * int(np.abs(x).max()) < 2**62 and size * most**2 < 2**63:
                centred = n * x - np.array(model.sums, np.int64)
                deviation = (centred * centred).sum(axis=1).tolist()
            else:  # whole numbers of any length
                centred = n * x.astype(object) - sums
                deviation = [sum(v * v for v in row) for row in centred]
                if max(deviation) >= 2**63:
                    raise ArithmeticError("a deviation is too large for a long")
            z = (centred / n).astype(np.float64) @ scaled
            offsets = np.arange(0, z.size + 1, z.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(offsets, z.ravel())], fields)

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, deviation long, z array<double>")


def identity_error(projected: DataFrame, components: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity. The rows are centred
    before they are multiplied; tasks add in steps of 2^-40, so that the order of the sums is immaterial."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, gram = 0, np.zeros(components), np.zeros((components, components))
        for batch in batches:
            z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            n, total, gram = n + len(z), total + z.sum(axis=0), gram + z.T @ z
        cells = [(-1, -1, float(n)), *((a, -1, s) for a, s in enumerate(total))]
        cells += [(a, b, gram[a, b]) for a in range(components) for b in range(a, components)]
        yield pa.RecordBatch.from_arrays([
            pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
            pa.array([decimal.Decimal(round(c[2] * FINE)) for c in cells], _DECIMAL)], ["a", "b", "total"])

    parts = projected.select("z").mapInArrow(run, "a int, b int, total decimal(38,0)")
    cells = {(r["a"], r["b"]): int(r["total"]) / FINE for r in parts.groupBy("a", "b").agg(F.sum("total").alias("total")).collect()}
    n = cells[-1, -1]
    mean = [cells[a, -1] / n for a in range(components)]
    return max(abs(cells[a, b] / n - mean[a] * mean[b] - (a == b)) for a in range(components) for b in range(a, components))


def whiten(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: key, component, n, deviation, whitened, explained, identity_error."""
    kind = dict(vectors.dtypes)[key]
    model = fit(vectors, key=key, vector=vector, components=components)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame(
            [], f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    projected = stage(project(vectors, model, key=key, vector=vector), "whitened")
    error = identity_error(projected, len(model.values))
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return projected.select("id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        F.col("id").alias(key), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
