"""Embedding whitening from exact integer statistics.

Entries become integers. Each dimension, shifted by its least value, is sliced into bit
planes, and a plane is packed across rows into 64-bit words. The product of two dimensions
summed over rows is then a weighted sum of population counts of ANDed planes:
sum(x*y) = sum over bits p, q of 2**(p+q) * popcount(plane(x, p) & plane(y, q)). These are
exact, add up over tasks in any order, and are centred as integers: n * sum(x*y) minus
sum(x) * sum(y) is n**2 times the covariance, and shifts cancel out. Only then do floating
point numbers enter, for the eigenvectors.

The driver gets a row per pair of dimensions, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import map_arrow, written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
BLOCK = 1 << 12  # rows whose planes are held at once
SAFE = 1 << 62  # integers below are summed as 64-bit ones, others as Python's
EXACT = pa.decimal128(38, 0)


class Statistics(NamedTuple):
    """Of the fit list: rows, and per dimension the least value, the width in bits and the
    sum of the shifted values; then the sums of their products."""

    n: int
    low: np.ndarray
    bits: np.ndarray
    sums: list[int]
    cross: list[list[int]]


class Components(NamedTuple):
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column each
    trace: float


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, starts in the flat entries, and entries, with length -1 for vectors that
    are null or hold null or non-finite entries."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    missing = column.is_null().to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    return np.where(missing | (bad[ends] > bad[starts]), -1, sizes), starts, flat


def to_integers(entries: np.ndarray) -> np.ndarray:
    scaled = np.floor(entries * SCALE)
    if scaled.size and not np.abs(scaled).max() < SAFE:
        raise ValueError("an entry is too large to become a 64-bit integer")
    return scaled.astype(np.int64) + OFFSET


def integers_of(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the usable vectors of that size, and their integers (rows x size)."""
    sizes, starts, flat = usable(column)
    rows = np.flatnonzero(sizes == size)
    return rows, to_integers(flat[starts[rows][:, None] + np.arange(size)])


def exact_sum(x: np.ndarray) -> list[int]:
    """Column sums."""
    if x.size and int(np.abs(x).max()) * len(x) >= SAFE:
        x = x.astype(object)
    return [int(v) for v in x.sum(axis=0)] if len(x) else [0] * x.shape[1]


def _exact(values: list[int]) -> pa.Array:
    with localcontext() as c:
        c.prec = 38
        return pa.array([Decimal(v) for v in values], EXACT)


def planes_of(x: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(dimension of each plane, planes x words) of shifted values (rows x dimensions). The
    planes of a dimension follow each other, low bits first; missing rows of the last word
    are zeros."""
    rows = -(-len(x) // 64) * 64
    padded = np.zeros((rows, x.shape[1]), dtype=np.int64)
    padded[: len(x)] = x
    packed = []
    for bit in range(int(bits.max(initial=0))):
        plane = ((padded >> bit) & 1).astype(np.uint8)
        packed.append(np.ascontiguousarray(np.packbits(plane, axis=0).T).view(np.uint64))
    dims = np.repeat(np.arange(len(bits)), bits)
    if not packed:
        return dims, np.zeros((0, rows // 64), np.uint64)
    level = np.concatenate([np.arange(b) for b in bits])
    return dims, np.stack(packed)[level, dims]


def scatter(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Sums over rows of products of shifted values (upper triangle), by population counts."""
    size = len(bits)
    wide = 2 * int(bits.max(initial=0)) + len(x).bit_length() >= 62
    out = np.zeros((size, size), dtype=object if wide else np.int64)
    dims, planes = planes_of(x, bits)
    level = np.concatenate([np.arange(b) for b in bits]) if len(bits) else np.zeros(0, np.int64)
    weight = np.array([1 << int(b) for b in level], dtype=object if wide else np.int64)
    first = np.searchsorted(dims, np.arange(size))
    for i in range(size):
        rest = planes[first[i] :]
        for p in range(int(bits[i])):
            counts = np.bitwise_count(planes[first[i] + p] & rest).sum(axis=1, dtype=np.int64)
            np.add.at(out[i], dims[first[i] :], counts * weight[first[i] :] * (1 << p))
    return out


def _first_pass(vectors: DataFrame) -> DataFrame:
    """Per task, vector size and dimension: rows, least, greatest and summed integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray, np.ndarray, list[int]]] = {}
        for batch in batches:
            for size in np.unique(usable(batch.column(0))[0]):
                if size < 0:
                    continue
                _, x = integers_of(batch.column(0), int(size))
                part = len(x), x.min(axis=0), x.max(axis=0), exact_sum(x)
                if size in found:
                    n, low, high, total = found[size]
                    part = n + part[0], np.minimum(low, part[1]), np.maximum(high, part[2]), [a + b for a, b in zip(total, part[3])]
                found[size] = part
        for size, (n, low, high, total) in found.items():
            dims = max(int(size), 1)  # an empty vector has no dimension, yet counts
            low, high, total = (low, high, total) if size else ([0], [0], [0])
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(size)] * dims, pa.int32()), pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), _exact(total)],
                names=["size", "dim", "n", "low", "high", "total"])

    return map_arrow(vectors, run, "size int, dim int, n long, low long, high long, total decimal(38,0)")


def _crosses(vectors: DataFrame, size: int, low: np.ndarray, bits: np.ndarray) -> DataFrame:
    """Per task, the sums of products of shifted values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), dtype=object)
        for batch in batches:
            _, x = integers_of(batch.column(0), size)
            for at in range(0, len(x), BLOCK):
                total = total + scatter(x[at : at + BLOCK] - low, bits)
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _exact([int(v) for v in total[i, j]])], names=["i", "j", "products"])

    return map_arrow(vectors, run, "i int, j int, products decimal(38,0)")


def statistics(vectors: DataFrame) -> Statistics | None:
    """Of the vectors (one column) of the commonest size, the longer of equally common ones."""
    parts = written(_first_pass(vectors), "whitening-sums")
    sizes = parts.where("dim = 0").groupBy("size").agg(F.sum("n").alias("n"))
    most = sizes.agg(F.max(F.struct("n", "size")).alias("m")).first()["m"]
    if most is None or most["size"] == 0:
        return None
    n, size = most["n"], most["size"]
    rows = parts.where(F.col("size") == size).groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total")).orderBy("dim").collect()
    low = np.array([r["low"] for r in rows], dtype=np.int64)
    bits = np.array([(r["high"] - r["low"]).bit_length() for r in rows], dtype=np.int64)
    sums = [int(r["total"]) - n * r["low"] for r in rows]
    cross = [[0] * size for _ in range(size)]
    for r in _crosses(vectors, size, low, bits).groupBy("i", "j").agg(F.sum("products").alias("products")).collect():
        cross[r["i"]][r["j"]] = cross[r["j"]][r["i"]] = int(r["products"])
    return Statistics(n, low, bits, sums, cross)


def components_of(s: Statistics) -> Components:
    """Eigenvalues and unit eigenvectors of the covariance. The integers are centred before
    they are divided; each quotient is rounded once."""
    size = len(s.sums)
    covariance = np.array([[(s.n * s.cross[i][j] - s.sums[i] * s.sums[j]) / s.n**2 for j in range(size)] for i in range(size)])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    return Components(values[order], vectors[:, order], sum(s.n * s.cross[i][i] - s.sums[i] ** 2 for i in range(size)) / s.n**2)


class Projector(NamedTuple):
    """What a task needs to whiten vectors: n, low, sums, and a scaled direction per
    component, of which the first ``rank`` have variance."""

    n: int
    low: np.ndarray
    bits: np.ndarray
    sums: list[int]
    directions: np.ndarray
    rank: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n times the distance from the mean, exact."""
        wide = (self.n << int(self.bits.max())) >= SAFE
        shifted = x - self.low
        if wide:
            return shifted.astype(object) * self.n - np.array(self.sums, dtype=object)
        return shifted * self.n - np.array(self.sums, dtype=np.int64)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(np.float64) / self.n) @ self.directions[:, : self.rank]

    def lengths(self, deviations: np.ndarray) -> list[int | None]:
        """Sums of squares; null where one does not fit a long."""
        bound = int(np.abs(deviations).max()) ** 2 * deviations.shape[1] if len(deviations) else 0
        if bound < SAFE:
            return (deviations * deviations).sum(axis=1).tolist()
        exact = (deviations.astype(object) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def projector(s: Statistics, c: Components, most: int) -> Projector:
    k = min(most, len(s.sums))
    # Below this an eigenvalue is rounding error of a dependent dimension.
    rank = int((c.values[:k] > c.trace * len(s.sums) * 2.0**-52).sum())
    directions = np.zeros((len(s.sums), k))
    directions[:, :rank] = c.vectors[:, :rank] / np.sqrt(c.values[:rank])
    return Projector(s.n, s.low, s.bits, s.sums, directions, rank)


def identity_error(vectors: DataFrame, p: Projector) -> float | None:
    """Largest entry of the covariance of the whitened vectors less the identity, measured
    on all of them. Each task sends its centred products and means, which add up without
    cancelling."""
    if not p.rank:
        return None
    shared = vectors.sparkSession.sparkContext.broadcast(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        i, j = np.triu_indices(q.rank)
        for batch in batches:
            rows, x = integers_of(batch.column(0), len(q.sums))
            if not len(rows):
                continue
            w = q.whitened(q.deviations(x))
            mean = w.mean(axis=0)
            apart = w - mean
            about = apart.T @ apart + len(w) * np.outer(mean, mean)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(about[i, j]), pa.array(mean[i] * len(w)), pa.array(mean[j] * len(w))],
                                             names=["i", "j", "products", "sum_i", "sum_j"])

    parts = map_arrow(vectors, run, "i int, j int, products double, sum_i double, sum_j double")
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("products", "sum_i", "sum_j")])
    covariance = F.col("products") / p.n - F.col("sum_i") / p.n * F.col("sum_j") / p.n
    off = F.abs(covariance - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return sums.agg(F.max(off).alias("e")).first()["e"]


def whiten(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: ``vec_id``, ``component`` (from 1, by falling
    variance, at most ``most``), ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``.

    Vectors that are null or hold null or non-finite entries are left out; if sizes differ,
    so are those not of the commonest size (of equally common ones, the greatest). Entries c
    count as floor(64 c) + 1000000; one beyond 64 bits is an error. ``deviation`` is null where it does not fit a long,
    ``whitened`` for components without variance (dependent dimensions, equal vectors), whose ``explained`` is 0, and
    ``identity_error`` if there are no others. Equal eigenvalues are numbered as the solver gives them, the same
    for all rows. Repeated rows and null ids count and come back as often as given, other
    columns are not read, whatever their names. A table without usable vectors gives an empty result.
    """
    vectors = table.select(F.col(vector_column))
    kind = table.schema[id_column].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = statistics(vectors)
    if found is None:
        return table.sparkSession.createDataFrame([], schema)
    parts = components_of(found)
    p = projector(found, parts, most)
    k = p.directions.shape[1]
    explained = np.zeros(k)
    explained[: p.rank] = parts.values[: p.rank] / parts.trace if p.rank else 0.0
    error = identity_error(vectors, p)
    shared = table.sparkSession.sparkContext.broadcast(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            rows, x = integers_of(batch.column(1), len(q.sums))
            for at in range(0, len(rows), BLOCK):
                part = rows[at : at + BLOCK]
                deviations = q.deviations(x[at : at + BLOCK])
                white = np.full((len(part), k), np.nan)
                white[:, : q.rank] = q.whitened(deviations)
                lengths = pa.array(q.lengths(deviations), pa.int64())
                each = pa.array(np.repeat(np.arange(len(part)), k))
                flat = white.ravel()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(part, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))), pa.array(np.full(len(flat), q.n)),
                     lengths.take(each), pa.array(flat, mask=np.isnan(flat)), pa.array(np.tile(explained, len(part))),
                     pa.array([error] * len(flat), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(table.select(id_column, vector_column), run, schema)
