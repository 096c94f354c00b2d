"""Whitening of embeddings from an exact covariance, by bit-sliced scatter.

Each entry c becomes the long floor(64 * c) + 1000000. A first pass finds the number of
vectors and each dimension's sum, least and greatest value. Less its least value, a dimension
has few bits: in a second pass tasks pack bit plane by bit plane of every dimension across
rows into 64-bit words, and the cross-product of two dimensions is the sum over their planes
of 2^(i+j) times the count of common bits. Counts of equal weight are held in limbs, so sums
are exact whatever the size of the table. Only sums of the dimensions' pairs reach the
driver, which grow with the dimension, not the rows; there they are centred as integers
(n * products - sum * sum) before the eigenvectors are taken. A third pass projects the rows.

Defined cases: a vector that is null, or holds a null or non-finite entry or one beyond 2^34
in size, is left out; so is one of another length than the commonest (ties: the longest), as
no covariance joins them, and an empty one. Null ids are kept, repeated rows count each. A component
without variance (e is zero up to rounding) has null in ``whitened`` and no part in
``identity_error``, which is null where no component varies; ``explained`` is null if nothing
varies. ``deviation`` is null where it doesn't fit a long. An empty table gives an empty
result. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import python_batches

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: entries up to here become longs that a sum over any table can hold
GREATEST = 2.0**34
#: rows whose planes are packed together; a multiple of 64
CHUNK_ROWS = 1 << 14
#: bits of weight in a limb: a limb's sum over 10^11 rows still fits a long
LIMB_BITS = 20
LONG_MAX = 2**63 - 1

RESULT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and the vector in doubles, for vectors of usable entries only."""
    vector = F.col("embedding").cast("array<double>")
    good = F.forall(vector, lambda c: F.coalesce((c <= GREATEST) & (c >= -GREATEST), F.lit(False)))
    return embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector")).filter(
        good & (F.size(vector) > 0))


def quantised(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors).astype(np.int64) + OFFSET


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The quantised vectors of a batch, one per row."""
    return quantised(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension))


def dimension_figures(vectors: DataFrame) -> tuple[int, list[int], list[int], list[int]] | None:
    """Count, sums, least and greatest values of the vectors of the commonest length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            column = batch.column("vector")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                x = matrix(column.filter(pa.array(sizes == size)), size)
                own = [len(x), x.sum(0).astype(object), x.min(0), x.max(0)]
                if size in found:
                    n, total, low, high = found[size]
                    own = [n + own[0], total + own[1], np.minimum(low, own[2]), np.maximum(high, own[3])]
                found[size] = own
        for size, (n, total, low, high) in found.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                pa.array(total.tolist(), pa.decimal128(38, 0)), pa.array(low, pa.int64()), pa.array(high, pa.int64()),
            ], names=["size", "at", "n", "total", "low", "high"])

    figures = vectors.select("vector").mapInArrow(
        run, "size int, at int, n bigint, total decimal(38,0), low bigint, high bigint")
    best = (figures.groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"),
                                              F.min("low").alias("low"), F.max("high").alias("high"))
            .groupBy("size").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "total", "low", "high"))).alias("own"))
            .orderBy(F.desc("n"), F.desc("size")).limit(1).collect())
    if not best:
        return None
    own = best[0].own
    return best[0].n, [int(r.total) for r in own], [r.low for r in own], [r.high for r in own]


class Planes:
    """Which dimension and which bit each plane holds, and the sums of common bits by limb."""

    def __init__(self, low: np.ndarray, bits: list[int]):
        self.low = low
        self.dimension = np.repeat(np.arange(len(bits)), bits)
        self.bit = np.concatenate([np.arange(b) for b in bits]).astype(np.int64)
        self.begin = np.concatenate([[0], np.cumsum(bits)])
        limbs = max(2 * max(bits) - 2, 0) // LIMB_BITS + 1
        self.sums = np.zeros((limbs, len(bits), len(bits)), np.int64)

    def add(self, x: np.ndarray) -> None:
        """Pack the rows of ``x`` and count the common bits of all planes, of a dimension and those after it."""
        shifted = np.zeros((len(self.low), -(-len(x) // 64) * 64), np.int64)
        shifted[:, :len(x)] = (x - self.low).T
        words = np.packbits((shifted[self.dimension] >> self.bit[:, None]).astype(np.uint8) & 1, axis=1).view(np.uint64)
        for plane, (d, i) in enumerate(zip(self.dimension, self.bit, strict=True)):
            after = self.begin[d]
            common = np.bitwise_count(words[plane] & words[after:]).sum(1, dtype=np.int64)
            weight = self.bit[after:] + i
            np.add.at(self.sums, (weight // LIMB_BITS, d, self.dimension[after:]), common << (weight % LIMB_BITS))


def cross_products(vectors: DataFrame, low: list[int], high: list[int]) -> list[list[int]]:
    """Exact sums of the products of every two dimensions, each less its least value."""
    dimension, bits = len(low), [(b - a).bit_length() for a, b in zip(low, high, strict=True)]
    least = np.array(low, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, held, rows = Planes(least, bits), [], 0
        for batch in batches:
            x = matrix(batch.column("vector"), dimension)
            held.append(x)
            rows += len(x)
            if rows >= CHUNK_ROWS:
                planes.add(np.concatenate(held))
                held, rows = [], 0
        if rows:
            planes.add(np.concatenate(held))
        limb, a, b = np.nonzero(planes.sums)
        yield pa.RecordBatch.from_arrays([pa.array(limb, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                                          pa.array(planes.sums[limb, a, b], pa.int64())], names=["limb", "a", "b", "total"])

    out = [[0] * dimension for _ in range(dimension)]
    found = vectors.select("vector").mapInArrow(run, "limb int, a int, b int, total bigint")
    for r in found.groupBy("limb", "a", "b").agg(F.sum("total").alias("total")).collect():
        part = r.total << (LIMB_BITS * r.limb)
        out[r.a][r.b] += part
        if r.a != r.b:
            out[r.b][r.a] += part
    return out


def covariance(n: int, sums: list[int], low: list[int], products: list[list[int]]) -> np.ndarray:
    """The covariance, divisor n: integers until the one division."""
    shifted = [s - n * a for s, a in zip(sums, low, strict=True)]
    return np.array([[(n * p - s * t) / (n * n) for p, t in zip(row, shifted, strict=True)]
                     for row, s in zip(products, shifted, strict=True)])


def components_of(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float | None]:
    """Projection (a column per component, divided by the root of its eigenvalue), which vary, share explained, identity error."""
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    # either sign is right; the largest entry is made positive, so that reruns agree
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(0)[None], 0)[0] < 0, -1.0, 1.0)
    varies = values > max(values[0], 0) * len(v) * np.finfo(float).eps
    projection = vectors / np.sqrt(np.where(varies, values, 1.0))
    trace = float(np.trace(v))
    explained = np.maximum(values, 0) / trace if trace > 0 else np.full(len(values), np.nan)
    seen = projection[:, varies]
    error = float(np.abs(seen.T @ v @ seen - np.eye(seen.shape[1])).max()) if varies.any() else None
    return projection, varies, explained, error


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per vector and component: n, the vector's exact deviation, its whitened value, the share explained and the identity error."""
    spark = embeddings.sparkSession
    python_batches(spark)
    vectors = usable(embeddings)
    figures = dimension_figures(vectors)
    if figures is None:
        return spark.createDataFrame([], RESULT)
    n, sums, low, high = figures
    dimension = len(sums)
    vectors = vectors.filter(F.size("vector") == dimension)
    projection, varies, explained, error = components_of(covariance(n, sums, low, cross_products(vectors, low, high)), components)
    count = projection.shape[1]
    # n * x - S stays within these bounds; where a long can't hold the squares, whole numbers of any size do
    widest = max(n * (b - a) for a, b in zip(low, high, strict=True))
    kind = np.int64 if max(dimension * widest * widest, n * max(map(abs, low + high)), *map(abs, sums)) <= LONG_MAX else object
    total = np.array(sums, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = n * matrix(batch.column("vector"), dimension).astype(kind) - total
            deviation = [d if d <= LONG_MAX else None for d in (centred * centred).sum(1).tolist()]
            whitened = (centred.astype(float) / n) @ projection
            rows = len(whitened)
            whitened[:, ~varies] = np.nan
            tiled = lambda column: np.tile(column, rows)
            each = pa.array(np.repeat(np.arange(rows), count))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(each), pa.array(tiled(np.arange(1, count + 1, dtype=np.int32))),
                pa.array([n] * rows * count, pa.int64()), pa.array(deviation, pa.int64()).take(each),
                pa.array(whitened.ravel(), pa.float64(), from_pandas=True), pa.array(tiled(explained), pa.float64(), from_pandas=True),
                pa.array([error] * rows * count, pa.float64()),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, RESULT)
