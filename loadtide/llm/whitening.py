"""Whitened embeddings: exact cross-products from bit planes, integer centring, eigenvectors of the covariance.

1. An entry c becomes the whole number x = floor(1024 c) + 100000. One pass gives the number of vectors and each
   dimension's least, greatest and sum of x.
2. In every task, blocks of rows are cut into bit planes: bit a of dimension i (less its least value) of 64 rows is one
   word. popcount(plane (i, a) AND plane (j, b)), weighted by 2^(a + b), summed over bits, is the exact sum of products
   of dimensions i and j. Tasks hand on one number per pair of dimensions; Spark adds them up.
3. n * (sum of products) - (sum) * (sum) centres them as whole numbers of any length before the first rounding; the
   eigenvectors of that matrix over n^2 are computed on the driver. It is dimensions squared in size, whatever the rows.
4. Rows are projected in a last pass, from n * x - S, which is exact too.

Cross-products are whole numbers of any length: beyond 2^60 they travel in limbs, so neither many rows nor wide values overflow.

Null vectors, vectors with a null or non-finite entry, and empty vectors are dropped. So are vectors of another length than
most have (ties: the longer), and entries beyond 2^52 / 1024, which have no exact x. Very long vectors cost dimensions squared
per task, so a model's embeddings, not a sparse vocabulary, belong here. Null and repeated ids are rows like others, repeated
vectors count each time. Components with no variance (all vectors alike, or fewer vectors than dimensions) give 0.0 and have
no part in `identity_error`. A `deviation` beyond 64 bits is null. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import claim, query, ship, stored, table

SCALE, SHIFT = 1024, 100_000
LIMB = 60
CELLS = 1 << 25  # bits times rows of one block


def whole(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): the vectors as whole numbers, without those that have no such form."""
    v = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(
        (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= float(1 << 52) / SCALE)))  # a NaN is above all numbers
    most = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return v.filter(F.size("v") == (most.d if most else 0)).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * float(SCALE)) + SHIFT).alias("x"))


def _blocks(batches, dims: int, rows: int | None = None):
    """Arrays (rows, dims) of whole numbers."""
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        for at in range(0, len(x), rows or max(1, len(x))):
            yield x[at:at + rows] if rows else x


def ranges(x: DataFrame) -> tuple[int, list[int], list[int], list[int]]:
    """Rows, and each dimension's least value, greatest value and sum."""
    def run(batches):
        import pyarrow as pa

        n, low, high, total = 0, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            a, b, s = v.min(axis=0), v.max(axis=0), [int(p) + (int(q) << 20) for p, q in zip(
                (v & 0xFFFFF).sum(axis=0), (v >> 20).sum(axis=0))]
            low, high, total = (a, b, s) if n == 0 else (np.minimum(low, a), np.maximum(high, b), [p + q for p, q in zip(total, s)])
            n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(low)), pa.int32()), pa.array([n] * len(low), pa.int64()), pa.array(low), pa.array(high),
                                              pa.array(map(str, total), pa.string())], names=["d", "n", "low", "high", "total"])

    found = (x.select("x").mapInArrow(run, "d int, n long, low long, high long, total string").groupBy("d")
             .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
                  F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("d").collect())
    return (found[0].n if found else 0), [r.low for r in found], [r.high for r in found], [int(r.total) for r in found]


def scatter(block: np.ndarray, low: np.ndarray, bits: list[int]) -> np.ndarray:
    """Sums of products of the dimensions of one block, less their least values: upper triangle, by bit planes."""
    dims, starts = len(bits), np.cumsum([0, *bits])
    values = np.zeros((dims, -(-len(block) // 64) * 64), np.uint64)
    values[:, :len(block)] = (block - low).astype(np.uint64).T
    planes = np.empty((starts[-1], values.shape[1] // 64), np.uint64)
    for i, b in enumerate(bits):
        bit = (values[i] >> np.arange(b, dtype=np.uint64)[:, None]) & np.uint64(1)
        planes[starts[i]:starts[i + 1]] = np.packbits(bit.astype(np.uint8), axis=1).view(np.uint64)
    wide = max(bits, default=0) * 2 + len(block).bit_length() > 62
    weight = np.array([1 << a for b in bits for a in range(b)], object if wide else np.int64)
    out = np.zeros((dims, dims), weight.dtype)
    live = [i for i in range(dims) if bits[i]]
    for i in live:
        later = [j for j in live if j >= i]
        for a in range(bits[i]):
            k = starts[i] + a
            common = np.bitwise_count(planes[k] & planes[starts[i]:]).sum(axis=1, dtype=np.int64)
            out[i, later] += np.add.reduceat(common.astype(weight.dtype) * weight[starts[i]:], starts[later] - starts[i]) * weight[k]
    return out


def cross_products(x: DataFrame, low: list[int], high: list[int]) -> list[list[int]]:
    """Exact sums of (x_i - low_i)(x_j - low_j) over all rows."""
    dims, bits = len(low), [(b - a).bit_length() for a, b in zip(low, high)]
    rows = max(64, min(8192, CELLS // max(1, sum(bits))) // 64 * 64)

    def run(batches):
        import pyarrow as pa

        claim("whitening")
        total, short, room = np.zeros((dims, dims), object), None, 0
        for block in _blocks(batches, dims, rows):
            part = scatter(block, np.array(low, np.int64), bits)
            if part.dtype == object:
                total += part
                continue
            if room == 0:  # sums of so many blocks still fit in 64 bits
                total, short = total if short is None else total + short, np.zeros((dims, dims), np.int64)
                room = 1 << max(0, 62 - 2 * max(bits, default=0) - rows.bit_length())
            short += part
            room -= 1
        total = total if short is None else total + short
        out = []
        for i, j in zip(*np.triu_indices(dims)):
            value, limb = int(total[i, j]), 0
            while value or limb == 0:
                out.append((int(i), int(j), limb, value & ((1 << LIMB) - 1)))
                value, limb = value >> LIMB, limb + 1
        for at in range(0, len(out), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at:at + 100_000]), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                             names=["i", "j", "limb", "value"])

    sums = (x.select("x").mapInArrow(run, "i int, j int, limb int, value long").groupBy("i", "j", "limb")
            .agg(F.sum(F.col("value").cast("decimal(19,0)")).alias("value")))
    out = [[0] * dims for _ in range(dims)]
    for r in sums.toLocalIterator():
        out[r.i][r.j] += int(r.value) << (LIMB * r.limb)
    return [[out[min(i, j)][max(i, j)] for j in range(dims)] for i in range(dims)]


def components(n: int, sums: list[int], products: list[list[int]], count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, their shares of the variance, and unit eigenvectors (columns), the largest first."""
    dims = len(sums)
    cov = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(dims)] for i in range(dims)], np.float64)
    values, vectors = np.linalg.eigh(cov)
    first = np.argsort(values, kind="stable")[::-1][:count]
    trace = sum(n * products[i][i] - sums[i] * sums[i] for i in range(dims)) / (n * n)
    values = np.where(values[first] > 1e-12 * max(trace, 0.0), values[first], 0.0)
    return values, values / trace if trace else values * 0.0, vectors[:, first]


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", count: int = 8) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    ship(df.sparkSession)
    x = whole(df, vec_id, vector)
    n, low, high, sums = ranges(x)
    shape = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double".format(
        x.schema["vec_id"].dataType.simpleString())
    if n == 0:
        return x.sparkSession.createDataFrame([], shape)
    values, shares, vectors = components(n, [s - n * a for s, a in zip(sums, low)], cross_products(x, low, high), count)
    scaled = vectors / np.sqrt(np.where(values > 0, values, np.inf))
    dims, used = len(low), len(values)
    reach = [n * max(b, -a, b - a) for a, b in zip(low, high)]
    exact = max(reach) + max(map(abs, sums)) < 1 << 62
    small = sum(r * r for r in (n * (b - a) for a, b in zip(low, high))) < 1 << 62

    def run(batches):
        import pyarrow as pa

        claim("whitening")
        for batch in batches:
            v = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            off = v * n - np.array(sums, np.int64) if exact else v.astype(object) * n - np.array(sums, object)
            squares = (off if small else off.astype(object)) ** 2
            deviation = [s if s < 1 << 63 else None for s in map(int, squares.sum(axis=1))]
            w = (off / n).astype(np.float64) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviation, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * used, pa.int32()), pa.array(w.ravel()))], names=["vec_id", "deviation", "w"])

    done = stored(x.mapInArrow(run, f"vec_id {x.schema['vec_id'].dataType.simpleString()}, deviation long, w array<double>"), "whitened")
    live = [k for k in range(used) if values[k] > 0]
    pairs = [F.abs(F.covar_pop(F.col("w")[a], F.col("w")[b]) - float(a == b)) for a in live for b in live if a <= b]
    error = float(done.agg(F.greatest(*pairs, F.lit(0.0)).alias("error")).first().error) if live else 0.0
    share = F.array(*[F.lit(float(s)) for s in shares])
    return (done.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
            .select("vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(share, "k").alias("explained"), F.lit(error).alias("identity_error")))


@query("op12_whitening")
def whitening(spark, sf_dir):
    """All embeddings on their eight first components, whitened."""
    return whiten(table(spark, sf_dir, "embeddings"))
