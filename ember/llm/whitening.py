"""Operator 13: embedding whitening from exact, bit-sliced cross-products.

Components become integers x = floor(``scale`` * c) + ``offset``.

1. *Ranges.*  Tasks give count, sum, least and greatest x of every dimension;
   the sums are exact.
2. *Bit-sliced scatter.*  Every dimension is shifted by its least value, so its
   values are small and not negative.  Their bit planes are packed across 64
   rows into a word; the cross-product of two dimensions is the sum over pairs
   of planes of 2^(i + j) times the number of set bits in the AND of the two.
   Tasks add these counts up per weight and give one row a dimension pair and
   32-bit limb of the weight; Spark adds them as decimals, so no sum overflows.
3. *Centring.*  n * P - S S' is formed from whole numbers; the shift cancels.
   Only its quotient by n^2, the covariance, is rounded, and goes to ``eigh``.
4. *Projection.*  Rows are centred and projected on the leading components in a
   second look at the vectors; the whitened covariance is then measured over
   all rows, centred by its own means first.

The driver holds dimensions x dimensions numbers, never rows.

Defined cases: rows whose vector is null or holds null or non-finite entries
are dropped, as are those with an entry beyond 2^52 / ``scale``, which no double
holds to the last unit; null ids and repeated rows are kept as rows of their
own; a shorter vector is read as if zeros followed; components without variance
(all of them for one row) have ``whitened`` null and are left out of
``identity_error``, which is null where no component is left; ``deviation``
beyond 64 bits is null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ember.llm.staging import staged
from ember.session import ship_package

LIMB = 32                      # bits of a weight added up together
ROWS_AT_ONCE = 1 << 12         # rows whose bit planes are held at once
_EXACT = "decimal(38,0)"


def finite_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, vec (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= float((1 << 52) // scale)))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vec")).filter(v.isNotNull() & usable)


def whole_numbers(column: pa.Array, dims: int | None, scale: int, offset: int) -> np.ndarray:
    """x of every row (rows x dims); entries behind a vector's end count as zero components."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(column.offsets.to_numpy())
    dims = dims if dims is not None else (int(size.max()) if len(size) else 0)
    if len(size) and (size == dims).all():
        c = flat.reshape(len(size), dims)
    else:
        c = np.zeros((len(size), dims))
        row = np.repeat(np.arange(len(size)), size)
        c[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return np.floor(scale * c).astype(np.int64) + offset


def _pieces(batch: pa.RecordBatch):
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(at, ROWS_AT_ONCE)


def _ranges(scale: int, offset: int):
    def run(batches):
        rows, n, total, low, high = 0, [], [], [], []
        for batch in batches:
            for part in _pieces(batch):
                x = whole_numbers(part.column("vec"), None, scale, offset)
                size = np.diff(part.column("vec").offsets.to_numpy())
                rows += len(x)
                for d in range(x.shape[1]):
                    mine = x[size > d, d]
                    if d == len(n):
                        for held, start in ((n, 0), (total, 0), (low, int(mine[0])), (high, int(mine[0]))):
                            held.append(start)
                    n[d] += len(mine)
                    total[d] += int((mine >> LIMB).sum()) * (1 << LIMB) + int((mine & ((1 << LIMB) - 1)).sum())
                    low[d], high[d] = min(low[d], int(mine.min())), max(high[d], int(mine.max()))
        if rows:
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([-1, *range(len(n))], pa.int32()), "n": pa.array([rows, *n], pa.int64()),
                "total": pa.array([Decimal(0), *map(Decimal, total)], pa.decimal128(38, 0)),
                "low": pa.array([0, *low], pa.int64()), "high": pa.array([0, *high], pa.int64())})

    return run


def bit_planes(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes of the columns of ``x`` (all >= 0): one row a plane, dimension by dimension, 64 values a word."""
    rows, dims = x.shape
    words = -(-rows // 64)
    column = np.repeat(np.arange(dims), bits)
    bit = np.arange(len(column)) - np.repeat(np.cumsum(bits) - bits, bits)
    padded = np.zeros((len(column), words * 64), bool)
    padded[:, :rows] = (x.T[column] >> bit[:, None]) & 1
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def _scatter(scale: int, offset: int, low: np.ndarray, bits: np.ndarray):
    dims = len(low)
    column = np.repeat(np.arange(dims), bits)
    bit = np.arange(len(column)) - np.repeat(np.cumsum(bits) - bits, bits)
    limbs = int(2 * bits.max() - 2) // LIMB + 1 if bits.max() else 0
    dim_start = np.cumsum(bits) - bits
    alive = np.flatnonzero(bits)

    def run(batches):
        total = np.zeros((limbs, dims, dims), object)
        partial, held = np.zeros((limbs, dims, dims), np.int64), 0
        for batch in batches:
            for part in _pieces(batch):
                x = whole_numbers(part.column("vec"), dims, scale, offset) - low
                planes = bit_planes(x, bits)
                for p in range(len(column)):
                    d, start = column[p], dim_start[column[p]]
                    common = np.bitwise_count(planes[start:] & planes[p]).sum(axis=1, dtype=np.int64)
                    weight = bit[p] + bit[start:]
                    for limb in range(limbs):
                        inside = weight // LIMB == limb
                        if inside.any():
                            worth = np.where(inside, common << np.where(inside, weight % LIMB, 0), 0)
                            partial[limb, d, alive[alive >= d]] += np.add.reduceat(worth, dim_start[alive[alive >= d]] - start)
                held += len(x)
                if held * int(bits.max()) >= 1 << 28:                  # entries stay below held * bits * 2^33
                    total, partial, held = total + partial, np.zeros_like(partial), 0
        total = total + partial
        limb, one, two = np.nonzero(total)
        if len(limb):
            yield pa.RecordBatch.from_pydict({
                "one": pa.array(one, pa.int32()), "two": pa.array(two, pa.int32()), "limb": pa.array(limb, pa.int32()),
                "common": pa.array([Decimal(int(total[k])) for k in zip(limb, one, two)], pa.decimal128(38, 0))})

    return run


class Whitening:
    """Means and leading components of a fitted table, from whole numbers."""

    def __init__(self, n: int, sums: list[int], products: dict[tuple[int, int], int], lows: list[int], components: int):
        dims = len(sums)
        self.n, self.sums = n, sums
        shifted = [s - n * m for s, m in zip(sums, lows)]
        cov = np.zeros((dims, dims))
        for d in range(dims):
            for e in range(d, dims):
                cov[d, e] = cov[e, d] = (n * products.get((d, e), 0) - shifted[d] * shifted[e]) / (n * n)
        values, columns = np.linalg.eigh(cov)
        keep = np.arange(dims - 1, max(dims - 1 - components, -1), -1)
        self.values, self.axes = values[keep], columns[:, keep]
        trace = float(np.trace(cov))
        self.live = self.values > max(trace, 0.0) * dims * np.finfo(float).eps
        self.explained = self.values / trace if trace > 0 else np.full(len(keep), np.nan)


def fit(rows: DataFrame, scale: int, offset: int, components: int) -> Whitening | None:
    """The whitening of ``rows(vec_id, vec)``; None without rows."""
    stats = rows.select("vec").mapInArrow(
        _ranges(scale, offset), f"dim int, n long, total {_EXACT}, low long, high long").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
    found = {r["dim"]: r for r in stats.collect()}                 # one row a dimension
    if not found:
        return None
    n, dims = int(found[-1]["n"]), len(found) - 1
    sums, lows, highs = [], [], []
    for d in range(dims):
        r = found[d]
        missing = n - int(r["n"])                                   # vectors that end before this dimension
        sums.append(int(r["total"]) + missing * offset)
        lows.append(min(int(r["low"]), offset) if missing else int(r["low"]))
        highs.append(max(int(r["high"]), offset) if missing else int(r["high"]))
    bits = np.array([(h - m).bit_length() for m, h in zip(lows, highs)], np.int64)
    products: dict[tuple[int, int], int] = {}
    if dims and bits.max():
        parts = rows.select("vec").mapInArrow(
            _scatter(scale, offset, np.array(lows, np.int64), bits), f"one int, two int, limb int, common {_EXACT}")
        for r in parts.groupBy("one", "two", "limb").agg(F.sum("common").alias("common")).collect():   # dims^2 / 2 rows a limb
            key = (r["one"], r["two"])
            products[key] = products.get(key, 0) + (int(r["common"]) << (LIMB * r["limb"]))
    return Whitening(n, sums, products, lows, components)


def _projected(model: Whitening, scale: int, offset: int):
    n, sums = model.n, model.sums
    small = n * (1 << 21) < 1 << 62                                 # n * x - S stays in 64 bits for usual x

    def run(batches):
        live = np.flatnonzero(model.live)
        turn = model.axes[:, live] / np.sqrt(model.values[live])
        for batch in batches:
            for part in _pieces(batch):
                x = whole_numbers(part.column("vec"), len(sums), scale, offset)
                mean = np.array([s // n for s in sums], np.int64)
                rest = [s % n for s in sums]
                near = x - mean
                reach = int(np.abs(near).max(initial=0)) + 1
                # n * x - S = n * (x - mean) - rest: its square sum is taken in 64 bits where that surely fits.
                if small and (n * reach) ** 2 * max(len(sums), 1) < 1 << 62:
                    centred = n * near - np.array(rest, np.int64)
                    deviation = (centred * centred).sum(axis=1).tolist()
                else:
                    deviation = [sum((n * int(a) - r) ** 2 for a, r in zip(row, rest)) for row in near]
                exact = near - np.array(rest, np.float64) / n
                whitened = np.full((len(x), len(model.values)), np.nan)
                whitened[:, live] = exact @ turn
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()),
                     pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(model.values),
                                              pa.array(whitened.ravel(), pa.float64(), mask=np.isnan(whitened.ravel())))],
                    names=["vec_id", "deviation", "whitened"])

    return run


def _identity_error(projected: DataFrame, live: list[int]) -> float | None:
    """Largest absolute entry of the measured covariance of ``whitened`` minus the identity."""
    if not live:
        return None
    means = projected.agg(*[F.avg(F.col("whitened")[k]).alias(f"m{k}") for k in live]).first()
    at = {k: F.col("whitened")[k] - F.lit(means[f"m{k}"]) for k in live}
    pairs = [(j, k) for j in live for k in live if j <= k]
    cov = projected.agg(*[F.avg(at[j] * at[k]).alias(f"c{j}_{k}") for j, k in pairs]).first()
    return max(abs(cov[f"c{j}_{k}"] - (j == k)) for j, k in pairs)


def whiten(vectors: DataFrame, *, components: int = 8, scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for every usable vector and component."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = finite_vectors(vectors, scale)
    model = fit(rows, scale, offset, components)
    empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, "
                                      "explained double, identity_error double")
    if model is None or not len(model.values):
        return empty
    projected = staged(rows.mapInArrow(_projected(model, scale, offset),
                                       "vec_id long, deviation long, whitened array<double>"), "whitened")
    error = _identity_error(projected, np.flatnonzero(model.live).tolist())
    explained = F.array(*[F.lit(None if np.isnan(e) else float(e)).cast("double") for e in model.explained])
    return projected.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", explained[F.col("k")].alias("explained"), F.lit(error).cast("double").alias("identity_error"))
