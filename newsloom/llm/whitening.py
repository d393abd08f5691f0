"""Embedding whitening from bit-sliced scatter.

Every entry is made a whole number, ``floor(64 * c) + 1000000``, and the
covariance of the distinct whole-number vectors is found exactly: each
dimension is shifted to start at 0, its bit planes are packed across rows
into 64-bit words, and the cross-product of two dimensions is the sum of
``2^(a+b) * popcount(plane_a AND plane_b)`` over their planes. The products
are centred as whole numbers (``n * sum(xy) - sum(x) * sum(y)``) before they
become floating point for ``eigh``.

Spark deals the rows: the distinct vectors are written down once, each task
adds up its own planes, and the (dimensions x dimensions) sums are added by
key. Only that matrix reaches the driver; its size doesn't depend on the rows.
A second pass over the same vectors measures the covariance of what was
whitened. Whitening itself moves no row.

Defined results: a null vector, one with a null, NaN or infinite entry, or
one whose entries don't fit a long takes no part. Vectors have the length
that most rows have (of equally many, the longer); others take no part.
Repeated vectors count once in the fit and all get their result; null and
repeated ids are rows like others. Components without variance (constant
tables, fewer vectors than dimensions) are left out, as nothing can be
divided by; an empty table gives an empty result. Columns other than the id
and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import shared_table

SCALE, SHIFT = 64, 1_000_000
#: Rows whose planes are packed and compared at a time.
BLOCK_ROWS = 8192
#: Sums travel in pieces of so many bits: a piece is a long even for 2^40 rows.
LIMB_BITS = 16
#: Eigenvalues below this share of the largest are none.
RANK = 1e-11


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with the sums ``sums`` by dimension; columns of
    ``axes`` are the components over the square root of their eigenvalue."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole_numbers(vector: Column) -> Column:
    """``floor(64 * c) + 1000000`` of every entry as array<long>; null where
    the vector takes no part."""
    limit = float(2 ** 62)
    scaled = F.transform(vector.cast("array<double>"), lambda c: F.floor(c * SCALE))
    # NaN compares above every number in Spark, so the bounds exclude it too.
    fits = F.forall(vector.cast("array<double>"), lambda c: F.coalesce(
        (c * SCALE < limit) & (c * SCALE > -limit), F.lit(False)))
    return F.when(fits, F.transform(scaled, lambda c: c + SHIFT))


def prepare(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` of the rows that take part; the length that most rows
    have is found by one count per length."""
    x = rows.select(F.col(id_col).alias("vec_id"), whole_numbers(F.col(vector)).alias("x")).filter("x IS NOT NULL")
    lengths = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return x.filter(F.size("x") == (lengths[0]["d"] if lengths else -1))


def _matrix(batch: pa.RecordBatch, d: int, column: str = "x") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)


def _ranges(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    low = high = None
    n = 0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch, d)
            low = x.min(0) if low is None else np.minimum(low, x.min(0))
            high = x.max(0) if high is None else np.maximum(high, x.max(0))
            n += batch.num_rows
    if n:
        yield pa.RecordBatch.from_pydict({"dim": pa.array(range(d), pa.int32()), "low": low, "high": high,
                                          "n": pa.array([n] * d, pa.int64())})


def _planes(u: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes (dimension x bit) of the rows of ``u``, packed across rows
    into 64-bit words."""
    rows, d = u.shape
    padded = -(-rows // 64) * 64
    out = np.zeros((d, bits, padded // 8), np.uint8)
    for b in range(bits):
        out[:, b, :(rows + 7) // 8] = np.packbits(((u >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T, axis=1)
    return out.view(np.uint64).reshape(d * bits, padded // 64)


def scatter(batches: Iterator[pa.RecordBatch], low: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Sums of the shifted entries and of their products over a task's rows,
    as rows ``(i, j, limb, value)``: the sum of ``value * 2^(16 limb)`` is the
    product sum of dimensions i <= j, or with ``j = -1`` the sum of i."""
    d = len(low)
    limbs = -(-(2 * bits - 1) // LIMB_BITS)
    place = np.add.outer(np.arange(bits), np.arange(bits))            # exponent of a pair of bits
    weight = np.zeros((bits, bits, limbs), np.int64)                  # bit a, bit b -> limb
    for a in range(bits):
        for b in range(bits):
            weight[a, b, place[a, b] // LIMB_BITS] = 1 << int(place[a, b] % LIMB_BITS)
    products = np.zeros((d, d, limbs), np.int64)
    singles = np.zeros((d, limbs), np.int64)
    seen = False
    for batch in batches:
        x = _matrix(batch, d)
        for at in range(0, len(x), BLOCK_ROWS):
            seen = True
            # Shifted entries are below 2^64 even where the difference of two longs isn't a long.
            planes = _planes(x[at:at + BLOCK_ROWS].astype(np.uint64) - low.astype(np.uint64), bits)
            ones = np.bitwise_count(planes).sum(1, dtype=np.int64).reshape(d, bits)
            singles += ones @ weight[:, 0]
            for i in range(d):
                later = planes[i * bits:]
                for a in range(bits):
                    both = np.bitwise_count(later & planes[i * bits + a]).sum(1, dtype=np.int64)
                    products[i, i:] += both.reshape(d - i, bits) @ weight[a]
    if seen:
        i, j, limb = np.indices((d, d, limbs)).reshape(3, -1)
        keep = i <= j
        si, sl = np.indices((d, limbs)).reshape(2, -1)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(np.concatenate([i[keep], si]), pa.int32()),
            "j": pa.array(np.concatenate([j[keep], np.full(len(si), -1)]), pa.int32()),
            "limb": pa.array(np.concatenate([limb[keep], sl]), pa.int32()),
            "value": pa.array(np.concatenate([products.reshape(-1)[keep], singles.reshape(-1)]), pa.int64())})


def centred(sums: list[int], products: dict[tuple[int, int], int], n: int) -> np.ndarray:
    """``n^2`` times the covariance, centred in whole numbers of any size;
    floating point sees the centred number only."""
    d = len(sums)
    out = np.empty((d, d))
    for i in range(d):
        for j in range(i, d):
            out[i, j] = out[j, i] = float(n * products[i, j] - sums[i] * sums[j])
    return out


def project(x: np.ndarray, n: int, sums: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``n * x - S`` (whole numbers; of any size where longs don't hold them)
    and the whitened rows."""
    big = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, map(int, sums)), default=0) >= 2 ** 63
    off = x.astype(object) * n - sums.astype(object) if big else x * np.int64(n) - sums.astype(np.int64)
    return off, (off.astype(np.float64) / n) @ axes


def _cross(batches: Iterator[pa.RecordBatch], d: int, n: int, sums: np.ndarray, axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    k = axes.shape[1]
    total, first = np.zeros((k, k)), np.zeros(k)
    for batch in batches:
        y = project(_matrix(batch, d), n, sums, axes)[1]
        total += y.T @ y
        first += y.sum(0)
    a, b = np.indices((k, k)).reshape(2, -1)
    yield pa.RecordBatch.from_pydict({
        "a": pa.array(np.concatenate([a, np.arange(k)]), pa.int32()),
        "b": pa.array(np.concatenate([b, np.full(k, -1)]), pa.int32()),
        "value": pa.array(np.concatenate([total.reshape(-1), first]), pa.float64())})


def fit(x: DataFrame, components: int = 16) -> Whitening | None:
    """The whitening of the distinct vectors of :func:`prepare`'s rows; None
    without rows or without variance."""
    unique = shared_table(x.select("x").distinct())
    head = unique.limit(1).collect()
    if not head:
        return None
    d = len(head[0]["x"])
    spans = (unique.mapInArrow(lambda it: _ranges(it, d), "dim int, low long, high long, n long")
             .groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
             .orderBy("dim").collect())
    if not spans:
        return None
    n, low = spans[0]["n"], np.array([r["low"] for r in spans], np.int64)
    bits = max(1, max((r["high"] - r["low"]).bit_length() for r in spans))
    pieces = (unique.mapInArrow(lambda it: scatter(it, low, bits), "i int, j int, limb int, value long")
              .groupBy("i", "j", "limb").agg(F.sum("value").alias("value")).collect())
    shifted: dict[tuple[int, int], int] = {}
    for r in pieces:
        shifted[r["i"], r["j"]] = shifted.get((r["i"], r["j"]), 0) + (r["value"] << (LIMB_BITS * r["limb"]))
    u_sums = [shifted[i, -1] for i in range(d)]
    # A shift changes no centred product.
    v = centred(u_sums, shifted, n)
    e, axes = np.linalg.eigh(v / float(n) / float(n))
    e, axes = e[::-1], axes[:, ::-1]
    k = int(np.sum(e[:components] > RANK * max(e[0], 0.0)))
    if k == 0:
        return None
    axes = axes[:, :k] * np.where(axes[np.abs(axes[:, :k]).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    scaled = axes / np.sqrt(e[:k])
    sums = tuple(u + n * int(m) for u, m in zip(u_sums, low))
    held = np.array(sums, object)
    cross = {(r["a"], r["b"]): r["value"] for r in
             unique.mapInArrow(lambda it: _cross(it, d, n, held, scaled), "a int, b int, value double")
             .groupBy("a", "b").agg(F.sum("value").alias("value")).collect()}
    mean = np.array([cross[a, -1] / n for a in range(k)])
    cov = np.array([[cross[a, b] / n for b in range(k)] for a in range(k)]) - np.outer(mean, mean)
    trace = sum(n * shifted[i, i] - u_sums[i] ** 2 for i in range(d)) / n / n
    return Whitening(n, sums, scaled, e[:k] / trace, float(np.abs(cov - np.eye(k)).max()))


def whiten(x: DataFrame, fitted: Whitening | None) -> DataFrame:
    """For each row of :func:`prepare` and component: ``vec_id, component,
    n, deviation`` (sum over dimensions of ``(n * x - S)^2``, exact), ``whitened,
    explained, identity_error``. A deviation that doesn't fit a long is null."""
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    schema = schema.replace("vec_id long", f"vec_id {x.schema['vec_id'].dataType.simpleString()}")
    if fitted is None:
        return x.sparkSession.createDataFrame([], schema)
    n, sums, axes = fitted.n, np.array(fitted.sums, object), fitted.axes
    d, k = axes.shape
    explained, error = fitted.explained, fitted.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            off, y = project(_matrix(batch, d), n, sums, axes)
            dev = pa.array([v if v < 2 ** 63 else None for v in squares(off)], pa.int64())
            at = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(at)),
                "component": pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                "n": pa.array(np.full(rows * k, n), pa.int64()),
                "deviation": dev.take(pa.array(at)), "whitened": y.reshape(-1),
                "explained": np.tile(explained, rows), "identity_error": np.full(rows * k, error)})

    return x.mapInArrow(run, schema)


def squares(off: np.ndarray) -> list[int]:
    """Exact sum of squares of every row, whatever its size."""
    top = int(np.abs(off).max(initial=0)) if off.dtype != object else 2 ** 63
    if top * top * max(1, off.shape[1]) < 2 ** 63:
        return (off * off).sum(1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in off]


def whiten_table(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """Fit on the rows that take part and whiten all of them."""
    x = prepare(rows, id_col, vector)
    return whiten(x, fit(x, components))
