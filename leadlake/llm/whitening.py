"""Whitening of embeddings: covariances from exact variances of dimensions and of their sums (polarisation), then principal components to unit variance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import checkpointed

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
# Below this share of the largest eigenvalue a direction counts as without variance.
FLAT = 1e-12
# Whole numbers are held within this bound, which doubles count exactly.
_WIDEST = 1 << 53
# Squares of sums of two numbers below _SMALL, added up over _ROWS rows, stay within 64 bits; larger ones are worked out in unbounded integers.
_SMALL = 1 << 24
_ROWS = 4096


def _whole(column: pa.ListArray, length: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, whole-number matrix) of the usable vectors of a batch, one pair for each length that occurs, or for the given one."""
    sizes = np.where(column.is_valid(), column.value_lengths().fill_null(0), 0)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    for size in np.unique(sizes[sizes > 0]) if length is None else [length]:
        rows = np.flatnonzero(sizes == size)
        values = flat[first[rows, None] + np.arange(size)]
        fit = np.isfinite(values).all(axis=1)
        scaled = np.clip(np.floor(SCALE * values[fit]), -_WIDEST, _WIDEST).astype(np.int64) + SHIFT
        for at in range(0, len(scaled), _ROWS):
            yield rows[fit][at : at + _ROWS], scaled[at : at + _ROWS]


def _exact(values: np.ndarray, bound: int) -> np.ndarray:
    """The numbers as 64-bit integers where all lie below the bound, else as unbounded ones."""
    return values if not values.size or np.abs(values).max() < bound else values.astype(object)


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


@dataclass
class Fit:
    """Count, whole-number sums by dimension, covariance matrix, and the leading components (columns of `axes`) with their eigenvalues."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    axes: np.ndarray


def dimension_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """(number, sums by dimension) of the usable vectors of the commonest length (the longer one among equals)."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = {}, {}
        for batch in batches:
            for _, x in _whole(batch.column("v")):
                size = x.shape[1]
                n[size] = n.get(size, 0) + len(x)
                sums[size] = sums.get(size, 0) + _exact(x, _WIDEST >> 4).sum(axis=0).astype(object)
        for size in n:
            yield pa.RecordBatch.from_arrays([pa.array([size] * size), pa.array(range(size)), pa.array([n[size]] * size), _decimals(sums[size])], ["size", "dim", "n", "s"])

    parts = vectors.mapInArrow(added, "size long, dim long, n long, s decimal(38,0)").groupBy("size", "dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    parts = checkpointed(parts)
    common = parts.where("dim = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return 0, []
    return common["n"], [int(r["s"]) for r in parts.where(F.col("size") == common["size"]).orderBy("dim").collect()]


def covariance(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """All covariances over the vectors of length len(sums), divisor n.

    Every task adds up (x_i - m_i)^2 for each dimension and (x_i - m_i + x_j - m_j)^2 for each pair, where m is the whole part of the mean; its fraction
    is settled at the end, so all variances are exact. Then 2 cov(i, j) = var(i + j) - var(i) - var(j). A task sends one number a pair, however many
    vectors it reads.
    """
    d, whole = len(sums), np.array([s // n for s in sums], np.int64)

    def squared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, wide, seen = np.zeros((d, d), np.int64), np.zeros((d, d), np.int64), {}, False
        for batch in batches:
            for _, x in _whole(batch.column("v"), d):
                y, seen = _exact(x - whole, _SMALL), True
                for i in range(d):
                    both = y[:, i:] + y[:, i : i + 1]
                    both[:, 0] = y[:, i]
                    part = (both * both).sum(axis=0)
                    if y.dtype == object:
                        wide[i] = wide.get(i, 0) + part
                    else:
                        high[i, i:] += part >> 32
                        low[i, i:] += part & 0xFFFFFFFF
        if seen:
            for i in range(d):
                total = (high[i, i:].astype(object) << 32) + low[i, i:].astype(object) + wide.get(i, 0)
                yield pa.RecordBatch.from_arrays([pa.array([i] * (d - i)), pa.array(range(i, d)), _decimals(total)], ["i", "j", "q"])

    parts = vectors.mapInArrow(squared, "i long, j long, q decimal(38,0)").groupBy("i", "j").agg(F.sum("q").alias("q")).collect()
    rest = [s - n * m for s, m in zip(sums, whole.tolist())]
    spread = {(r["i"], r["j"]): n * int(r["q"]) - (rest[r["i"]] + (rest[r["j"]] if r["i"] != r["j"] else 0)) ** 2 for r in parts}
    found = np.zeros((d, d))
    for (i, j), value in spread.items():
        # Whole numbers to the end: one rounding for each entry.
        found[i, j] = found[j, i] = value / (n * n) if i == j else (value - spread[i, i] - spread[j, j]) / (2 * n * n)
    return found


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Components by falling eigenvalue, each with its largest entry positive; None without a usable vector. What reaches the driver is one number for
    each pair of dimensions."""
    n, sums = dimension_sums(vectors)
    if not n:
        return None
    v = covariance(vectors, n, sums)
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    axes = axes[:, order]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    return Fit(n, sums, v, values[order], axes)


def whitened(vectors: DataFrame, fitted: Fit) -> DataFrame:
    """(id, deviation, z) for every usable vector: its exact squared distance from the mean in units of 1/n, and its coordinates of unit variance (null for
    a direction without variance). A deviation that no long holds is null."""
    n, sums, d = fitted.n, fitted.sums, len(fitted.sums)
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s - n * m for s, m in zip(sums, whole.tolist())], np.int64)
    live = fitted.values > FLAT * max(float(fitted.values.max()), 0.0)
    turn = fitted.axes / np.sqrt(np.where(live, fitted.values, 1.0))
    square = sum(r * r for r in rest.tolist())

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _whole(batch.column("v"), d):
                y = x - whole
                own = _exact(y, _SMALL)
                cross = own * rest if own.dtype != object and n < 1 << 32 else y.astype(object) * rest.astype(object)
                far = [n * n * int(a) - 2 * n * int(b) + square for a, b in zip((own * own).sum(axis=1), cross.sum(axis=1))]
                z = (y - rest / n) @ turn
                coordinates = pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, z.shape[1], dtype=np.int32)), pa.array(z.ravel(), mask=np.tile(~live, len(z))))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), pa.array([f if f < 1 << 63 else None for f in far], pa.int64()), coordinates], ["id", "deviation", "z"])

    return vectors.mapInArrow(turned, f"id {vectors.schema['id'].dataType.simpleString()}, deviation long, z array<double>")


def identity_error(rows: DataFrame, fitted: Fit) -> float | None:
    """Largest absolute entry of the covariance of `z` minus the identity, from the rows themselves, over the directions with variance."""
    live = [k for k, e in enumerate(fitted.values) if e > FLAT * max(float(fitted.values.max()), 0.0)]
    pairs = [(i, j) for i in live for j in live if i <= j]
    if not pairs:
        return None
    found = rows.agg(*(F.covar_pop(F.col("z")[i], F.col("z")[j]) for i, j in pairs)).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def digest(embeddings: DataFrame) -> DataFrame:
    """A row per usable vector and component, repeated ids and vectors included.

    A vector is usable if it and its entries are not null and finite and it has the commonest length of such vectors (the longer one among equals). Ids may be
    null; extra columns are not read. Directions without variance give null coordinates, so do vectors that are all equal. Entries beyond 2^43 in size are
    held at that bound. Without a usable vector there is no row.
    """
    vectors = embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    fitted = fit(vectors)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = checkpointed(whitened(vectors, fitted))
    error = identity_error(rows, fitted)
    trace = float(np.trace(fitted.covariance))
    shares = F.array(*(F.lit(max(float(e), 0.0) / trace if trace > 0 else None).cast("double") for e in fitted.values))
    each = rows.select("id", "deviation", F.posexplode("z").alias("k", "whitened"))
    return each.select(F.col("id").alias("vec_id"), (F.col("k") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
                       shares[F.col("k")].alias("explained"), F.lit(error).cast("double").alias("identity_error"))
