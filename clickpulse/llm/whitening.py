"""Embedding whitening from a bit-sliced scatter matrix.

Components become whole numbers. Every batch of different vectors is shifted to start at zero, and each
dimension's bit planes are packed across rows into words. The popcount of two planes' AND, weighted by the
planes' places, adds up to the exact cross-product of two dimensions. Spark sums the batches' products; they
are centred as whole numbers before the eigenvectors are taken, so no digit is lost to cancellation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.shared import written

#: Vectors whose planes are packed at a time.
ROWS = 16_384
#: A component is kept apart from rounding: its variance is at least this share of the largest one.
LEAST_SHARE = 1e-12


def whole(vector: str, scale: int) -> Column:
    """``floor(scale * c)`` of each component in double precision, as longs; those beyond a long become its ends."""
    return F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))).cast("bigint"))


def usable(vector: str) -> Column:
    """Whether a vector is there and holds neither nulls nor components that are not finite."""
    def broken(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    return ~F.coalesce(F.exists(F.col(vector).cast("array<double>"), broken), F.lit(True))


def planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative whole numbers (rows by dimensions), 64 rows to a word.

    Gives the planes, and the dimension and the place value (as a shift) of each. Empty planes are left out.
    """
    rows, dims = shifted.shape
    filled = np.zeros((-(-rows // 64) * 64, dims), np.uint64)
    filled[:rows] = shifted
    found, dim, place = [], [], []
    for bit in range(int(shifted.max(initial=0)).bit_length()):
        bits = (filled >> np.uint64(bit) & np.uint64(1)).astype(bool)
        have = np.flatnonzero(bits.any(axis=0))
        if not len(have):
            continue
        found.append(np.packbits(bits[:, have].T, axis=1, bitorder="little").view("<u8"))
        dim.append(have)
        place.append(np.full(len(have), bit))
    if not found:
        return np.zeros((0, len(filled) // 64), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(dim), np.concatenate(place)


def cross_products(shifted: np.ndarray) -> np.ndarray:
    """Exact sums over rows of the products of each two dimensions, as Python integers, from AND-popcounts."""
    dims = shifted.shape[1]
    packed, dim, place = planes(shifted)
    out = np.zeros((dims, dims), object)
    wide = 2 * int(place.max(initial=0)) + 2 + len(shifted).bit_length() > 62
    weight = np.array([1 << int(p) for p in place], object if wide else np.int64)
    order = np.argsort(dim, kind="stable")
    packed, dim, weight = packed[order], dim[order], weight[order]
    starts = np.flatnonzero(np.append(True, dim[1:] != dim[:-1])) if len(dim) else dim
    for k in range(len(dim)):
        first = int(starts[np.searchsorted(starts, k, "right") - 1])  # dimensions before this one have been there
        counts = np.bitwise_count(packed[first:] & packed[k]).sum(axis=1, dtype=np.int64)
        sums = np.add.reduceat(counts * weight[first:], starts[starts >= first] - first) * weight[k]
        out[dim[k], dim[starts[starts >= first]]] += sums.astype(object)
    upper = np.triu(out, 1)
    return out + upper.T


def _summed(vectors: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Exact sums of each dimension, and of the products of each two."""
    least = vectors.min(axis=0)
    # the difference of two longs fits an unsigned one
    shifted = vectors.astype(np.uint64) - least.astype(np.uint64)
    low = np.array([int(v) for v in least], object)
    highest = int(shifted.max(initial=0))
    exact = shifted.astype(object) if highest * len(vectors) >= 1 << 63 else shifted.astype(np.int64)
    sums = np.array([int(s) for s in exact.sum(axis=0)], object)
    n = len(vectors)
    product = cross_products(shifted) + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)
    return [int(s) for s in sums + n * low], product


def scatter(fit: DataFrame, vector: str) -> DataFrame:
    """``dim, a, b, total`` for ``a <= b``: the sums over all vectors of one length of ``x_a * x_b``.

    ``b`` is the length itself for the plain sums, and both are for the number of vectors. ``total`` is a
    decimal of 38 digits; sums beyond it end the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                lists = batch.column(0).slice(first, ROWS)
                sizes, values = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
                for dim in np.unique(sizes[sizes > 0]).tolist():
                    vectors = values[np.repeat(sizes == dim, sizes)].reshape(-1, dim)
                    sums, products = _summed(vectors)
                    total = totals.setdefault(dim, np.zeros((dim + 1, dim + 1), object))
                    total[:dim, :dim] += products
                    total[:dim, dim] += np.array(sums, object)
                    total[dim, dim] += len(vectors)
        for dim, total in totals.items():
            for a in range(dim + 1):
                b = np.arange(a, dim + 1)
                cells = pa.array([str(t) for t in total[a, a:]], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b), dim), pa.int32()), pa.array(np.full(len(b), a), pa.int32()), pa.array(b, pa.int32()), cells],
                    names=["dim", "a", "b", "total"],
                )

    cells = fit.select(vector).mapInArrow(run, "dim int, a int, b int, total string")
    return cells.groupBy("dim", "a", "b").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


class Model(NamedTuple):
    """Of the vectors of one length: their number, exact sums, unit eigenvectors (rows), eigenvalues and their share."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def fitted(n: int, sums: list[int], products: list[list[int]], components: int) -> Model:
    """``products[a][b]`` for ``a <= b``. The covariance is ``(n * products - sums * sums) / n ** 2``, subtracted exactly."""
    dims = len(sums)
    covariance = np.zeros((dims, dims))
    for a in range(dims):
        for b in range(a, dims):
            covariance[a, b] = covariance[b, a] = (n * products[a][b] - sums[a] * sums[b]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    trace = math.fsum(covariance.diagonal())
    values, vectors = values[::-1][:components], vectors.T[::-1][:components]
    # one sign for all: the entry of largest size is positive
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    share = values / trace if trace else np.zeros(len(values))
    return Model(n, sums, vectors * np.where(signs == 0, 1, signs)[:, None], values, share)


def fit_on(fit: DataFrame, vector: str, components: int) -> dict[int, Model]:
    """A model for each length of vector. The driver gets one number for each two dimensions."""
    cells: dict[int, dict[tuple[int, int], int]] = {}
    for row in scatter(fit, vector).toLocalIterator():
        cells.setdefault(row["dim"], {})[row["a"], row["b"]] = int(row["total"])
    models = {}
    for dim, found in cells.items():
        products = [[found[min(a, b), max(a, b)] for b in range(dim)] for a in range(dim)]
        models[dim] = fitted(found[dim, dim], [found[a, dim] for a in range(dim)], products, components)
    return models


def _deviations(vectors: np.ndarray, model: Model) -> list[int | None]:
    """Exact sums over dimensions of ``(n * x - S) ** 2``."""
    reach = max(abs(int(vectors.min(initial=0))), abs(int(vectors.max(initial=0)))) * model.n + max(map(abs, model.sums))
    kind = np.int64 if reach * reach * len(model.sums) < 1 << 63 else object
    off = vectors.astype(kind) * model.n - np.array(model.sums, kind)
    return [int(v) for v in (off * off).sum(axis=1)]


def _projected(vectors: np.ndarray, model: Model) -> np.ndarray:
    """``x - S / n`` on each component over the root of its variance; the whole parts are subtracted exactly."""
    whole_parts = np.array([s // model.n for s in model.sums], object)
    rest = np.array([s % model.n / model.n for s in model.sums])
    off = vectors.astype(object) - whole_parts if np.abs(whole_parts).max() > 1 << 61 else vectors - whole_parts.astype(np.int64)
    kept = model.values > LEAST_SHARE * model.values[0]
    scale = np.where(kept, 1 / np.sqrt(np.where(kept, model.values, 1)), np.nan)
    return ((off.astype(np.float64) - rest) @ model.vectors.T) * scale


def project(rows: DataFrame, models: dict[int, Model], id_col: str, vector: str) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained`` for each row and component, from 1 on.

    ``deviation`` is a decimal, null beyond 38 digits; ``whitened`` is null where the fitted vectors do not
    vary along a component.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                lists = part.column(1)
                sizes, values = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
                for dim in np.unique(sizes[sizes > 0]).tolist():
                    model, have = models[dim], sizes == dim
                    vectors = values[np.repeat(have, sizes)].reshape(-1, dim)
                    count, each = len(vectors), len(model.values)
                    deviation = [str(v) for v in _deviations(vectors, model)]
                    out = _projected(vectors, model).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).filter(pa.array(have)).take(pa.array(np.repeat(np.arange(count), each))),
                            pa.array(np.tile(np.arange(1, each + 1), count), pa.int32()),
                            pa.array(np.full(count * each, model.n), pa.int64()),
                            pa.array(deviation, pa.string()).take(pa.array(np.repeat(np.arange(count), each))),
                            pa.array(out, pa.float64(), mask=np.isnan(out)),
                            pa.array(np.tile(model.explained, count), pa.float64()),
                        ],
                        names=[id_col, "component", "n", "deviation", "whitened", "explained"],
                    )

    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n bigint, deviation string, whitened double, explained double"
    found = rows.select(id_col, vector).mapInArrow(run, schema)
    return found.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def identity_error(fit: DataFrame, models: dict[int, Model], vector: str) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured over all of ``fit``."""
    worst = 0.0
    for dim, model in models.items():
        kept = range(1, 1 + int((model.values > LEAST_SHARE * model.values[0]).sum()))
        if not kept:
            continue
        wide = _columns(fit.where(F.size(vector) == dim), model, vector)
        pairs = [(a, b) for a in kept for b in kept if a <= b]
        row = wide.agg(*(F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs)).first()
        worst = max(worst, *(abs(row[f"c{a}_{b}"] - (a == b)) for a, b in pairs))
    return worst


def _columns(rows: DataFrame, model: Model, vector: str) -> DataFrame:
    """``w1, w2, ...`` for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            out = _projected(vectors, model)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in out.T], names=names)

    names = [f"w{k}" for k in range(1, len(model.values) + 1)]
    return rows.select(vector).mapInArrow(run, ", ".join(f"{name} double" for name in names))


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = 256
) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error`` for each usable row and component.

    Rows whose vector is null or holds a null, a NaN or an infinity are left out. Each different vector of
    whole numbers counts once in the fit, however often it occurs. Vectors of different lengths are fitted
    apart; those without components give no row. Where there are fewer dimensions than ``components``, there
    are as many components as dimensions. Rows that repeat, or have no id, are kept. An empty table gives an
    empty result. Only the two columns are read.
    """
    numbers = rows.where(usable(vector)).select(id_col, whole(vector, scale).alias("__x"))
    fit = written(numbers.select("__x").distinct(), "whitening-fit")
    models = fit_on(fit, "__x", components)
    error = identity_error(fit, models, "__x")
    return project(numbers, models, id_col, "__x").withColumn("identity_error", F.lit(error))
