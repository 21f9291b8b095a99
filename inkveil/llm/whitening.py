"""Whitening of embeddings, each different vector once.

Entries are rounded down to integers, so copies and near copies become the same vector `x`.
Equal vectors are grouped, and their number is the weight with which they enter the fit: exact
integer sums first, then a weighted product of centred matrices, summed over tasks. The
eigenvectors of that covariance (a matrix of the vectors' length, solved on the driver) whiten
every different vector once; the rows get the result by a join on the vector.

What the driver holds grows with the length of the vectors only, not with their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.llm.common import staged

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Integers up to this come out of products and sums of longs as they are.
_EXACT = 1 << 62


@dataclass(frozen=True)
class Model:
    """What was fitted to the vectors of one length."""

    n: int
    sums: tuple[int, ...]
    #: one column for each component, over the root of its eigenvalue
    directions: np.ndarray
    explained: tuple[float | None, ...]
    #: mean of the centred vectors, all but zero
    rest: np.ndarray


def integers(vector: Column) -> Column:
    return F.transform(
        vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")) + F.lit(SHIFT).cast("long")
    )


def finite(vector: Column) -> Column:
    """Is there a vector, and are all of its entries numbers?"""
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, odd)


def _matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one length as a matrix, and their places, for each length above zero."""
    flat, sizes = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
    first = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]):
        places = np.flatnonzero(sizes == size)
        yield places, flat[first[places, None] + np.arange(size)]


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n x - S, exact: as longs if these suffice, else as Python's integers."""
    largest = max(abs(int(x.min())), abs(int(x.max())), 1) * n
    if 2 * largest < _EXACT and max(map(abs, sums)) < _EXACT:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squared(dev: np.ndarray) -> np.ndarray:
    top = max(abs(int(dev.min())), abs(int(dev.max())))
    if dev.dtype == object or top * top * dev.shape[1] >= _EXACT:
        dev = dev.astype(object)
    return (dev * dev).sum(axis=1)


def _totals(rows: DataFrame) -> dict[int, tuple[int, tuple[int, ...]]]:
    """By length: the number of vectors and the sums of their entries, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            weight = batch.column(1).to_numpy()
            for places, x in _matrices(batch.column(0)):
                own = weight[places].astype(object)
                add = np.concatenate([[own.sum()], (x.astype(object) * own[:, None]).sum(axis=0)])
                found[x.shape[1]] = found.get(x.shape[1], 0) + add
        for size, sums in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([size] * len(sums), pa.int32()),
                    pa.array(range(-1, len(sums) - 1), pa.int32()),
                    pa.array([str(s) for s in sums], pa.string()),
                ],
                ["size", "at", "total"],
            )

    parts = rows.select("x", "weight").mapInArrow(run, "size int, at int, total string")
    summed = parts.groupBy("size", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("t"))
    found: dict[int, list[int]] = {}
    for r in summed.orderBy("size", "at").collect():
        found.setdefault(r["size"], []).append(int(r["t"]))
    return {size: (n, tuple(sums)) for size, (n, *sums) in found.items()}


def _products(rows: DataFrame, centred) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: weighted sums of the centred rows, and of their products with one another.

    `centred` makes a matrix of doubles from a length and a matrix of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            weight = batch.column(1).to_numpy().astype(np.float64)
            size = batch.column(2).to_numpy()
            for places, values in _matrices(batch.column(0)):
                for own in np.unique(size[places]):
                    some = size[places] == own
                    d, w = centred(int(own), values[some]), weight[places][some, None]
                    add = np.vstack([(d * w).sum(axis=0), (d * w).T @ d])
                    found[int(own)] = found.get(int(own), 0) + add
        for own, sums in found.items():
            i, j = np.triu_indices(sums.shape[1])
            row = np.concatenate([np.zeros(sums.shape[1], int), i + 1])
            col = np.concatenate([np.arange(sums.shape[1]), j])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([own] * len(row), pa.int32()),
                    pa.array(row, pa.int32()),
                    pa.array(col, pa.int32()),
                    pa.array(sums[row, col]),
                ],
                ["size", "i", "j", "total"],
            )

    parts = rows.mapInArrow(run, "size int, i int, j int, total double")
    summed = parts.groupBy("size", "i", "j").agg(F.sum("total").alias("t")).toArrow()
    out = {}
    size, i, j, total = (summed[c].to_numpy() for c in ("size", "i", "j", "t"))
    for own in np.unique(size):
        some = size == own
        width = j[some].max() + 1
        sums = np.zeros((width + 1, width))
        sums[i[some], j[some]] = total[some]
        upper = np.triu(sums[1:])
        out[int(own)] = (sums[0], upper + np.triu(upper, 1).T)
    return out


def fitted(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model for each length of the vectors `x` of `distinct`, which count `weight` times.

    Eigenvalues that are zero to double precision give no direction.
    """
    totals = _totals(distinct)

    def centred(size: int, x: np.ndarray) -> np.ndarray:
        n, sums = totals[size]
        return (_deviations(x, n, sums) / n).astype(np.float64)

    models = {}
    rows = distinct.select("x", "weight", F.size("x").alias("size"))
    for size, (rest, products) in _products(rows, centred).items():
        n, sums = totals[size]
        values, vectors = np.linalg.eigh(products / n)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        trace = float(np.trace(products / n))
        usable = values > max(values[0], 0) * size * np.finfo(float).eps
        models[size] = Model(
            n,
            sums,
            vectors[:, usable] / np.sqrt(values[usable]),
            tuple(max(float(v), 0.0) / trace if trace > 0 else None for v in values),
            rest / n,
        )
    return models


def whitened_once(distinct: DataFrame, models: dict[int, Model]) -> DataFrame:
    """`x, weight, size, deviation, whitened` for each different vector, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation = np.zeros(batch.num_rows, object)
            values: list[np.ndarray] = [np.zeros(0)] * batch.num_rows
            for places, x in _matrices(batch.column(0)):
                model = models[x.shape[1]]
                dev = _deviations(x, model.n, model.sums)
                deviation[places] = _squared(dev)
                z = (dev / model.n).astype(np.float64) @ model.directions
                for k, at in enumerate(places.tolist()):
                    values[at] = z[k]
            ends = np.concatenate([[0], np.cumsum([len(v) for v in values])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(np.concatenate(values), pa.float64())
                    ),
                ],
                ["x", "weight", "size", "deviation", "whitened"],
            )

    schema = "x array<long>, weight long, size int, deviation long, whitened array<double>"
    rows = distinct.select("x", "weight", F.size("x").alias("size"))
    return staged(rows.mapInArrow(run, schema), "whitened")


def identity_errors(once: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length: how far the covariance of the whitened vectors is from the identity at most."""
    means = {size: m.rest @ m.directions for size, m in models.items()}

    def centred(size: int, z: np.ndarray) -> np.ndarray:
        return z - means[size]

    found = _products(once.select("whitened", "weight", "size"), centred)
    return {
        size: float(np.abs(products / models[size].n - np.eye(len(products))).max())
        for size, (_, products) in found.items()
    }


def whitened(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """For each vector and component: vec_id, component (from 1), n, deviation, whitened,
    explained, identity_error.

    Rows whose vector is null or has an entry that is null, NaN or infinite are left out. Null
    and repeated ids stay, repeated vectors count each time. Vectors of another length are
    fitted on their own; empty ones have no component. A component without spread (all vectors
    equal, fewer vectors than components) has whitened null and does not count for
    identity_error, which is null where no component has any; without any spread explained is
    null too. A deviation beyond a long is null. Other columns are ignored, an empty table gives
    an empty result.
    """
    kept = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")).filter(
        finite(F.col("v"))
    )
    rows = kept.select("vec_id", integers(F.col("v")).alias("x"))
    distinct = staged(rows.groupBy("x").agg(F.count(F.lit(1)).alias("weight")), "distinct-vectors")
    models = fitted(distinct, components)
    once = whitened_once(distinct, models)
    errors = identity_errors(once, models)
    # a row for each length
    told = vectors.sparkSession.createDataFrame(
        [(size, m.n, list(m.explained), errors.get(size)) for size, m in models.items()],
        "size int, n long, explained array<double>, identity_error double",
    )
    return (
        rows.join(once.select("x", "size", "deviation", "whitened"), "x")
        .join(F.broadcast(told), "size")
        .select("*", F.posexplode("explained").alias("at", "share"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            "n",
            "deviation",
            F.get("whitened", F.col("at")).alias("whitened"),
            F.col("share").alias("explained"),
            "identity_error",
        )
    )
