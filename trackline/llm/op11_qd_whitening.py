"""Whitening of embeddings by blockwise QR and a bidiagonal quotient-difference solver.

Every task reduces its centred rows block by block to one triangular matrix; these are merged in groups until one is left.
Its bidiagonal form gives the singular values (dqds) and, by twisted factorisations, the principal directions
(see `bidiagonal`). The covariance matrix, whose small eigenvalues would drown in rounding, is never formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.bidiagonal import principal
from trackline.llm.common import arrow_map, table, written

#: Entries become whole numbers floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1_024, 100_000
#: Components returned.
COMPONENTS = 8
#: Entries beyond this size (in whole numbers) count as this size.
LARGEST = 2 ** 40
#: Largest dimension: the driver and each merging task hold triangular matrices of that size squared.
MOST_DIMENSIONS = 2_048
#: Rows of a block, at least, and triangular matrices merged by one task.
BLOCK, FAN = 1_024, 16
#: Directions with less than this share of the largest spread are rounding, not data.
LEAST_SPREAD = 1e-12


def whole(vectors: pa.Array, dims: int) -> np.ndarray:
    """The vectors of one length as rows of whole numbers."""
    entries = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        steps = np.floor(SCALE * entries)
    return np.clip(steps, -LARGEST, LARGEST).astype(np.int64).reshape(-1, dims) + OFFSET


@dataclass(frozen=True)
class Centre:
    """Number of fitted rows, their sums per dimension, and the largest entry."""

    n: int
    sums: list[int]
    largest: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sum, exactly: 64-bit numbers where they hold it, Python's otherwise."""
        if 2 * self.n * self.largest < 2 ** 63:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


def squares(deviations: np.ndarray) -> pa.Array:
    """The exact sum of squares of each row."""
    most = int(np.abs(deviations).max(initial=0))
    if deviations.dtype != object and most * most * deviations.shape[1] < 2 ** 63:
        return pa.array((deviations * deviations).sum(axis=1)).cast(pa.decimal128(38, 0))
    exact = deviations.astype(object)
    return pa.array([Decimal(s) for s in (exact * exact).sum(axis=1)], pa.decimal128(38, 0))


def _sums(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    rows, largest, sums = 0, 0, np.zeros(dims, object)
    for batch in batches:
        x = whole(batch.column(1), dims)
        rows += len(x)
        largest = max(largest, int(np.abs(x).max(initial=0)))
        sums += x.sum(axis=0)
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, dims)), pa.array([Decimal(int(s)) for s in (rows, *sums)], pa.decimal128(38, 0)),
             pa.array([largest] * (dims + 1))], names=["dim", "total", "largest"])


def centre_of(rows: DataFrame, dims: int) -> Centre:
    """One pass; tasks hand on one sum per dimension."""
    parts = arrow_map(rows, _sums, "dim long, total decimal(38,0), largest long", dims)
    found = {r.dim: r for r in parts.groupBy("dim").agg(F.sum("total").alias("total"),
                                                        F.max("largest").alias("largest")).collect()}
    if not found:
        return Centre(0, [0] * dims, 0)
    return Centre(int(found[-1].total), [int(found[k].total) for k in range(dims)], found[-1].largest)


def _triangle(*parts: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack(parts), mode="r")


def _triangles(batches: Iterator[pa.RecordBatch], centre: Centre) -> Iterator[pa.RecordBatch]:
    dims = len(centre.sums)
    r, held, rows = np.zeros((0, dims)), [], 0
    for batch in batches:
        held.append(centre.centred(whole(batch.column(1), dims)))
        rows += batch.num_rows
        if rows >= max(BLOCK, 4 * dims):
            r, held, rows = _triangle(r, *held), [], 0
    if held:
        r = _triangle(r, *held)
    if len(r):
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()])], names=["part", "r"])


def triangle_of(rows: DataFrame, centre: Centre) -> np.ndarray:
    """The triangular factor of all centred rows: one per task, then FAN at a time merged into one."""
    dims = len(centre.sums)

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        r = _triangle(*(np.frombuffer(b).reshape(-1, dims) for b in group["r"]))
        return pd.DataFrame({"part": [group["part"].iloc[0] // FAN], "r": [r.tobytes()]})

    parts = written(arrow_map(rows, _triangles, "part long, r binary", centre), "triangles")
    while parts.limit(2).count() > 1:
        parts = written(parts.groupBy(F.floor(F.col("part") / FAN).alias("group")).applyInPandas(
            merged, "part long, r binary"), "triangles")
    last = parts.first()
    r = np.frombuffer(last.r).reshape(-1, dims) if last else np.zeros((0, dims))
    return np.vstack([r, np.zeros((dims - len(r), dims))])


@dataclass(frozen=True)
class Whitening:
    """Centre, falling eigenvalues of the covariance, their unit vectors as rows, and the trace of the covariance."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def fitted(rows: DataFrame, dims: int, components: int) -> Whitening:
    centre = centre_of(rows, dims)
    if not centre.n:
        return Whitening(centre, np.zeros(0), np.zeros((0, dims)), 0.0)
    r = triangle_of(rows, centre) / np.sqrt(centre.n)
    values, vectors = principal(r, components)
    real = values > LEAST_SPREAD ** 2 * (values[0] if len(values) else 0)
    values, vectors = values[real], vectors[real]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]) if len(vectors) else np.zeros(0)
    return Whitening(centre, values, vectors * signs[:, None], float((r * r).sum()))


def _products(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    size, dims = len(model.values), len(model.centre.sums)
    total = np.zeros((size, size + 1))
    for batch in batches:
        w = model.whitened(whole(batch.column(1), dims))
        total += np.hstack([w.T @ w, w.sum(axis=0)[:, None]])
    cells = np.indices(total.shape).reshape(2, -1)
    yield pa.RecordBatch.from_arrays([pa.array(cells[0]), pa.array(cells[1]), pa.array(total.ravel())],
                                     names=["i", "j", "total"])


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened rows minus the identity, from one more pass."""
    size = len(model.values)
    if not size:
        return 0.0
    total = np.zeros((size, size + 1))
    parts = arrow_map(rows, _products, "i long, j long, total double", model)
    for cell in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        total[cell.i, cell.j] = cell.total
    total /= model.centre.n
    mean = total[:, -1]
    return float(np.abs(total[:, :-1] - np.outer(mean, mean) - np.eye(size)).max())


def _rows(batches: Iterator[pa.RecordBatch], model: Whitening, error: float) -> Iterator[pa.RecordBatch]:
    size, dims = len(model.values), len(model.centre.sums)
    for batch in batches:
        x = whole(batch.column(1), dims)
        each = pa.array(np.repeat(np.arange(len(x)), size))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(each), pa.array(np.tile(np.arange(1, size + 1), len(x)), pa.int32()),
             pa.array(np.full(len(each), model.centre.n), pa.int64()),
             squares(model.centre.deviations(x)).take(each), pa.array(model.whitened(x).ravel()),
             pa.array(np.tile(model.values / model.trace, len(x)) if size else np.zeros(0)),
             pa.array(np.full(len(each), error))],
            names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(frame: DataFrame, *, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error) for each usable vector and component.

    Entries become floor(1024 * c) + 100000; the mean, exact sums of squared deviations (decimal) and the principal
    directions are those of all usable vectors. Not usable are null vectors, those with a null or not finite entry, empty
    ones, and those of another length than the most frequent one (of equally frequent ones the longest). Entries
    beyond 2**40 count as 2**40. Directions without spread have no component: fewer than `components` come back where
    vectors span fewer, none where all are equal. Ids may be null or repeat: each row stands for itself. Equal
    eigenvalues have some set of directions at right angles. An empty table gives no rows. Other columns play no part.
    Vectors are not shuffled: tasks hand on sums and one triangular matrix. Results depend on the dealing of the rows
    only by rounding.
    """
    entry = F.col("_vector")
    odd = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = frame.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_vector")).filter(
        (F.size(F.coalesce(entry, F.array())) > 0) & ~odd)
    kind = frame.schema[id_col].dataType.simpleString()
    common = usable.groupBy(F.size("_vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = common.dims if common else 1
    if dims > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {dims} entries; the solver takes {MOST_DIMENSIONS} at most")
    rows = usable.filter(F.size("_vector") == dims)
    model = fitted(rows, dims, components)
    schema = (f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    return arrow_map(rows, _rows, schema, model, identity_error(rows, model)).withColumnRenamed("id", id_col)


def op11_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))
