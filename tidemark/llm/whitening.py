"""Whitening of embeddings by the leading eigenvectors of their covariance.

Sums, covariance and the check of the result are added up over partitions; what reaches the driver is
a row of sums and the covariance, whose size is that of one vector squared, whatever the number of rows. The
spectrum is cut into intervals by inertia counts, and each interval is a task of its own that
integrates along its contour (see ``feast``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import feast
from tidemark.session import ship


@dataclass(frozen=True)
class Whitening:
    """An entry c becomes floor(``scale`` * c) + ``shift``; the ``components`` greatest are taken."""

    components: int = 8
    scale: int = 1024
    shift: int = 100_000


def vectors(batch: pa.RecordBatch, plan: Whitening) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer vectors of the usable rows of a batch, for each length of vector."""
    column = batch.column("vector")
    usable = column.is_valid().to_numpy(zero_copy_only=False)
    lens = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten()  # leaves out what stands behind nulls
    entries = values.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64)
    start = np.cumsum(lens) - lens
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    usable = usable & (lens > 0) & (bad[start + lens] == bad[start])
    for size in np.unique(lens[usable]).tolist():
        rows = np.nonzero(usable & (lens == size))[0]
        part = np.floor(plan.scale * entries[start[rows][:, None] + np.arange(size)])
        if np.abs(part).max() >= 1 << 52:
            raise ValueError("an entry of a vector is too large to become a whole number exactly")
        yield rows, part.astype(np.int64) + plan.shift


def _added(rows: DataFrame, made: Callable[[Iterator[pa.RecordBatch]], dict[int, np.ndarray]], kind: str) -> dict[int, np.ndarray]:
    """Arrays that tasks make, by key, added up: once for each task, then once for each key."""
    kinds = {"long": pa.int64(), "double": pa.float64()}

    def out(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for key, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([x.tolist()], pa.list_(kinds[kind]))], ["key", "sums"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, x in zip(batch.column("key").to_pylist(), batch.column("sums")):
                x = x.values.to_numpy()
                sums[key] = sums[key] + x if key in sums else x
        return out(sums)

    schema = f"key int, sums array<{kind}>"
    parts = rows.mapInArrow(lambda batches: out(made(batches)), schema)
    return {r["key"]: np.array(r["sums"]) for r in parts.repartition("key").mapInArrow(total, schema).collect()}


def _eigen(rows: DataFrame, covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues and their eigenvectors as columns; intervals are solved side by side."""
    spark = rows.sparkSession
    pieces = feast.intervals(covariance, components)
    if not pieces:
        return np.zeros(0), np.zeros((len(covariance), 0))
    shared = spark.sparkContext.broadcast(covariance)  # one vector squared

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, found = feast.eigenpairs(shared.value, row["lo"], row["hi"], row["count"])
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(found.T.tolist(), pa.list_(pa.float64()))], ["value", "vector"])

    solved = spark.createDataFrame(pieces, "lo double, hi double, count long").repartition(len(pieces)).mapInArrow(
        solve, "value double, vector array<double>").collect()
    shared.unpersist()
    # One more Rayleigh-Ritz over all intervals makes vectors of neighbouring intervals orthogonal.
    basis = np.linalg.qr(np.array([r["vector"] for r in solved]).T)[0]
    values, turns = np.linalg.eigh(basis.T @ covariance @ basis)
    by = np.argsort(-values, kind="stable")[:components]
    return values[by], basis @ turns[:, by]


def whitened(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", plan: Whitening = Whitening()) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    Rows whose vector is null or holds null or non-finite entries are left out, as are vectors without
    entries and vectors of another length than most have (of lengths equally common the greater counts).
    All others are fitted and returned, repeated rows and null ids too, one row for each component. Directions
    without variance have no component; an empty table and equal vectors give no row. Extra columns
    are left out. A ``deviation`` beyond 64 bits and an entry beyond 2^52 are errors.
    """
    ship(rows.sparkSession)
    chosen = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    only = chosen.select("vector")

    def first(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in vectors(batch, plan):
                part = np.concatenate([[len(x)], x.sum(axis=0)])
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + part
        return sums

    id_type = chosen.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sums = _added(only, first, "long")
    if not sums:
        return rows.sparkSession.createDataFrame([], schema)
    size = max(sums, key=lambda d: (sums[d][0], d))
    n, total = int(sums[size][0]), sums[size][1:]
    mean = total / n

    def fitted(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return ((k, x) for k, x in vectors(batch, plan) if x.shape[1] == size)

    def second(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        products = np.zeros((size, size))
        for batch in batches:
            for _, x in fitted(batch):
                y = x - mean
                products += y.T @ y
        return dict(enumerate(products))

    products = _added(only, second, "double")
    covariance = np.array([products[k] for k in range(size)]) / n
    covariance = (covariance + covariance.T) / 2
    values, components = _eigen(rows, covariance, plan.components)
    turn = components / np.sqrt(values)
    explained = values / np.trace(covariance) if len(values) else values

    def third(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        got = np.zeros((len(values) + 1, len(values)))
        for batch in batches:
            for _, x in fitted(batch):
                y = (x - mean) @ turn
                got[:-1] += y.T @ y
                got[-1] += y.sum(axis=0)
        return dict(enumerate(got))

    if not len(values):
        return rows.sparkSession.createDataFrame([], schema)
    moments = _added(only, third, "double")
    centre = moments[len(values)] / n
    spread = np.array([moments[k] for k in range(len(values))]) / n - np.outer(centre, centre)
    error = float(np.abs(spread - np.eye(len(values))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            for at, x in fitted(batch):
                y = x - mean
                if (n * float(np.abs(y).max())) ** 2 * size < 2.0 ** 62:
                    off = n * x - total
                    deviation = pa.array((off * off).sum(axis=1))
                else:
                    deviation = pa.array([sum((n * v - s) ** 2 for v, s in zip(row, total.tolist())) for row in x.tolist()], pa.int64())
                y = y @ turn
                spot = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(at)).take(spot), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(spot), n, np.int64)), deviation.take(spot), pa.array(y.ravel()),
                     pa.array(np.tile(explained, len(x))), pa.array(np.full(len(spot), error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return chosen.mapInArrow(run, schema)
