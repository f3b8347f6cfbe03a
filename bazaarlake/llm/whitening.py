"""Whitening of embeddings along the leading components of their covariance.

Entries become integers (``floor(64 * c) + 1000000``). The fit list holds each distinct integer vector once; its sums are exact, and
its covariance is summed on Spark from blocks that are centred before they are multiplied. The covariance, one matrix of the
vectors' length squared, is solved on the driver in mixed precision: float32 eigenvectors are corrected by the iteration of Ogita and
Aishima, whose matrix products run in extended precision and whose error squares with every round. Eigenvalues that lie
closer together than the iteration can part are turned within their cluster by a small solve of their own.

Defined cases: vectors that are null, empty or hold null, non-finite or unrepresentable entries (``LARGEST`` or more) are left out, and so
are vectors whose length is not the most frequent one (ties: the longer). A null ``vec_id`` is kept. Repeated rows each get their
result and count once in the fit. Components without variance, as in a list of one vector, have no unit scale and are not
returned. Without vectors there are no rows. Squared deviations beyond 64 bits are null. Columns beside the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.storage import store

SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this don't become integers whose sums are exact.
LARGEST = 2.0**40
COMPONENTS = 16
#: Rows of one matrix product in a task.
BLOCK = 8192
ROUNDS = 30
#: Eigenvalues closer than this part of the matrix's size are a cluster, however small the residuals.
CLUSTER = 1e-10


# --- symmetric eigenvectors -----------------------------------------------------------------------


def _close_runs(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Index sets of eigenvalues that form clusters: neighbours no further apart than ``apart``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def refine(matrix: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of a symmetric matrix from approximate eigenvectors, to double precision.

    Each round takes R = I - X'X and S = X'AX and corrects X by X E with E_ij = (S_ij + w_j R_ij) / (w_j - w_i); where w_j and w_i are
    closer than the residuals allow to tell, E_ij = R_ij / 2 keeps X orthogonal, and X'AX of the cluster, shifted by its middle, is
    solved by itself.
    """
    a, x = matrix.astype(np.longdouble), start.astype(np.longdouble)
    n = len(a)
    size = float(np.sqrt((a * a).sum())) or 1.0
    best = np.inf
    for _ in range(rounds):
        r = np.eye(n, dtype=np.longdouble) - x.T @ x
        s = x.T @ (a @ x)
        w = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(w)
        off_size, r_size = float(np.sqrt((off * off).sum())), float(np.sqrt((r * r).sum()))
        apart = max(2 * (off_size + size * r_size), CLUSTER * size)
        gap = w[None, :] - w[:, None]
        near = np.abs(gap) <= apart
        e = np.where(near, r / 2, (s + w[None, :] * r) / np.where(near, 1, gap))
        # E + E' = R holds by construction; taken so, rounding over small gaps leaves X orthogonal.
        e = np.triu(e) + np.tril(r - e.T, -1)
        x = x + x @ e
        for run in _close_runs(w.astype(float), apart):
            part, middle = x[:, run], w[run].mean()
            inner = part.T @ (a @ part) - middle * (part.T @ part)
            x[:, run] = part @ np.linalg.eigh(((inner + inner.T) / 2).astype(float))[1].astype(np.longdouble)
        moved = off_size / size + r_size
        if moved >= best / 2 and moved < 1e-14:
            break
        best = min(best, moved)
    ax = a @ x
    w = (x * ax).sum(axis=0) / (x * x).sum(axis=0)
    order = np.argsort(-w.astype(float), kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    # Either sign is right; this one doesn't change from run to run.
    top = np.abs(x.astype(float)).round(9).argmax(axis=0)
    return w[order].astype(float), (x * np.sign(x[top, np.arange(n)])).astype(float)


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) by falling value: float32 eigenvectors, refined."""
    scale = float(np.abs(matrix).max()) or 1.0
    _, start = np.linalg.eigh((matrix / scale).astype(np.float32))
    values, vectors = refine(matrix / scale, start)
    return values * scale, vectors


# --- the fit --------------------------------------------------------------------------------------


def integers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(``key``, ``x``) of the rows that take part: the vector's entries as integers."""

    def usable(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)

    c = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).alias(key), c.alias("c")).where((F.size("c") > 0) & F.forall("c", usable))
    return rows.select(key, F.transform("c", lambda v: F.floor(v * SCALE) + SHIFT).alias("x"))


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``n`` vectors with sums ``sums``; ``vectors`` has a unit column per component."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def _rows(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """``n * x - S`` as exact integers and ``x - S / n``; the whole part of the mean goes first, so that little is left to round."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    left = x - whole
    small = not left.size or int(np.abs(left).max()) < (1 << 61) // n
    exact = left * n - rest if small else left.astype(object) * n - rest.astype(object)
    return exact, left - rest / n


def _second_moments(fit: DataFrame, n: int, sums: tuple[int, ...], onto: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the centred fit list, or of its projection on the columns of ``onto``; divisor ``n``.

    Tasks multiply blocks of rows; their matrices are added entry by entry in a shuffle, so the driver gets one matrix.
    """
    length = len(sums)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for low in range(0, len(batch), BLOCK):
                _, centred = _centred(_rows(batch.column(0).slice(low, BLOCK), length), n, sums)
                centred = centred if onto is None else centred @ onto
                product = centred.T @ centred
                total = product if total is None else total + product
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "v"])

    parts = fit.select("x").mapInArrow(multiply, "i long, j long, v double")
    wide = length if onto is None else onto.shape[1]
    out = np.zeros((wide, wide))
    for row in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        out[row.i, row.j] = out[row.j, row.i] = row.v / n
    return out


def _common_length(rows: DataFrame) -> int | None:
    # One row per distinct length.
    found = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return found and found["length"]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of integer vectors (``x``); None without any."""
    length = _common_length(rows)
    if length is None:
        return None
    distinct = store(rows.where(F.size("x") == length).select("x").distinct(), "fit_list")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(0), length)
            sums = x.sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(length)), pa.array(np.full(length, len(x))), pa.array(sums)], ["i", "n", "s"]
            )

    places = distinct.mapInArrow(add, "i long, n long, s long").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    places = places.orderBy("i").collect()  # one row per dimension
    n, sums = places[0].n, tuple(p.s for p in places)
    covariance = _second_moments(distinct, n, sums)
    trace = float(np.trace(covariance))
    values, vectors = eigen(covariance)
    # A component has variance if it stands out from the rounding of the covariance.
    kept = int((values[:components] > trace * length * np.finfo(float).eps * 4).sum())
    values, vectors = values[:kept], vectors[:, :kept]
    if not kept:
        return Whitening(n, sums, values, vectors, trace, 0.0)
    scaled = vectors / np.sqrt(values)
    error = float(np.abs(_second_moments(distinct, n, sums, scaled) - np.eye(kept)).max())
    return Whitening(n, sums, values, vectors, trace, error)


def whiten(rows: DataFrame, model: Whitening, key: str = "vec_id") -> DataFrame:
    """(``key``, ``deviation``, ``whitened``) of integer vectors: exact squared deviation, one value per component."""
    length = len(model.sums)
    n, sums, scaled = model.n, model.sums, model.vectors / np.sqrt(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), BLOCK):
                some = batch.slice(low, BLOCK)
                exact, centred = _centred(_rows(some.column(1), length), n, sums)
                if exact.dtype != object and length * float(np.abs(exact).max()) ** 2 < 2**62:
                    deviation = pa.array((exact * exact).sum(axis=1))
                else:
                    squares = [sum(int(v) ** 2 for v in row) for row in exact]
                    deviation = pa.array([s if s < 1 << 63 else None for s in squares], pa.int64())
                flat = pa.array((centred @ scaled).ravel())
                offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * scaled.shape[1])
                whitened = pa.ListArray.from_arrays(offsets, flat)
                yield pa.RecordBatch.from_arrays([some.column(0), deviation, whitened], [key, "deviation", "whitened"])

    wanted = rows.where(F.size("x") == length).select(key, "x")
    kind = dict(wanted.dtypes)[key]
    return wanted.mapInArrow(project, f"`{key}` {kind}, deviation long, whitened array<double>")


def whitened_components(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component, with the figures of the fit."""
    rows = integers(vectors)
    model = fit(rows, components)
    if model is None or not len(model.values):
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    long = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
