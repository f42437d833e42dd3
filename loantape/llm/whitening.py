"""Whitening of vectors, with components from QDWH spectral divide and conquer.

Vectors are brought to a grid of whole numbers, each different one counting once. Their sums and
products about a whole number next to the mean are exact, wherever and in whatever order tasks add
them up, so the covariance is the correctly rounded one. It has a row and a column per dimension and
is all that reaches the driver. There the polar factor of the covariance less a shift, found by the
dynamically weighted Halley iteration, gives the projector on the components above the shift. The
covariance is cut to that subspace and its complement, and both are split again, until every
component that is asked for stands alone. Mean and components are broadcast to whiten the rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loantape.llm.store import prepare, stored

EPS = np.finfo(np.float64).eps
POLAR_ROUNDS = 40
# Tasks whose sums are added up in one group, before the groups' sums are.
FAN = 64
# Components with less than this share of the largest variance are rounding, not variance.
NO_VARIANCE = 1e-13
SUMS = pa.schema([("dims", pa.int32()), ("i", pa.int32()), ("task", pa.int32()), ("n", pa.int64()), ("sums", pa.binary())])
SUMS_SQL = "dims int, i int, task int, n bigint, sums binary"


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix; eigenvalues that are zero stay so."""
    x = a / max(np.linalg.norm(a, 2), np.finfo(np.float64).tiny)
    low, one = EPS, np.eye(len(a))
    for _ in range(POLAR_ROUNDS):
        low2 = low * low
        d = np.cbrt(4 * (1 - low2) / (low2 * low2))
        root = np.sqrt(1 + d)
        p = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low2) / (low2 * root))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        # The step's inverse through a QR factorisation, which no conditioning spoils.
        both, _ = np.linalg.qr(np.vstack([math.sqrt(r) * x, one]))
        after = (q / r) * x + (p - q / r) / math.sqrt(r) * both[: len(a)] @ both[len(a) :].T
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - x)
        x, low = after, min(1.0, low * (p + q * low2) / (1 + r * low2))
        if moved <= 10 * EPS * len(a) and low >= 1 - 10 * EPS:
            break
        if low >= 1 - 10 * EPS and moved <= np.cbrt(EPS) / 10:
            break
        low = min(low, 1 - EPS)
    return x


def _orthonormal(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Bases of a projector's range and of its complement: its longest columns, then what is left of
    the others, brought to right angles, once more through the projector."""
    left, chosen = projector.copy(), []
    for _ in range(rank):
        at = int(np.argmax((left * left).sum(0)))
        v = left[:, at] / np.linalg.norm(left[:, at])
        chosen.append(v)
        left -= np.outer(v, v @ left)
    start = projector @ np.array(chosen).T
    whole, _ = np.linalg.qr(np.hstack([start, np.eye(len(projector))]))
    return whole[:, :rank], whole[:, rank:]


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Where to cut: the middle of the diagonal first, then between the extremes, ever finer."""
    values = np.sort(np.diag(a))
    spread = max(np.linalg.norm(a - values.mean() * np.eye(len(a)), 2), EPS)
    yield float((values[(len(a) - 1) // 2] + values[len(a) // 2]) / 2)
    yield float(values.mean())
    for n in (4, 16, 64, 256):
        for k in range(1, n):
            yield float(values.mean() + spread * (2 * k / n - 1) * 0.999)


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces, the one of larger eigenvalues first; ``None`` if all
    eigenvalues are alike to rounding."""
    one, size = np.eye(len(a)), np.linalg.norm(a, 2)
    if np.linalg.norm(a - np.trace(a) / len(a) * one, 2) <= 4 * EPS * len(a) * size:
        return None
    best = None
    for shift in _shifts(a):
        projector = (polar(a - shift * one) + one) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < len(a):
            continue
        up, down = _orthonormal(projector, rank)
        lost = np.linalg.norm(up.T @ a @ down, 2)
        if best is None or lost < best[0]:
            best = lost, up, down
        if lost <= 8 * EPS * math.sqrt(len(a)) * size:
            break
    return best[1:] if best else None


def eigen(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as
    columns. Subspaces that hold none of them are not split any further."""
    found: list[tuple[float, np.ndarray]] = []
    todo = [(a, np.eye(len(a)))]
    while todo and len(found) < wanted:
        part, basis = todo.pop()
        pair = _split(part) if len(part) > 1 else None
        if pair is None:
            found += [(float(part[i, i]), basis[:, i]) for i in range(len(part))]
            continue
        for side in reversed(pair):
            below = side.T @ part @ side
            todo.append(((below + below.T) / 2, basis @ side))
    values, vectors = [], []
    for _, v in found:
        v = v / np.linalg.norm(v)
        values.append(float(v @ a @ v))
        vectors.append(v)
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return np.array(values)[order], np.array(vectors).T[:, order]


@dataclass
class Model:
    """How vectors of one length are whitened. ``centre`` and ``rest`` are the mean's whole number and
    the sums about it; ``weights`` has a component divided by its standard deviation per column."""

    n: int
    centre: np.ndarray
    rest: list[int]
    weights: np.ndarray
    explained: np.ndarray

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """Rows less the mean; the whole part leaves without rounding."""
        return (rows - self.centre).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def deviations(self, rows: np.ndarray) -> pa.Array:
        """Exact sums of (n * x - S) ** 2; null beyond 63 bits."""
        z = rows - self.centre
        top, rest = int(np.abs(z).max(initial=0)), max(map(abs, self.rest), default=0)
        kind = np.int64 if len(self.rest) * (self.n * top + rest) ** 2 < 1 << 63 else object
        by_n = z.astype(kind) * self.n - np.array(self.rest, kind)
        sums = (by_n * by_n).sum(1)
        return pa.array(sums if kind is np.int64 else [int(x) if x < 1 << 63 else None for x in sums], pa.int64())


def by_length(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of each length, as places and a matrix; null components are NaN."""
    lengths = np.asarray(column.value_lengths())
    values = column.flatten()
    if values.null_count:
        values = pc.fill_null(values.cast(pa.float64()), math.nan)
    values = values.to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    for dims in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dims)
        if len(at) == len(lengths):
            yield at, values.reshape(len(at), dims)
        else:
            yield at, values[(ends[at] - dims)[:, None] + np.arange(dims)]


def on_grid(rows: np.ndarray, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows can be kept, and the whole numbers of those."""
    with np.errstate(invalid="ignore", over="ignore"):
        made = np.floor(scale * rows.astype(np.float64))
        kept = (np.abs(made) < float(1 << 61)).all(1)
    return kept, made[kept].astype(np.int64) + offset


def _lists(rows: np.ndarray) -> pa.ListArray:
    n, dims = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * dims, dims, dtype=np.int32) if dims else np.zeros(n + 1, np.int32)), pa.array(rows.ravel()))


def _sums(centres: dict[int, np.ndarray] | None):
    """Per task, length and dimension the exact sums of rows, or of products about the centres."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        kept: dict[int, list] = {}
        for batch in batches:
            for _, z in by_length(batch.column(0)):
                rows, dims = z.shape
                if centres is None:
                    small = int(np.abs(z).max(initial=0)) * rows < 1 << 62
                    made = (z if small else z.astype(object)).sum(0)[None, :]
                else:
                    z = z - centres[dims]
                    top = int(np.abs(z).max(initial=0))
                    if top * top * rows < 1 << 53:
                        f = z.astype(np.float64)
                        made = (f.T @ f).astype(np.int64)
                    else:
                        z = z.astype(object)
                        made = z.T @ z
                held = kept.setdefault(dims, [0, 0])
                held[0] += rows
                held[1] = held[1] + made.astype(object)
        for dims, (n, made) in kept.items():
            for i in range(len(made)):
                row = (dims, i, task, n, pickle.dumps(made[i].tolist()))
                yield pa.record_batch([pa.array([x], f.type) for x, f in zip(row, SUMS)], schema=SUMS)

    return run


def _added(key: tuple, rows: pa.Table) -> pa.Table:
    total = [0] * len(pickle.loads(rows["sums"][0].as_py()))
    for one in rows["sums"]:
        total = [a + b for a, b in zip(total, pickle.loads(one.as_py()))]
    made = (rows["dims"][0].as_py(), rows["i"][0].as_py(), min(rows["task"].to_pylist()) // FAN, sum(rows["n"].to_pylist()), pickle.dumps(total))
    return pa.table([pa.array([x], f.type) for x, f in zip(made, SUMS)], schema=SUMS)


def _totals(fitted: DataFrame, centres: dict[int, np.ndarray] | None) -> dict[int, tuple[int, list[list[int]]]]:
    """Per length the number of rows and the sums by dimension, added up in groups of tasks."""
    sums = fitted.select("x").mapInArrow(_sums(centres), SUMS_SQL)
    sums = sums.groupBy("dims", "i", F.floor(F.col("task") / FAN)).applyInArrow(_added, SUMS_SQL)
    sums = sums.groupBy("dims", "i").applyInArrow(_added, SUMS_SQL)
    out: dict[int, tuple[int, list]] = {}
    for row in sorted(sums.collect(), key=lambda r: (r.dims, r.i)):
        out.setdefault(row.dims, (row.n, []))[1].append(pickle.loads(row.sums))
    return out


def fit(fitted: DataFrame, components: int) -> dict[int, Model]:
    """A model per length of the vectors ``x``, each of which counts once."""
    models = {}
    sums = {d: (n, s[0]) for d, (n, s) in _totals(fitted.where(F.size("x") > 0), None).items()}
    centres = {d: np.array([round(Fraction(x, n)) for x in s], np.int64) for d, (n, s) in sums.items()}
    for dims, (n, products) in _totals(fitted.where(F.size("x") > 0), centres).items():
        rest = [s - n * int(c) for s, c in zip(sums[dims][1], centres[dims])]
        # (n * M - r r') / n ** 2 in whole numbers, rounded once.
        covariance = np.array([[(n * m - a * b) / (n * n) for m, b in zip(row, rest)] for row, a in zip(products, rest)])
        trace = float(np.trace(covariance))
        values, vectors = eigen(covariance, min(components, dims))
        real = values > NO_VARIANCE * trace if trace > 0 else np.zeros(len(values), bool)
        values, vectors = values[real], vectors[:, real]
        models[dims] = Model(n, centres[dims], rest, vectors / np.sqrt(values), values / trace if trace > 0 else values)
    return models


def _whitened_products(shared):
    """Per task and length: rows, sums and products of whitened rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}
        for batch in batches:
            for _, rows in by_length(batch.column(0)):
                model = shared.value[rows.shape[1]]
                y = model.centred(rows) @ model.weights
                held = kept.setdefault(rows.shape[1], [np.zeros(y.shape[1]), np.zeros((y.shape[1], y.shape[1]))])
                held[0] += y.sum(0)
                held[1] += y.T @ y
        dims = [d for d, h in kept.items() for _ in range(len(h[0]) * (len(h[0]) + 1))]
        values = [x for h in kept.values() for x in np.vstack([h[0][None, :], h[1]]).ravel()]
        places = [i for h in kept.values() for i in range(len(h[0]) * (len(h[0]) + 1))]
        yield pa.record_batch([pa.array(dims, pa.int32()), pa.array(places, pa.int32()), pa.array(values, pa.float64())], ["dims", "place", "value"])

    return run


def identity_error(fitted: DataFrame, models: dict[int, Model], shared) -> float:
    """The largest absolute entry of the covariance of the whitened fit list less the identity."""
    parts = fitted.where(F.size("x") > 0).select("x").mapInArrow(_whitened_products(shared), "dims int, place int, value double")
    worst, found = 0.0, {}
    for row in parts.groupBy("dims", "place").agg(F.sum("value").alias("value")).collect():
        found.setdefault(row.dims, {})[row.place] = row.value
    for dims, values in found.items():
        k, n = models[dims].weights.shape[1], models[dims].n
        made = np.array([values[i] for i in range(k * (k + 1))]).reshape(k + 1, k) / n
        worst = max(worst, float(np.abs(made[1:] - np.outer(made[0], made[0]) - np.eye(k)).max(initial=0.0)))
    return worst


def whiten(
    vectors: DataFrame,
    components: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and
    ``identity_error`` per row of ``vectors`` and component, numbered from 1 by falling variance.

    A vector's components ``c`` become the whole numbers ``floor(scale * c) + offset``. Each
    different vector is fitted once; ``n`` is their number and all covariances are theirs.
    ``deviation`` is the exact sum of ``(n * x - S) ** 2`` over the dimensions, null if it does not fit
    in a long. ``explained`` is the component's share of the variance and ``identity_error`` how far
    the covariance of the whitened fit list is from the identity at most, one figure for all rows.

    Rows whose vector is null or has a null, a non-finite or a component that is beyond a long on the
    grid are dropped. Rows with a null or repeated id each give their rows. Vectors of each length
    are a space of their own with a model of their own; vectors without components have no row.
    Components without variance, as with one vector only or more dimensions than vectors, cannot be
    whitened and have no row either. An empty table gives an empty table.
    """
    spark: SparkSession = prepare(vectors.sparkSession)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows in by_length(batch.column(1)):
                kept, made = on_grid(rows, scale, offset)
                yield pa.record_batch([batch.column(0).take(pa.array(at[kept])), _lists(made)], ["vec_id", "x"])

    given = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector"))
    rows = stored(given.where("vector is not null").mapInArrow(place, "vec_id bigint, x array<bigint>"), "grid")
    fitted = stored(rows.select("x").distinct(), "fitted")
    models = fit(fitted, components)
    shared = spark.sparkContext.broadcast(models)
    error = identity_error(fitted, models, shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in by_length(batch.column(1)):
                model = shared.value[x.shape[1]]
                y, k = model.centred(x) @ model.weights, model.weights.shape[1]
                each = np.repeat(np.arange(len(at)), k)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(at[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(each), model.n)), model.deviations(x).take(pa.array(each)),
                        pa.array(y.ravel()), pa.array(np.tile(model.explained, len(at))), pa.array(np.full(len(each), error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.where(F.size("x") > 0).mapInArrow(
        run, "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
