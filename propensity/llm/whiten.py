"""Embedding whitening by shifted CholeskyQR.

Entries become whole numbers, ``floor(scale * c) + offset``; rows are centred by the exact column sums. Each pass
over the rows adds up a Gram matrix (per task in numpy, rows of the matrix summed by Spark), the driver factors it,
and the next pass solves the rows against the triangular factors so far, until the solved rows are orthonormal. The
first factor is taken of the Gram matrix plus a shift, so that it exists for any condition of the data. The product
of the factors is the R of the centred rows; its singular value decomposition gives the components without squaring
the data's condition. Only d x d matrices and d sums ever reach the driver or the executors' closures.

A task's contribution is one row per dimension; they are summed in two steps (by task group, then in all), so no
task reads more than a share of them, and in a fixed order.

Edge cases: vectors that are null or hold null or non-finite entries take no part; empty vectors have no components;
a null id stays null; repeated rows count as often as they occur; vectors of different dimension are fitted apart;
whole numbers saturate at +-2^62; a component without variance has ``whitened`` null and ``explained`` 0; a
deviation beyond 64 bits is null; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import record_batch
from propensity.session import materialize

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
MAX_PASSES = 8
LIMIT = float(1 << 62)
EPS = float(np.finfo(np.float64).eps)
#: Components whose deviation is below this share of the first one's are without variance.
NOTHING = 1e-13
#: Squared length under which a solved direction counts as zero.
NO_LENGTH = 1e-14
TASK_GROUPS = 64

_ROWS = "vec_id long, x array<long>"
_SUMS = "i int, n long, high long, low long"
_SUMS_SCHEMA = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("high", pa.int64()), ("low", pa.int64())])
_PART = "task int, i int, line binary"
_PART_SCHEMA = pa.schema([("task", pa.int32()), ("i", pa.int32()), ("line", pa.binary())])
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double"
_OUT_SCHEMA = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                         ("whitened", pa.float64()), ("explained", pa.float64())])


def whole_vectors(embeddings: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x, dim): valid vectors as whole numbers."""
    c = F.transform("embedding", lambda e: e.cast("double"))
    fine = F.col("embedding").isNotNull() & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    x = F.transform(c, lambda e: F.floor(F.greatest(F.least(e * F.lit(float(scale)), F.lit(LIMIT)), F.lit(-LIMIT))).cast("long") + F.lit(offset))
    return embeddings.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), F.size("embedding").alias("dim"))


def matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


@dataclass(frozen=True)
class Centre:
    """Exact mean per dimension as whole part and remainder: S = whole * n + rest, 0 <= rest < n."""
    n: int
    whole: tuple[int, ...]
    rest: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, one rounding after the whole part is gone."""
        return (x - np.array(self.whole, np.int64)).astype(np.float64) - np.array(self.rest, np.float64) / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2, exact; None beyond 64 bits."""
        near = x - np.array(self.whole, np.int64)
        if x.size and (float(np.abs(near).max()) + 1) * self.n * np.sqrt(x.shape[1]) < 2.0 ** 31:
            return ((near * self.n - np.array(self.rest, np.int64)) ** 2).sum(1).tolist()
        values = [sum((self.n * int(a) - r) ** 2 for a, r in zip(row, self.rest)) for row in near]
        return [v if v < 1 << 63 else None for v in values]


def column_sums(rows: DataFrame, dim: int) -> Centre:
    """Exact sums of every dimension. Halves of 31 bits are summed apart, so no sum of a task overflows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            x = matrix(batch, dim)
            n += len(x)
            high += (x >> 31).sum(0)
            low += (x & ((1 << 31) - 1)).sum(0)
        if n:
            yield record_batch(_SUMS_SCHEMA, {"i": np.arange(dim), "n": np.full(dim, n), "high": high, "low": low})

    wide = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "high", "low")]
    found = rows.select("x").mapInArrow(add, _SUMS).groupBy("i").agg(*wide).orderBy("i").collect()  # d rows
    n = int(found[0]["n"])
    sums = [(int(r["high"]) << 31) + int(r["low"]) for r in found]
    return Centre(n, tuple(s // n for s in sums), tuple(s % n for s in sums))


def solve(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows @ inverse(upper) by forward substitution; a direction with a zero pivot becomes zero."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        left = rows[:, j] - out[:, :j] @ upper[:j, j] if j else rows[:, 0]
        out[:, j] = left / upper[j, j] if upper[j, j] else 0.0
    return out


def _summed(parts: DataFrame, width: int, key: str | None) -> DataFrame:
    """Sum ``line`` by (group of tasks, i), or by i when ``key`` is None, in the order of the tasks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, task = None, np.zeros(width), 0
        for batch in batches:
            for task_id, i, line in zip(*(batch.column(c).to_pylist() for c in ("task", "i", "line"))):
                at = (task_id % TASK_GROUPS if key else 0, i)
                if at != now:
                    if now is not None:
                        yield record_batch(_PART_SCHEMA, {"task": [task], "i": [now[1]], "line": [total.tobytes()]})
                    now, total, task = at, np.zeros(width), task_id % TASK_GROUPS
                total += np.frombuffer(line, np.float64)
        if now is not None:
            yield record_batch(_PART_SCHEMA, {"task": [task], "i": [now[1]], "line": [total.tobytes()]})

    group = [(F.col("task") % TASK_GROUPS).alias("g"), F.col("i")] if key else [F.col("i")]
    return parts.repartition(*group).sortWithinPartitions(*group, "task").select("task", "i", "line").mapInArrow(add, _PART)


def gram(rows: DataFrame, dim: int, turn: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of t'(1, t) with t = turn(row): the last column holds the sums of t."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width + 1)), False
        for batch in batches:
            t = turn(matrix(batch, dim))
            total[:, :width] += t.T @ t
            total[:, width] += t.sum(0)
            seen = True
        if seen:
            task = TaskContext.get().partitionId()
            yield record_batch(_PART_SCHEMA, {"task": np.full(width, task), "i": np.arange(width), "line": [r.tobytes() for r in total]})

    parts = rows.select("x").mapInArrow(add, _PART)
    found = _summed(_summed(parts, width + 1, "task"), width + 1, None).select("i", "line").collect()  # ``width`` rows
    out = np.zeros((width, width + 1))
    for r in found:
        out[r["i"]] = np.frombuffer(r["line"], np.float64)
    return out


def shifted_cholesky(g: np.ndarray, n: int, least: float) -> np.ndarray:
    """Upper factor of ``g`` plus the smallest shift that factors, from ``least`` times the customary one on."""
    d = len(g)
    unit = 11 * (n * d + d * (d + 1)) * EPS / 2 * float(np.abs(np.linalg.eigvalsh(g)).max())
    shift = least * unit
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, unit)


@dataclass(frozen=True)
class Fit:
    """Whitening of one dimension: components are columns of ``basis``, ``deviations`` are sqrt(e)."""
    dim: int
    centre: Centre
    basis: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray

    def whiten(self, x: np.ndarray) -> np.ndarray:
        safe = np.where(self.deviations > 0, self.deviations, np.inf)
        return self.centre.centred(x) @ self.basis / safe


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Fit:
    """Components of the (x) rows of one dimension by falling variance."""
    centre = column_sums(rows, dim)
    factors: list[np.ndarray] = []
    r = np.eye(dim)
    for k in range(MAX_PASSES):
        def turn(x: np.ndarray, factors: tuple = tuple(factors)) -> np.ndarray:
            q = centre.centred(x)
            for upper in factors:
                q = solve(q, upper)
            return q

        g = gram(rows, dim, turn, dim)[:, :dim]
        g = (g + g.T) / 2
        size, axes = np.linalg.eigh(g)
        if (k and np.all((np.abs(size - 1) < 1e-11) | (size < NO_LENGTH))) or not size[-1] > 0 or k == MAX_PASSES - 1:
            # Q'Q of the last pass as its symmetric root: exact also where a direction of Q is zero
            r = (np.sqrt(np.where(size < NO_LENGTH, 0.0, size)) * axes).T @ r
            break
        # no shift on rows that are nearly orthonormal: theirs is plain CholeskyQR
        factors.append(shifted_cholesky(g, centre.n, 1.0 if k == 0 else 0.0))
        r = factors[-1] @ r
    _, s, vt = np.linalg.svd(r / np.sqrt(centre.n))
    s = np.where(s > NOTHING * s[0], s, 0.0)
    top = vt[:components].T.copy()
    top *= np.where(top[np.abs(top).argmax(0), np.arange(top.shape[1])] < 0, -1.0, 1.0)  # one sign for all rows and runs
    total = float((s ** 2).sum())
    return Fit(dim, centre, top, s[:components], s[:components] ** 2 / total if total else np.zeros(min(components, dim)))


def identity_error(rows: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over components with variance."""
    width = len(model.deviations)
    g, n = gram(rows, model.dim, model.whiten, width), model.centre.n
    mean = g[:, width] / n
    off = np.abs(g[:, :width] / n - np.outer(mean, mean) - np.eye(width))
    live = model.deviations > 0
    return float(off[np.ix_(live, live)].max(initial=0.0))


def apply(rows: DataFrame, model: Fit) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained: a row per vector and component."""
    width = len(model.deviations)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, model.dim)
            m, values = len(x), model.whiten(x)
            far = model.centre.deviation(x)
            yield record_batch(_OUT_SCHEMA, {
                "vec_id": pa.array(batch.column("vec_id")).take(pa.array(np.repeat(np.arange(m), width))),
                "component": np.tile(np.arange(1, width + 1), m), "n": np.full(m * width, model.centre.n),
                "deviation": [v for v in far for _ in range(width)],
                "whitened": pa.array(values.reshape(-1), mask=np.tile(model.deviations == 0, m)),
                "explained": np.tile(model.explained, m)})

    return rows.select("vec_id", "x").mapInArrow(turn, _OUT)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Whitened vectors: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    vectors = materialize(whole_vectors(embeddings, scale, offset).where("dim > 0"))
    out = None
    for (dim,) in sorted(vectors.select("dim").distinct().collect()):  # a row per dimension that occurs
        rows = vectors.where(F.col("dim") == dim)
        model = fit(rows, dim, components)
        part = apply(rows, model).withColumn("identity_error", F.lit(identity_error(rows, model)))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], _OUT + ", identity_error double") if out is None else out
