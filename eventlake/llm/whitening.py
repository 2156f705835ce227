"""Whitening of vectors: blockwise QR, a bidiagonal form, dqds singular values, directions by twisted factorisations.

Vectors are taken as whole numbers x = floor(256 * c). The fit counts each
distinct x once, so a vector that a third of all rows hold weighs as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.llm.tables import with_fields, written

SCALE = 256
COMPONENTS = 4
#: Rows of a QR block; its memory is this by the vectors' length.
BLOCK_ROWS = 4096
#: Triangles that are stacked to one in a step of the tree.
FAN_IN = 32

EPS = float(np.finfo(float).eps)
#: Stands in for a pivot that is zero, in a matrix of size one.
NO_PIVOT = EPS**2
#: Squared couplings below this share of what they couple are no couplings.
NO_COUPLING = (10 * EPS) ** 2
#: Squared singular values nearer than this share of the largest need their vectors made orthogonal.
CLUSTER = 1e-3
SUMS = "dims int, place int, total decimal(38,0)"
TRIANGLES = "node int, row array<double>"
PRODUCTS = "dims int, place int, total double"
WHITENED = "component int, n long, deviation long, whitened double, explained double, identity_error double"


# Numerics of one small matrix


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V of the bidiagonal form U' r V of a square matrix, by Householder reflections."""
    m = np.array(r, float)
    d = len(m)
    right = np.eye(d)
    for k in range(d):
        _reflect(m[k:, k:], None)
        if k < d - 2:
            _reflect(m[k:, k + 1 :].T, right[:, k + 1 :].T)
    return np.diagonal(m).copy(), np.diagonal(m, 1).copy(), right


def _reflect(m: np.ndarray, kept: np.ndarray | None) -> None:
    """The reflection that leaves only the first entry of m's first column, applied to m and to `kept`, in place."""
    v = m[:, 0].copy()
    size = np.abs(v).max(initial=0.0)
    if size == 0 or not v[1:].any():
        return
    v /= size
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    v /= np.linalg.norm(v)
    for each in (m,) if kept is None else (m, kept):
        each -= np.outer(2 * v, v @ each)
    m[1:, 0] = 0.0


def blocks(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Ranges between superdiagonal entries that are nothing beside their neighbours."""
    cuts = np.flatnonzero(np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:]))) + 1
    return list(zip([0, *cuts], [*cuts, len(a)], strict=True))


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values, falling, of the upper bidiagonal matrix of diagonal a and superdiagonal b.

    Differential quotient-difference steps with shifts: they only add, multiply
    and divide positive numbers, so small values are as accurate as large ones.
    """
    size = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if size == 0:
        return np.zeros(len(a))
    squares = []
    waiting = [([float(x) ** 2 for x in a / size], [float(x) ** 2 for x in b / size], 0.0)]
    steps = 200 * len(a) + 200
    while waiting:
        q, e, taken = waiting.pop()
        n = len(q)
        if n == 1:
            squares.append(q[0] + taken)
            continue
        cut = next((k for k in range(n - 1) if e[k] <= NO_COUPLING * (taken + min(q[k], q[k + 1]))), None)
        if cut is not None:
            waiting += [(q[: cut + 1], e[:cut], taken), (q[cut + 1 :], e[cut + 1 :], taken)]
            continue
        steps -= 1
        if steps < 0:
            raise ArithmeticError("the singular values did not settle")
        if q[0] < q[-1]:
            q, e = q[::-1], e[::-1]  # the least ones come off at the end
        shift = _shift(q, e)
        for tried in (shift, shift / 4, 0.0):
            after = _step(q, e, tried)
            if after is not None:
                waiting.append((*after, taken + tried))
                break
    return size * np.sqrt(np.sort(np.array(squares))[::-1])


def _shift(q: list[float], e: list[float]) -> float:
    """Near the least eigenvalue: that of the last two rows, less what couples them to the rest."""
    x, y, off = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = (x - y) / 2
    root = float(np.hypot(half, off**0.5))
    least = y - off / (half + root) if half > 0 else (x + y) / 2 - root
    tilt = least - y
    weight = tilt * tilt / (tilt * tilt + off) if off else 0.0
    coupling = (weight * (q[-3] * e[-2] if len(q) > 2 else 0.0)) ** 0.5
    return max(least - coupling, 0.0)


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One step; none if the shift is above the least eigenvalue."""
    out_q, out_e = [], []
    d = q[0] - shift
    for above, coupling in zip(q[1:], e, strict=True):
        if d < 0:
            return None
        total = d + coupling
        ratio = above / total
        out_q.append(total)
        out_e.append(coupling * ratio)
        d = d * ratio - shift
    return None if d < 0 else ([*out_q, d], out_e)


class Twisted:
    """Factorisations of B'B - value from both ends, met at the row where they fit best."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float) -> None:
        n = len(a)
        squares, sides, between = (a * a).tolist(), (b * b).tolist(), (a[:-1] * b).tolist()
        self.down, self.down_pivot, s = [0.0] * (n - 1), [0.0] * n, -value
        states = [s]
        for i in range(n - 1):
            pivot = squares[i] + s or NO_PIVOT
            self.down[i], self.down_pivot[i] = between[i] / pivot, pivot
            s = sides[i] * (s / pivot) - value
            states.append(s)
        self.up, self.up_pivot, p = [0.0] * (n - 1), [0.0] * n, squares[-1] - value
        self.twist = [0.0] * n
        self.twist[-1] = states[-1] + p + value
        for i in range(n - 2, -1, -1):
            pivot = sides[i] + p or NO_PIVOT
            self.up[i], self.up_pivot[i + 1] = between[i] / pivot, pivot
            p = squares[i] * (p / pivot) - value
            self.twist[i] = states[i] + p + value
        self.rows = sorted(range(n), key=lambda i: abs(self.twist[i]))

    def vector(self, at: int) -> np.ndarray:
        """Unit vector that the factorisation met at row `at` sends nearest to nothing."""
        z = np.zeros(len(self.twist))
        z[at] = 1.0
        self._spread(z, at)
        return z / np.linalg.norm(z)

    def _spread(self, z: np.ndarray, at: int) -> None:
        for i in range(at - 1, -1, -1):
            z[i] -= self.down[i] * z[i + 1]
        for i in range(at, len(z) - 1):
            z[i + 1] -= self.up[i] * z[i]

    def solve(self, z: np.ndarray) -> np.ndarray:
        """Direction of the solution of (B'B - value) y = z."""
        at, y = self.rows[0], z.copy()
        for i in range(at):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(len(y) - 2, at - 1, -1):
            y[i] -= self.up[i] * y[i + 1]
        y[:at] /= self.down_pivot[:at]
        y[at + 1 :] /= self.up_pivot[at + 1 :]
        y[at] /= self.twist[at] or NO_PIVOT
        self._spread(y, at)
        return y / np.linalg.norm(y)


def leading(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """All singular values of r, falling, and the right singular vectors (columns) of the first ones that are not rounding."""
    a, b, right = bidiagonal(r)
    found = []
    for start, end in blocks(a, b):
        found += [(float(s), start, end) for s in dqds(a[start:end], b[start : end - 1])]
    found.sort(key=lambda each: (-each[0], each[1]))
    values = np.array([s for s, *_ in found])
    least = 8 * len(r) * EPS * values[0] if len(values) else 0.0
    chosen: list[tuple[float, int, np.ndarray]] = []
    for value, start, end in found[:components]:
        if value <= least:
            break
        near = [v for s, at, v in chosen if at == start and abs(s * s - value * value) <= CLUSTER * values[0] ** 2]
        chosen.append((value, start, _vector(a[start:end], b[start : end - 1], value * value, near)))
    vectors = np.zeros((len(r), len(chosen)))
    for k, (_, start, v) in enumerate(chosen):
        vectors[start : start + len(v), k] = v
    vectors = right @ vectors
    return values, vectors / np.linalg.norm(vectors, axis=0, keepdims=True)


def _vector(a: np.ndarray, b: np.ndarray, value: float, near: list[np.ndarray]) -> np.ndarray:
    """Eigenvector of B'B at `value`, orthogonal to the `near` ones."""
    size = max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    twisted = Twisted(a / size, b / size, value / size**2)
    if not near:
        return twisted.vector(twisted.rows[0])

    def apart(z: np.ndarray) -> np.ndarray:
        for v in (*near, *near):
            z = z - (v @ z) * v
        return z

    # inverse iteration from the unit vector that has most outside of the near ones
    rest = np.eye(len(a)) - sum(np.outer(v, v) for v in near)
    z = apart(rest[:, int(np.argmax(np.diagonal(rest)))])
    for _ in range(4):
        z = apart(twisted.solve(z / np.linalg.norm(z)))
        z /= np.linalg.norm(z)
    return z


# The same over a table


@dataclass(frozen=True)
class Whitening:
    """What the rows of one length share; `directions` are unit vectors over the square roots of `variances`."""

    n: int
    sums: list[int]
    directions: np.ndarray
    explained: list[float]
    identity_error: float


def whole_numbers(vector: str) -> Column:
    """floor(256 * c) of each component of a sound vector; one beyond 2**62 is an error."""

    def whole(c: Column) -> Column:
        scaled = c.cast("double") * SCALE
        return F.when(F.abs(scaled) < 2.0**62, F.floor(scaled)).otherwise(F.raise_error(F.lit(f"a component of {vector} is beyond 2**54")).cast("bigint"))

    return F.transform(F.col(vector), whole)


def is_sound(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.col(vector).isNotNull() & finite


def by_length(column: pa.Array, dtype: type) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and matrix of the vectors of each length in a list column; empty vectors are left out."""
    lengths = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        yield int(length), rows, values[starts[rows][:, None] + np.arange(length)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: as 64-bit numbers where they fit, as Python's otherwise."""
    most = n * max(int(np.abs(x).max()), 1) + max(map(abs, sums))
    if most < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squared_lengths(deviation: np.ndarray) -> list[int | None]:
    """Sum of the squares of each row, exact; null where it is beyond a long."""
    most = int(np.abs(deviation).max()) if deviation.size else 0
    if most * most * deviation.shape[1] < 1 << 63:
        whole = deviation.astype(np.int64)
        return (whole * whole).sum(axis=1).tolist()
    wide = deviation.astype(object)
    return [s if s < 1 << 63 else None for s in (wide * wide).sum(axis=1)]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for length, _, x in by_length(batch.column(0), np.int64):
            narrow = int(np.abs(x).max()) * len(x) < 1 << 62
            own = np.array([len(x), *(x if narrow else x.astype(object)).sum(axis=0).tolist()], object)
            totals[length] = totals.get(length, 0) + own
    for length, total in totals.items():
        rows = [{"dims": length, "place": k - 1, "total": int(t)} for k, t in enumerate(total)]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("dims", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0))]))


def _triangles(batches: Iterator[pa.RecordBatch], sums: dict[int, tuple[int, list[int]]]) -> Iterator[pa.RecordBatch]:
    """A triangle for the vectors of each length that a task sees: QR of its centred rows, block on block. Its node is the task's number."""
    from pyspark import TaskContext

    node = TaskContext.get().partitionId()
    kept: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for length, _, x in by_length(batch.column(0), np.int64):
            n, total = sums[length]
            for start in range(0, len(x), BLOCK_ROWS):
                _stack(kept, (node, length), deviations(x[start : start + BLOCK_ROWS], n, total).astype(float) / n)
    yield from _rows(kept)


def _stacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One triangle for all triangles of a node."""
    kept: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        nodes = batch.column(0).to_numpy()
        for length, at, rows in by_length(batch.column(1), float):
            for node in np.unique(nodes[at]).tolist():
                _stack(kept, (node, length), rows[nodes[at] == node])
    yield from _rows(kept)


def _stack(kept: dict[tuple[int, int], np.ndarray], key: tuple[int, int], rows: np.ndarray) -> None:
    kept[key] = np.linalg.qr(np.vstack([kept[key], rows]) if key in kept else rows, mode="r")


def _rows(kept: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (node, length), r in kept.items():
        row = pa.ListArray.from_arrays(pa.array(np.arange(len(r) + 1, dtype=np.int32) * length), pa.array(r.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), node, np.int32)), row], names=["node", "row"])


def _products(batches: Iterator[pa.RecordBatch], models: dict[int, Whitening]) -> Iterator[pa.RecordBatch]:
    """Sums of the whitened components and of their products, over a task's rows."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for length, _, x in by_length(batch.column(0), np.int64):
            z = _whitened(x, models[length])
            totals[length] = totals.get(length, 0.0) + np.concatenate((z.sum(axis=0), (z.T @ z).ravel()))
    for length, total in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), length, np.int32)), pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["dims", "place", "total"])


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (deviations(x, model.n, model.sums).astype(float) / model.n) @ model.directions


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """Whitening of the distinct sound vectors of a table, one for each length that occurs.

    Distinct vectors are found by one shuffle that drops copies before it, and
    written. Three passes read them: sums, triangles, and a check of the result.
    Triangles are stacked in a tree of FAN_IN; what reaches the driver is one of
    them, as many numbers as a vector's length squared. Lengths without a vector
    are not in the answer; a table whose vectors are all alike has no components.
    """
    distinct = written(rows.where(is_sound(vector)).select(whole_numbers(vector).alias("x")).distinct(), "whitening-vectors")
    sums: dict[int, tuple[int, list[int]]] = {}
    totals = distinct.mapInArrow(_sums, SUMS).groupBy("dims", "place").agg(F.sum("total").alias("total"))
    for row in totals.orderBy("dims", "place").collect():
        n, total = sums.get(row.dims, (0, []))
        sums[row.dims] = (int(row.total), []) if row.place < 0 else (n, [*total, int(row.total)])
    if not sums:
        return {}

    tasks = distinct.rdd.getNumPartitions()
    triangles = distinct.mapInArrow(lambda batches: _triangles(batches, sums), TRIANGLES)
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        above = triangles.select(F.floor(F.col("node") / FAN_IN).cast("int").alias("node"), "row")
        triangles = above.repartition(tasks, "node").mapInArrow(_stacked, TRIANGLES)
    models = {}
    for length, _, r in by_length(triangles.toArrow().column("row").combine_chunks(), float):
        n, total = sums[length]
        square = np.zeros((length, length))
        square[: len(r)] = np.triu(r)
        values, vectors = leading(square, components)
        variances = values**2 / n
        kept = variances[: vectors.shape[1]]
        shares = (kept / variances.sum()).tolist() if len(kept) else []
        models[length] = Whitening(n, total, vectors / np.sqrt(kept), shares, 0.0)
    return _checked(distinct, models)


def _checked(distinct: DataFrame, models: dict[int, Whitening]) -> dict[int, Whitening]:
    """The models with the largest entry of their whitened vectors' covariance minus the identity."""
    products = distinct.mapInArrow(lambda batches: _products(batches, models), PRODUCTS).groupBy("dims", "place").agg(F.sum("total").alias("total"))
    found: dict[int, list[float]] = {}
    for row in products.orderBy("dims", "place").collect():
        found.setdefault(row.dims, []).append(row.total)
    out = {}
    for length, model in models.items():
        k = model.directions.shape[1]
        total = np.array(found.get(length, []))
        mean = total[:k] / model.n
        off = total[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)
        out[length] = Whitening(model.n, model.sums, model.directions, model.explained, float(np.abs(off).max(initial=0.0)))
    return out


def whiten(rows: DataFrame, models: dict[int, Whitening], key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Each sound vector of a table on the leading directions of `models`, a row for each component.

    deviation is n*n times the squared distance from the mean, exact; null where
    it is beyond a long. Null vectors and those with a null or non-finite
    component have no row, nor have empty ones, and those of a length whose
    distinct vectors do not vary. Repeated and null keys have the rows of each
    of their vectors.
    """
    made = StructType.fromDDL(WHITENED)
    if key in made.names:
        raise ValueError(f"the key column may not be named {key}")
    sound = rows.where(is_sound(vector)).select(F.col(key), whole_numbers(vector).alias(f"{key}_x"))
    schema = with_fields(sound, [key], WHITENED)

    def components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, at, x in by_length(batch.column(1), np.int64):
                model = models.get(length)
                k = 0 if model is None else model.directions.shape[1]
                if not k:
                    continue
                distance = squared_lengths(deviations(x, model.n, model.sums))
                columns = [
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(k * len(at), model.n, np.int64)),
                    pa.array(distance, pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                    pa.array(_whitened(x, model).ravel()),
                    pa.array(np.tile(np.array(model.explained), len(at))),
                    pa.array(np.full(k * len(at), model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return sound.mapInArrow(components, schema)
