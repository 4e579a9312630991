"""Whitening of vectors through a bidiagonal form of their triangular factor.

Rows are reduced where they are: a task centres its vectors and folds block
after block into one triangular factor R by QR, so it holds one block and one R.
The factors of the tasks are folded in levels of ``FAN``, by further tasks, until
one is left: R'R is n times the covariance, which itself is never formed, so its
small eigenvalues keep their digits.

On that one R, d rows and columns whatever the number of vectors (``MOST_DIMS``
at most), Householder reflections give a bidiagonal B; dqds, the differential
quotient-difference algorithm with shifts, gives the singular values of B to
high relative accuracy; twisted factorisations of B'B less each eigenvalue give
the vectors.  Eigenvalues that nearly meet get theirs by inverse iteration, kept
orthogonal to each other.  The reflections carry them back.

The vectors are read four times: for the sums, for R, for the covariance of the
whitened rows, which is the check, and for the rows themselves.  Nothing but
sums, factors and d numbers a component leaves the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructField, StructType

from fundalake.llm.common import cut

COMPONENTS = 8
#: Factors, or moments, that a task folds into one.
FAN = 16
#: Vectors of a block.
BLOCK = 4096
#: Most dimensions: the factor that the driver takes apart has this many rows and columns.
MOST_DIMS = 1024
#: Relative gaps under which eigenvalues count as meeting.
CLOSE = 1e-3
EPS = float(np.finfo(float).eps)
#: Bound under which integers are summed and multiplied as 64 bits; beyond, Python's own are used.
_EXACT = 1 << 62


class Fit(NamedTuple):
    """n vectors with sums ``sums`` (exact); unit directions in rows, by falling variance, and the sum of all variances."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    total: float


# One small matrix: singular values and vectors.


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of U'RV with orthogonal U and V, and the reflections that make V: the j-th acts from row j + 1 on."""
    a = r.astype(float).copy()
    d = a.shape[1]
    right = []
    for j in range(d):
        _reflect(a[j:, j:])
        if j < d - 2:
            right.append(_reflect(a[j:, j + 1 :].T))
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def _reflect(a: np.ndarray) -> np.ndarray:
    """Turn the first column of ``a``, in place, to the first axis; the unit vector of the reflection (zero: none was needed)."""
    x = a[:, 0].copy()
    size = np.abs(x).max(initial=0.0)
    v = np.zeros_like(x)
    if size == 0 or not np.any(x[1:]):
        return v
    v = x / size
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    v /= np.linalg.norm(v)
    a -= np.outer(2 * v, v @ a)
    a[1:, 0] = 0
    return v


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    out: list[float] = []
    parts = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while parts:
        q, e, shift = parts.pop()
        while len(q) > 1:
            weak = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (shift + min(q[i], q[i + 1]))), None)
            if weak is not None:  # the matrix falls apart here
                parts.append((q[weak + 1 :], e[weak + 1 :], shift))
                q, e = q[: weak + 1], e[:weak]
                continue
            if q[0] < q[-1]:  # the reversed factor has the same values, and its small ones at the end
                q, e = q[::-1], e[::-1]
            q, e, taken = _shifted(q, e)
            shift += taken
        out += [x + shift for x in q]
    return np.sort(np.maximum(out, 0.0))[::-1]


def _shifted(q: list[float], e: list[float]) -> tuple[list[float], list[float], float]:
    """One transform, by a shift close to the least value but not over it; and the shift."""
    a, b = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1]
    half, off = (a - b) / 2, q[-2] * e[-1]
    tau = max(0.0, b - off / (abs(half) + math.sqrt(half * half + off)) if half >= 0 else a - off / (abs(half) + math.sqrt(half * half + off)))
    for attempt in range(12):
        new_q, new_e, d = [], [], q[0] - tau
        for i, x in enumerate(e):
            if d < 0:
                break
            new_q.append(d + x)
            t = q[i + 1] / new_q[-1]
            new_e.append(x * t)
            d = d * t - tau
        if d >= 0:
            return [*new_q, d], new_e, tau
        late = len(new_e) == len(e)  # then the last place says by how much the shift was too large
        tau = max(0.0, (tau + d) * (1 - 4 * EPS)) if late and attempt < 4 else tau / 4 if attempt < 10 else 0.0
    raise ArithmeticError("a transform without a shift cannot fail")


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of B'B at the eigenvalue: factorised from both ends, joined where the twist is least."""
    n = len(diagonal)
    tiny = EPS * EPS * max(float(np.abs(diagonal).max()) ** 2, 1e-290)
    d = [max(float(x) ** 2, tiny) for x in diagonal]
    l = [float(b) / math.copysign(math.sqrt(max(float(a) ** 2, tiny)), a) for a, b in zip(diagonal, above)]
    s, down = [-value], []
    for i in range(n - 1):
        at = s[i] + d[i]
        down.append(d[i] * l[i] / (at or tiny))
        s.append(down[i] * l[i] * s[i] - value)
    p, up = [0.0] * (n - 1) + [d[-1] - value], [0.0] * (n - 1)
    for i in range(n - 2, -1, -1):
        t = d[i] / (d[i] * l[i] * l[i] + p[i + 1] or tiny)
        up[i] = l[i] * t
        p[i] = p[i + 1] * t - value
    twist = [abs(x + y + value) for x, y in zip(s, p)]
    k = int(np.argmin(twist))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def singular(r: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of ``r``, falling, and the right vectors, in rows, of the first ``most``."""
    a, b, right = bidiagonal(r)
    values = dqds(a, b)
    if not values.any():
        return values, np.eye(len(a))[:most]
    found: list[np.ndarray] = []
    rng = np.random.default_rng(13)
    first = 0  # of those that nearly meet
    for i, value in enumerate(values[:most]):
        if i and values[i - 1] - value > CLOSE * max(value, EPS * values[0]):
            first = i
        z = twisted(a, b, value) if first == i else _beside(a, b, value, found[first:i], rng)
        found.append(z)
    out = np.array(found).reshape(len(found), len(a))
    for j in range(len(right) - 1, -1, -1):
        v = right[j]
        out[:, j + 1 :] -= np.outer(out[:, j + 1 :] @ v, 2 * v)
    at = np.abs(out).argmax(axis=1)
    return values, out * np.sign(out[np.arange(len(out)), at])[:, None]


def _beside(a: np.ndarray, b: np.ndarray, value: float, found: list[np.ndarray], rng: np.random.Generator) -> np.ndarray:
    """A unit vector at an eigenvalue, orthogonal to those of the ones it nearly meets."""
    t = np.diag(a * a) + np.diag(np.append(0.0, b * b))
    t += np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    have, z = np.array(found), rng.standard_normal(len(a))
    t -= (value + 8 * EPS * max(float(np.abs(t).max()), 1e-290) * (1 + len(found))) * np.eye(len(a))
    for _ in range(4):
        for _ in range(2):
            z -= (have @ z) @ have
        z /= np.linalg.norm(z)
        z = np.linalg.solve(t, z)
    for _ in range(2):
        z -= (have @ z) @ have
        z /= np.linalg.norm(z)
    return z


# The vectors, in tasks.


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x): for each length, the rows with whole vectors of that length and their entries as integers."""
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    value = column.flatten().cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    first = np.concatenate([[0], np.cumsum(np.maximum(size, 0))])
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(value))])
    whole = (size > 0) & (odd[first[1:]] == odd[first[:-1]])
    for d in np.unique(size[whole]).tolist():
        rows = np.flatnonzero(whole & (size == d))
        with np.errstate(over="ignore"):
            scaled = np.floor(value[first[rows][:, None] + np.arange(d)] * 1024)
        yield rows, np.clip(scaled, -float(_EXACT), float(_EXACT)).astype(np.int64) + 100_000


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of at most BLOCK rows: the slice, its rows with whole vectors of ``dims`` entries, and those."""
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            part = batch.slice(i, BLOCK)
            for rows, x in _vectors(part.column(column)):
                if x.shape[1] == dims:
                    yield part, rows, x


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for batch in batches:
        for _, x in _vectors(batch.column(0)):
            exact = x if int(np.abs(x).max()) * len(x) < _EXACT else x.astype(object)
            have = total.setdefault(x.shape[1], [0, [0] * x.shape[1]])
            have[0] += len(x)
            have[1] = [a + int(b) for a, b in zip(have[1], exact.sum(axis=0))]
    for d, (n, sums) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([d] * d), pa.array(range(d), pa.int64()), pa.array([n] * d), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], names=["dims", "at", "n", "total"])


def _numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact."""
    if n * int(np.abs(x).max(initial=0)) < _EXACT and all(abs(s) < _EXACT for s in sums):
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _rows_of(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_numerators(x, n, sums) / n).astype(float)


def _factor(have: np.ndarray | None, more: np.ndarray) -> np.ndarray:
    """The triangular factor of the rows of both."""
    return np.linalg.qr(more if have is None else np.vstack([have, more]), mode="r")


def _merge_moments(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    """Count, means and centred sums of products of two sets of rows, from those of each."""
    if a is None:
        return b
    k = _width(a)
    n, gap = a[0] + b[0], b[1 : k + 1] - a[1 : k + 1]
    out = a + b
    out[1 : k + 1] = a[1 : k + 1] + gap * (b[0] / n)
    out[k + 1 :] += np.outer(gap, gap).ravel() * (a[0] * b[0] / n)
    return out


def _width(moments: np.ndarray) -> int:
    return (math.isqrt(4 * len(moments) - 3) - 1) // 2


def _folded(parts: DataFrame, fold: Callable[[np.ndarray | None, np.ndarray], np.ndarray], columns: int) -> np.ndarray | None:
    """One array from those of all tasks, (slot, data) with a slot of its own each, folded by FAN in a task until one is left."""

    def level(table: pa.Table) -> pa.Table:
        out = None
        for data in table.sort_by("slot")["data"].to_pylist():
            more = np.frombuffer(data)
            out = fold(out, more.reshape(-1, columns) if columns else more)
        return pa.table({"slot": [table["slot"][0].as_py() // FAN], "data": [out.tobytes()]})

    parts = cut(parts)
    most = parts.agg(F.max("slot")).first()[0]
    if most is None:
        return None
    while True:
        parts = parts.groupBy(F.floor(F.col("slot") / FAN).alias("group")).applyInArrow(level, "slot long, data binary")
        most //= FAN
        if not most:
            break
    (row,) = parts.collect()
    out = np.frombuffer(row.data)
    return out.reshape(-1, columns) if columns else out


def _task_row(out: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([out.tobytes()], pa.binary())], names=["slot", "data"])


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """The directions of most variance of the whole vectors of the most frequent length (of equals: the greatest); None if there are none.

    A vector that is null or empty, or that has a null or non-finite entry, is not whole.
    """
    only = vectors.select(F.col(f"`{column}`"))
    sums = cut(only.mapInArrow(_sums, "dims long, at long, n long, total decimal(38,0)").groupBy("dims", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    top = sums.filter("at = 0").orderBy(F.col("n").desc(), F.col("dims").desc()).first()
    if top is None:
        return None
    n, dims = top.n, top.dims
    if dims > MOST_DIMS:
        raise ValueError(f"{dims} dimensions; at most {MOST_DIMS}")
    total = [int(r.total) for r in sums.filter(F.col("dims") == dims).orderBy("at").collect()]

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for _, _, x in _blocks(batches, dims):
            r = _factor(r, _rows_of(x, n, total))
        if r is not None:
            yield _task_row(r)

    r = _folded(only.mapInArrow(reduce, "slot long, data binary"), _factor, dims)
    square = np.zeros((dims, dims))
    square[: len(r)] = r[:dims]
    values, directions = singular(square, components)
    return Fit(n, total, directions, values[:components] / n, float(values.sum()) / n)


def _scales(f: Fit) -> np.ndarray:
    """1 / sqrt of the variances; nan where the variance is within rounding of none."""
    noise = (10 * len(f.sums) * EPS) ** 2 * f.variances.max(initial=0.0)
    with np.errstate(divide="ignore"):
        return np.where(f.variances > noise, 1 / np.sqrt(f.variances), math.nan)


def identity_error(vectors: DataFrame, f: Fit, column: str = "embedding") -> float | None:
    """The largest entry, by size, of the covariance of the whitened vectors less the identity; None without a component that varies."""
    scale = _scales(f)
    use = np.isfinite(scale)
    if not use.any():
        return None
    by, k, dims = (f.directions * scale[:, None])[use].T, int(use.sum()), len(f.sums)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = None
        for _, _, x in _blocks(batches, dims):
            y = _rows_of(x, f.n, f.sums) @ by
            mean = y.mean(axis=0)
            have = _merge_moments(have, np.concatenate([[len(y)], mean, ((y - mean).T @ (y - mean)).ravel()]))
        if have is not None:
            yield _task_row(have)

    got = _folded(vectors.select(F.col(f"`{column}`")).mapInArrow(moments, "slot long, data binary"), _merge_moments, 0)
    return float(np.abs(got[k + 1 :].reshape(k, k) / got[0] - np.eye(k)).max())


def whitened(vectors: DataFrame, f: Fit, column: str = "embedding") -> DataFrame:
    """The rows of ``vectors`` that the fit covers, with whitened (array of one double a component; null where the component does not vary) and deviation (exact; null beyond 38 digits)."""
    dims, scale = len(f.sums), _scales(f)
    by = (f.directions * np.where(np.isfinite(scale), scale, 0)[:, None]).T
    gone = ~np.isfinite(scale)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, at, x in _blocks(batches, dims, 1):
            up = _numerators(x, f.n, f.sums)
            if up.dtype == object or int(np.abs(up).max()) ** 2 * dims >= _EXACT:
                up = up.astype(object)
            y = (up / f.n).astype(float) @ by
            deviation = [Decimal(int(v)) if int(v) < 10**38 else None for v in (up * up).sum(axis=1)]
            flat = pa.array(y.ravel(), mask=np.tile(gone, len(y)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), lists, pa.array(deviation, pa.decimal128(38, 0))], names=["row", "whitened", "deviation"])

    packed = vectors.select(F.struct(*[F.col(f"`{c}`") for c in vectors.columns if c != column]).alias("row"), F.col(f"`{column}`").alias("vector"))
    kind = StructType([packed.schema["row"], StructField("whitened", ArrayType(DoubleType())), StructField("deviation", DecimalType(38, 0))])
    out = packed.mapInArrow(rows, kind)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in vectors.columns if c not in (column, "whitened", "deviation")], "whitened", "deviation")


def components(vectors: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row for each whole vector and component: the other columns of ``vectors``, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, or have null or non-finite entries, go, and
    so do those of another length than most have.  Entries whose 1024-fold is
    beyond 2^62 count as that.  Repeated rows and null ids are rows like any
    others.  Components of variance zero (one row, equal rows, fewer rows than
    components) have a null whitened value; explained is null if nothing varies,
    identity_error if no component does.  deviation is null beyond a long.  An
    empty table gives an empty result.  Extra columns come along, whatever their
    names (the result's own are replaced).
    """
    f = fit(vectors, column, most)
    own = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    rest = [c for c in vectors.columns if c not in own and c != column]
    if f is None:
        empty = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        none = vectors.select(*[F.col(f"`{c}`") for c in rest]).limit(0)
        return none.select("*", *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in empty.split(", ")])
    error = identity_error(vectors, f, column)
    rows = whitened(vectors, f, column)
    explained = F.array(*[F.lit(float(v / f.total) if f.total > 0 else None).cast("double") for v in f.variances])
    long = rows.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "value"))
    columns = [F.col(f"row.`{c}`").alias(c) for c in rest]
    return long.select(*columns, (F.col("at") + 1).cast("int").alias("component"), F.lit(f.n).cast("long").alias("n"), "deviation", F.col("value").alias("whitened"), F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
