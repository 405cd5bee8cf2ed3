"""Whitening of embeddings with components refined from single to extended precision.

Entries are read as whole numbers, floor(scale * c) + offset, so sums and products are exact and the same however the rows
are cut into tasks. One pass counts and sums; a second one adds up products of centred entries, a d x d triangle a task.
What reaches the driver depends on the dimension alone: d * d sums.

There the covariance's eigenvectors are found in float32 and corrected by Ogita and Aishima's iteration: from
R = I - X'X and S = X'VX follow eigenvalues s_ii / (1 - r_ii) and a correction E with e_ij = (s_ij + l_j r_ij) / (l_j - l_i),
and X + XE doubles the number of right digits, by matrix products alone, here in extended precision. Eigenvalues closer than
the error of X allows are a cluster: inside it E only restores orthogonality, then the cluster's own small problem
X_c'(V - mu I)X_c is solved in float32 on its own scale and turns X_c, which pulls the cluster apart.

Defined results: a vector that is null, holds a null or non-finite entry, or has not the dimension most vectors have (of
equally common ones the greater) is dropped; repeated rows count once each; an empty table gives an empty result. A component
whose eigenvalue is zero to precision (fewer rows than dimensions, or linearly dependent entries) has no scale: its
whitened values are null, and it takes no part in the identity error. Entries beyond 2**52 after scaling are held there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .frames import Inner, map_batches, written

SCALE = 64
OFFSET = 1_000_000
_LARGE = float(1 << 52)
_EXACT = 1 << 53
_LONG = 1 << 63

SUMS = T.StructType([
    T.StructField("size", T.IntegerType()), T.StructField("dim", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("total", T.DecimalType(38, 0)),
])
PRODUCTS = T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("total", T.DecimalType(38, 0)),
])


@dataclass(frozen=True)
class Whitening:
    """Rows of `components` are unit eigenvectors by falling eigenvalue; `sums` and `n` are those of the fit list."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    scale: int = SCALE
    offset: int = OFFSET

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace else 0.0 for e in self.eigenvalues]


def usable(column: pa.Array, scale: int, offset: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length: (rows, whole-number entries as int64) of the vectors without null or non-finite entries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    whole = column.is_valid().to_numpy(zero_copy_only=False)
    at = column.offsets.to_numpy().astype(np.int64)
    base, entries = at[0], column.values.slice(at[0], at[-1] - at[0])
    flat = entries.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries become NaN
    bad = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(~np.isfinite(flat), out=bad[1:])
    begin, end = at[:-1] - base, at[1:] - base
    good = whole & (bad[end] == bad[begin])
    size = end - begin
    found = {}
    for d in np.unique(size[good]):
        if d:
            rows = np.flatnonzero(good & (size == d))
            values = np.floor(scale * flat[begin[rows][:, None] + np.arange(d)])
            found[int(d)] = rows, np.clip(values, -_LARGE, _LARGE).astype(np.int64) + offset
    return found


def _pass(df: DataFrame, column: str, model: tuple[int, int], add, finish, schema: T.StructType) -> DataFrame:  # noqa: ANN001
    """One output per task: `add(state, entries by length)` for every batch, `finish(state)` as columns at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            add(state, usable(batch.column(0), *model))
        rows = finish(state)
        kinds = [pa.int32() if f.dataType == T.IntegerType() else pa.int64() if f.dataType == T.LongType()
                 else pa.decimal128(38, 0) for f in schema.fields]
        if len(rows[0]):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(rows, kinds)], schema.names)

    return map_batches(df.select(column), run, schema)


def exact_sums(values: np.ndarray) -> list[int]:
    """Column sums of an int64 matrix; long columns of large numbers are summed in parts."""
    part = max(1, (_LONG - 1) // max(1, int(np.abs(values).max(initial=0))))
    total = [0] * values.shape[1]
    for i in range(0, len(values), part):
        total = [a + int(b) for a, b in zip(total, values[i : i + part].sum(axis=0))]
    return total


def exact_products(y: np.ndarray) -> np.ndarray:
    """Y'Y of an int64 matrix, exact, as Python numbers; parts whose sums float64 holds exactly are matrix products."""
    largest = int(np.abs(y).max(initial=0))
    part = _EXACT // max(1, largest * largest)
    if part < 1:
        whole = y.astype(object)
        return whole.T @ whole
    total = np.zeros((y.shape[1],) * 2, object)
    for i in range(0, len(y), part):
        rows = y[i : i + part].astype(np.float64)
        total = total + (rows.T @ rows).astype(np.int64).astype(object)
    return total


def _count(df: DataFrame, column: str, scale: int, offset: int) -> tuple[int, int, list[int]]:
    """(dimension, number, sums) of the vectors of the commonest length."""

    def add(state: dict, entries: dict) -> None:
        for d, (rows, values) in entries.items():
            n, sums = state.get(d, (0, [0] * d))
            state[d] = n + len(rows), [a + b for a, b in zip(sums, exact_sums(values))]

    def finish(state: dict) -> tuple:
        rows = [(d, k, n, s) for d, (n, sums) in state.items() for k, s in enumerate(sums)]
        return tuple(zip(*rows)) if rows else ((), (), (), ())

    parts = _pass(df, column, (scale, offset), add, finish, SUMS)
    sums = written(parts.groupBy("size", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "sums")
    top = sums.where("dim = 0").orderBy(F.col("n").desc(), F.col("size").desc()).first()
    if top is None:
        return 0, 0, []
    rows = sums.where(F.col("size") == top["size"]).orderBy("dim").collect()  # one row a dimension
    return top["size"], top["n"], [int(r["total"]) for r in rows]


def _covariance(df: DataFrame, column: str, scale: int, offset: int, n: int, sums: list[int]) -> np.ndarray:
    """Covariance with divisor n. Entries are centred at the whole number next to their mean before they are multiplied,
    and what is left of the mean is taken off exactly, so the result is the rounded exact value."""
    d = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def add(state: dict, entries: dict) -> None:
        if d in entries:
            state[0] = state.get(0, 0) + exact_products(entries[d][1] - np.array(centre, np.int64))

    upper = np.triu_indices(d)

    def finish(state: dict) -> tuple:
        if not state:
            return (), (), ()
        return upper[0], upper[1], [int(x) for x in state[0][upper]]

    parts = _pass(df, column, (scale, offset), add, finish, PRODUCTS)
    rows = parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()  # d * (d + 1) / 2 rows
    rest = [s - n * c for s, c in zip(sums, centre)]
    cov = np.zeros((d, d), np.longdouble)
    square = np.longdouble(str(n * n))
    for r in rows:
        i, j = r["i"], r["j"]
        cov[i, j] = cov[j, i] = np.longdouble(str(n * int(r["total"]) - rest[i] * rest[j])) / square
    return cov


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Index groups of sorted values in which neighbours are at most `gap` apart."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def _single(matrix: np.ndarray) -> np.ndarray:
    """Eigenvectors in float32 of a symmetric matrix, which is brought to its own scale first."""
    size = np.abs(matrix).max(initial=0)
    return np.linalg.eigh((matrix / size if size else matrix).astype(np.float32))[1].astype(matrix.dtype)


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """The near-orthonormal columns of `x` made so to the precision of `x`."""
    for _ in range(4):
        x = x + x @ (np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2
    return x


def refine(cov: np.ndarray, x: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of `cov` from approximate ones, in the precision of `cov`.

    Ends when corrections are smaller than float64 holds, or no longer shrink because the precision of `cov` is reached.
    Eigenvalues that float64 does not tell apart count as one multiple eigenvalue: any orthonormal columns will do for it.
    """
    d = len(cov)
    eye = np.eye(d, dtype=cov.dtype)
    norm = np.abs(cov).sum(axis=1).max(initial=0)
    nothing = 4 * np.finfo(np.float64).eps * norm
    before = np.inf
    for _ in range(steps):
        r = eye - x.T @ x
        s = x.T @ (cov @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        error = max(2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum())), nothing)
        apart = values[None, :] - values[:, None]
        clear = np.abs(apart) > error
        e = np.where(clear, (s + values[None, :] * r) / np.where(clear, apart, 1), r / 2)
        x = x + x @ e
        turned = False
        for group in _clusters(values, error):
            sub = _orthonormal(x[:, group])
            inner = sub.T @ (cov @ sub)
            inner = (inner + inner.T) / 2 - values[group].mean() * np.eye(len(group), dtype=cov.dtype)
            if np.abs(inner - np.diag(np.diag(inner))).max() > nothing:
                x[:, group] = sub @ _orthonormal(_single(inner))
                turned = True
        largest = np.abs(e).max(initial=0)
        if not turned and (largest <= np.finfo(np.float64).eps or largest >= before / 2):
            break
        before = np.inf if turned else largest
    x = _orthonormal(x)
    s = x.T @ (cov @ x)
    return np.diag(s) / np.einsum("ij,ij->j", x, x), x


def eigen(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as rows) of a covariance in extended precision, rounded to float64."""
    values, x = refine(cov, _single(cov))
    order = np.argsort(-values, kind="stable")
    x = (x / np.sqrt((x * x).sum(axis=0)))[:, order].T
    return np.maximum(values[order], 0).astype(np.float64), x.astype(np.float64)


def fit_whitening(
    vectors: DataFrame, column: str = "embedding", components: int | None = None, scale: int = SCALE, offset: int = OFFSET
) -> Whitening:
    """Components of the usable vectors, at most `components` of them, in two passes over the column."""
    d, n, sums = _count(vectors, column, scale, offset)
    if not n:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0, scale, offset)
    cov = _covariance(vectors, column, scale, offset, n, sums)
    values, rows = eigen(cov)
    k = d if components is None else min(components, d)
    return Whitening(n, tuple(sums), rows[:k], values[:k], float(np.trace(cov)), scale, offset)


def deviations(y: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows of an exact matrix; null where a long cannot hold one."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * max(1, y.shape[1]) < _LONG:
        y = y.astype(np.int64)
        return (y * y).sum(axis=1).tolist()
    return [s if s < _LONG else None for s in (sum(int(v) * int(v) for v in row) for row in y)]


def project(model: Whitening, values: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
    """(whitened entries, deviations) of whole-number vectors; components without a scale give NaN."""
    sums = np.array(model.sums, object)
    bound = model.n * (int(np.abs(values).max(initial=0)) + 1)
    if bound < _LONG // 2:  # n * x and the sums fit
        y = model.n * values - sums.astype(np.int64)
    else:
        y = model.n * values.astype(object) - sums
    centred = (y / model.n).astype(np.float64)
    least = len(model.sums) * np.finfo(np.float64).eps * model.eigenvalues.max(initial=0)
    with_scale = model.eigenvalues > least
    spread = np.sqrt(np.where(with_scale, model.eigenvalues, np.nan))
    return centred @ model.components.T / spread, deviations(y)


def whiten(vectors: DataFrame, model: Whitening, column: str = "embedding") -> DataFrame:
    """The usable rows with `whitened`, one entry a component, and `deviation`, the exact sum of squares of n * x - sums."""
    inner = Inner(vectors)
    fields = [T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.LongType())]
    schema = T.StructType([*inner.df.schema.fields, *fields])
    where = inner.df.columns.index(inner[column])
    d, k = len(model.sums), len(model.components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = usable(batch.column(where), model.scale, model.offset)
            if d not in entries:
                continue
            rows, values = entries[d]
            white, deviation = project(model, values)
            flat = pa.array(white.ravel(), pa.float64(), from_pandas=True)  # NaN becomes null
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * k), flat)
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns, lists, pa.array(deviation, pa.int64())], schema.names)

    return inner.with_results(map_batches(inner.df, run, schema), ["whitened", "deviation"])


MOMENTS = T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("total", T.DoubleType()),
])


def _moments(df: DataFrame, column: str, k: int, centre: np.ndarray | None) -> np.ndarray:
    """Sums of the `k` entries of an array column or, with a centre, sums of products of the centred entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1, k) if centre is None else (k, k))
        for batch in batches:
            lists = batch.column(0)
            w = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), k)
            total += w.sum(axis=0, keepdims=True) if centre is None else (w - centre).T @ (w - centre)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], MOMENTS.names
        )

    sums = map_batches(df.select(column), run, MOMENTS).groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    out = np.zeros((1, k) if centre is None else (k, k))
    for r in sums:  # k * k rows at most
        out[r["i"], r["j"]] = r["total"]
    return out


def identity_error(whitened: DataFrame, n: int, k: int, column: str = "whitened") -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity; components without a scale are left out.

    Null where there is no row or no component with a scale.
    """
    if not n or not k:
        return None
    centre = _moments(whitened, column, k, None)[0] / n
    cov = _moments(whitened, column, k, centre) / n
    scaled = np.flatnonzero(np.isfinite(centre))
    if not len(scaled):
        return None
    return float(np.abs(cov[np.ix_(scaled, scaled)] - np.eye(len(scaled))).max())
