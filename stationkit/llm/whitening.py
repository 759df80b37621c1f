"""Whitening of embeddings by spectral divide and conquer.

The covariance of the distinct vectors is summed over Spark tasks; only sums of
the size of the dimension leave them. The covariance is then split by its
spectrum: the polar factor U of the shifted matrix A - s has eigenvalue 1 on
the invariant subspace above s and -1 below, so (U + I) / 2 projects on it. The
QDWH iteration finds the polar factor in a few steps of QR or Cholesky. Both
halves are split on until each holds one component. The components are
broadcast and every vector is projected on them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.plans.stored import store

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
# Entries above this size in fixed point would lose digits as doubles or overflow sums.
LARGEST = 1 << 46
_EPS = np.finfo(np.float64).eps


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by the QDWH iteration."""
    d = len(a)
    size = np.linalg.norm(a)
    x = a / size
    # A lower bound of the least singular value; a value too small costs a step or two.
    low = max(1 / max(np.linalg.cond(x, 1), 1.0) / np.sqrt(d) * 0.9, _EPS)
    low = min(low, 1.0)
    for _ in range(40):
        square = low * low
        cube = np.cbrt(4 * max(1 - square, 0.0) / square**2)
        root = np.sqrt(1 + cube)
        wa = root + np.sqrt(8 - 4 * cube + 8 * (2 - square) / (square * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:
            q, _ = np.linalg.qr(np.concatenate((np.sqrt(wc) * x, np.eye(d))))
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:d] @ q[d:].T)
        else:
            z = np.linalg.cholesky(np.eye(d) + wc * (x.T @ x))
            half = np.linalg.solve(z, x.T)
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(z.T, half).T
        x = (x + x.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if np.linalg.norm(x - before) < np.cbrt(5 * _EPS) and abs(1 - low) < 1e-8:
            return x
    return x


def _halves(a: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift between eigenvalues.

    None if the matrix is a multiple of the identity to working precision.
    """
    d = len(a)
    diagonal = np.diag(a)
    spread = np.linalg.norm(a - np.eye(d) * diagonal.mean())
    if spread <= 8 * d * _EPS * max(np.linalg.norm(a), 1e-300):
        return None
    shifts = [np.median(diagonal), diagonal.mean()]
    shifts += [diagonal.mean() + spread / np.sqrt(d) * t for t in random.uniform(-0.8, 0.8, 12)]
    best = None
    for shift in shifts:
        u = polar(a - shift * np.eye(d))
        projector = (u + np.eye(d)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < d:
            continue
        basis = projector @ random.standard_normal((d, rank))
        basis, _ = np.linalg.qr(projector @ np.linalg.qr(basis)[0])
        whole, _ = np.linalg.qr(basis, mode="complete")
        upper, lower = whole[:, :rank], whole[:, rank:]
        off = np.linalg.norm(upper.T @ a @ lower)
        if best is None or off < best[0]:
            best = off, upper, lower
        if off <= 100 * d * _EPS * np.linalg.norm(a):
            break
    return None if best is None else best[1:]


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Divide and conquer by spectral projectors. The few digits that the splits
    lose are won back by two steps of first-order correction, in which each
    vector gives up what it holds of the others.
    """
    random = np.random.default_rng(13)
    d = len(a)
    done: list[np.ndarray] = []
    waiting = [np.eye(d)]
    while waiting:
        basis = waiting.pop()
        inner = basis.T @ a @ basis
        split = _halves((inner + inner.T) / 2, random) if basis.shape[1] > 1 else None
        if split is None:
            done.append(basis)
        else:
            waiting += [basis @ split[0], basis @ split[1]]
    vectors = np.concatenate(done, axis=1) if done else np.zeros((d, 0))
    for _ in range(2):
        inner = vectors.T @ a @ vectors
        values = np.diag(inner).copy()
        gap = values[None, :] - values[:, None]
        # Equal eigenvalues have no vectors of their own to be told apart by.
        clear = np.abs(gap) > 1e3 * _EPS * max(np.abs(values).max(initial=0), 1e-300)
        step = np.where(clear, inner / np.where(clear, gap, 1), 0.0)
        np.fill_diagonal(step, 0)
        if np.abs(step).max(initial=0) > 0.1:
            break
        vectors, triangle = np.linalg.qr(vectors + vectors @ step)
        vectors = vectors * np.sign(np.diag(triangle))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[largest, np.arange(d)])


def fixed_point(column: pa.ListArray) -> list[bytes | None]:
    """Each vector as whole numbers, 8 bytes an entry; None for a vector that is not usable."""
    column = column.cast(pa.list_(pa.float64()))
    flat = column.flatten()
    missing = flat.is_null().to_numpy(zero_copy_only=False)
    scaled = np.where(missing, np.nan, flat.to_numpy(zero_copy_only=False)) * SCALE
    odd = ~(np.abs(scaled) < LARGEST)
    x = np.floor(np.where(odd, 0.0, scaled)).astype(np.int64) + OFFSET
    sizes = np.array([n or 0 for n in column.value_lengths().to_pylist()], dtype=np.int64)
    ends = np.cumsum(sizes)
    bad = np.concatenate(([0], np.cumsum(odd)))[ends] > np.concatenate(([0], np.cumsum(odd)))[ends - sizes]
    data = x.astype("<i8").tobytes()
    return [
        data[8 * (e - n) : 8 * e] if n and not b else None
        for e, n, b in zip(ends.tolist(), sizes.tolist(), bad.tolist(), strict=True)
    ]


def _points(column: pa.Array, d: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype="<i8").astype(np.int64).reshape(-1, d)


def _centred(x: np.ndarray, sums: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n*x - S exactly, and x - S/n as doubles without the loss that the offset would bring."""
    least = sums // n
    rest = sums - least * n
    apart = x - least.astype(np.int64)
    biggest = float(np.abs(apart).max(initial=0)) * n + n
    exact = apart * n - rest.astype(np.int64) if biggest < 2**62 else apart.astype(object) * n - rest
    return exact, apart - rest.astype(np.float64) / n


def _squares(exact: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; None if it does not fit in 63 bits."""
    if exact.dtype != object:
        biggest = float(np.abs(exact).max(initial=0))
        if biggest * biggest * max(exact.shape[1], 1) < 2**62:
            return (exact * exact).sum(axis=1).tolist()
        exact = exact.astype(object)
    sums = (exact * exact).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in sums]


@dataclass(frozen=True)
class Whitening:
    """What every row is projected with: count, exact sums, components and their spread."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact n*x - S, and the whitened coordinates; NaN where a component has no spread."""
        exact, centred = _centred(x, self.sums, self.n)
        with np.errstate(divide="ignore"):
            scale = np.where(self.values > 0, 1 / np.sqrt(self.values), np.nan)
        return exact, (centred @ self.vectors) * scale


def _summed(parts: DataFrame, width: int) -> np.ndarray:
    """Matrices that tasks have emitted row by row, added up in task order: (rows x width).

    Only the sums reach the driver.
    """

    def add(group: pa.Table) -> pa.Table:
        group = group.sort_by("part").combine_chunks()
        values = np.frombuffer(b"".join(group["row"].to_pylist())).reshape(-1, width)
        total = np.zeros(width)
        for row in values:
            total += row
        return pa.table({"i": group["i"][:1], "row": pa.array([total.tobytes()], pa.binary())})

    rows = parts.groupBy("i").applyInArrow(add, "i bigint, row binary").orderBy("i").collect()
    return np.array([np.frombuffer(r["row"]) for r in rows]).reshape(-1, width)


def _partial(fit: DataFrame, d: int, measure) -> DataFrame:
    """A matrix from each task: the sum of ``measure`` over its vectors, as rows ``part, i, row``."""

    def run(batches):
        total, part = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            value = measure(_points(batch.column("x"), d))
            total = value if total is None else total + value
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(total), pa.int64()), pa.array(range(len(total)), pa.int64()),
                 pa.array([row.tobytes() for row in total], pa.binary())], ["part", "i", "row"],
            )

    numbered = fit.select(F.spark_partition_id().cast("bigint").alias("part"), "x")
    return numbered.mapInArrow(run, "part bigint, i bigint, row binary")


def _exact_sums(fit: DataFrame, d: int) -> np.ndarray:
    """Sum of each entry as Python integers; halves of 31 bits keep partial sums in range."""

    def run(batches):
        high, low = [0] * d, [0] * d
        for batch in batches:
            x = _points(batch.column("x"), d)
            high = [a + b for a, b in zip(high, (x >> 31).sum(axis=0).tolist(), strict=True)]
            low = [a + b for a, b in zip(low, (x & ((1 << 31) - 1)).sum(axis=0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64())],
            ["i", "high", "low"],
        )

    wide = "decimal(38,0)"
    rows = (
        fit.select("x").mapInArrow(run, "i bigint, high bigint, low bigint").groupBy("i")
        .agg(F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low"))
        .orderBy("i").collect()
    )
    return np.array([(int(r["high"]) << 31) + int(r["low"]) for r in rows], dtype=object)


def fit_whitening(fit: DataFrame, d: int, n: int, components: int = COMPONENTS) -> Whitening:
    """Fit on a stored table of ``n`` distinct vectors ``x`` of dimension ``d``.

    The driver holds a few matrices of d x d numbers, whatever the number of vectors.
    """
    sums = _exact_sums(fit, d)

    def products(x: np.ndarray) -> np.ndarray:
        _, y = _centred(x, sums, n)
        return y.T @ y

    covariance = _summed(_partial(fit, d, products), d) / n
    values, vectors = spectrum((covariance + covariance.T) / 2)
    # What is left of a component without spread is rounding.
    values = np.where(values > d * _EPS * max(values.max(initial=0), 0), values, 0.0)
    trace = float(np.trace(covariance))
    explained = values / trace if trace > 0 else np.zeros(d)
    k = min(components, d)
    return Whitening(n, sums, np.ascontiguousarray(vectors[:, :k]), values[:k], explained[:k])


def identity_error(fit: DataFrame, d: int, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, from the vectors.

    Components without spread do not count.
    """
    used = np.flatnonzero(model.values > 0)
    k = len(used)
    if not k:
        return 0.0

    def products(x: np.ndarray) -> np.ndarray:
        w = model.project(x)[1][:, used]
        return np.concatenate((w.T @ w, w.sum(axis=0)[None, :]))

    both = _summed(_partial(fit, d, products), k) / model.n
    covariance = both[:k] - np.outer(both[k], both[k])
    return float(np.abs(covariance - np.eye(k)).max())


_RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
    "explained double, identity_error double"
)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every usable vector on the leading components.

    Returns ``vec_id, component`` (from 1, by falling variance), ``n`` (distinct
    vectors fitted on), ``deviation`` (exact sum of (n*x - S)^2; null beyond 63
    bits), ``whitened``, ``explained`` (share of the total variance) and
    ``identity_error`` (one value for all rows), one row for each usable row of
    ``vectors`` and component. A component's sign makes its largest entry
    positive, so reruns agree.

    Left out are vectors that are null or empty, hold null or non-finite numbers
    or numbers above 2^40, and those whose length is not the most frequent one
    among distinct vectors (the longest of equally frequent ones). Repeated rows
    give repeated results but count once in the fit; null vec_ids stay null.
    Where a component has no spread (fewer distinct vectors than dimensions, or
    constant entries), ``whitened`` is null and ``explained`` 0. An empty table
    gives an empty one. Other columns are not read.
    """
    spark = vectors.sparkSession

    def to_points(batches):
        for batch in batches:
            x = pa.array(fixed_point(batch.column("embedding")), pa.binary())
            both = pa.RecordBatch.from_arrays([batch.column("vec_id"), x], ["vec_id", "x"])
            yield both.filter(x.is_valid())

    read = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    points = read.where("embedding IS NOT NULL").mapInArrow(to_points, "vec_id bigint, x binary")
    fit = store(points.select("x").distinct(), "distinct-vectors").df
    lengths = fit.groupBy(F.octet_length("x").alias("size")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not usual:
        return spark.createDataFrame([], _RESULT)
    size, n = usual[0]
    d = size // 8
    fit = fit.where(F.octet_length("x") == size)
    model = fit_whitening(fit, d, n, components)
    error = identity_error(fit, d, model)
    held = spark.sparkContext.broadcast(model)

    def project(batches):
        model = held.value
        k = len(model.values)
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                exact, w = model.project(_points(part.column("x"), d))
                rows = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, model.n)),
                        pa.array(_squares(exact), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                        pa.array(w.ravel(), mask=np.isnan(w.ravel())),
                        pa.array(np.tile(model.explained, rows)),
                        pa.array(np.full(rows * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return points.where(F.octet_length("x") == size).mapInArrow(project, _RESULT)
