"""Whitening of vectors by their leading principal components, found by Jacobi-Davidson.

The covariance is never made: every step asks Spark for its product with a few vectors at
once, a sum over the rows of the fit list of ``(row - mean) * ((row - mean) . vector)``. The
driver holds the search space only, a few numbers per dimension. Each round takes the Ritz
pairs of the search space, locks those whose residual is at rounding level, and widens the
space by corrections for the others: MINRES on the projected correction equation, a step of
which is one product for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.workspace import Workspace

SCALE, SHIFT = 64, 1_000_000  # a vector's entry c becomes the long floor(SCALE * c) + SHIFT
WIDE = 4  # the search space has at most so many vectors per component
INNER = 8  # MINRES steps per round
ROUNDS = 200
EXACT = float(1 << 53)  # scaled entries from here on have no exact long
RANK = 1e-12  # components with less than this part of the largest eigenvalue have no direction


@dataclass(frozen=True)
class Components:
    """Mean as ``sums / n`` of the fit list, unit components as columns, their eigenvalues,
    the trace of the covariance, and how far whitened rows are from unit covariance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    residuals: np.ndarray
    products: int


def longs(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, x)``: the rows that have a vector, its entries as longs.

    Left out are rows whose vector is null, empty or has entries that are null, not finite
    or, times ``SCALE``, beyond 2^53, where a double no longer tells longs apart. Vectors of
    another length than most are left out as well, of equally many the longer ones stay. A
    null id stays null; repeated rows stay.
    """
    v = vectors[vector_col].cast("array<double>")
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < EXACT))
    x = F.transform(v, lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long"))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), F.when(F.coalesce(whole, F.lit(False)) & (F.size(v) > 0), x).alias("x"))
    return rows.where("x IS NOT NULL")


def _usual_length(rows: DataFrame) -> int | None:
    found = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found and found.d


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _partial_sums(batches: Iterator[pa.RecordBatch], of: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            part = of(_matrix(batch)).ravel()
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int64)), pa.array(total)], ["at", "value"])


def _summed(fit: DataFrame, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind: str = "double") -> np.ndarray:
    """Sum of ``of`` over blocks of rows: a number per entry comes to the driver, whatever the rows."""
    parts = fit.select("x").mapInArrow(partial(_partial_sums, of=of), f"at long, value {kind}")
    total = "value" if kind == "double" else F.col("value").cast("decimal(38,0)")
    out = np.zeros(int(np.prod(shape)), object if kind == "long" else float)
    for row in parts.groupBy("at").agg(F.sum(total).alias("value")).collect():
        out[row["at"]] = int(row["value"]) if kind == "long" else row["value"]
    return out.reshape(shape)


def _shifted(x: np.ndarray) -> np.ndarray:
    return (x - SHIFT).sum(axis=0)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``(n * x - sums) / n`` with the numerator exact where it fits a long."""
    low = x - SHIFT
    if n * float(np.abs(low).max(initial=0)) + float(np.abs(sums).max(initial=0)) < 2**62:
        return (n * low - sums) / n
    return low - sums.astype(float) / n


def _product(x: np.ndarray, n: int, sums: np.ndarray, to: np.ndarray) -> np.ndarray:
    rows = _centred(x, n, sums)
    return rows.T @ (rows @ to)


def _square(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return np.array([(_centred(x, n, sums) ** 2).sum()])


def _whitened(x: np.ndarray, n: int, sums: np.ndarray, to: np.ndarray) -> np.ndarray:
    return _centred(x, n, sums) @ to


def _whitened_sum(x: np.ndarray, n: int, sums: np.ndarray, to: np.ndarray) -> np.ndarray:
    return _whitened(x, n, sums, to).sum(axis=0)


def _whitened_square(x: np.ndarray, n: int, sums: np.ndarray, to: np.ndarray, mean: np.ndarray) -> np.ndarray:
    z = _whitened(x, n, sums, to) - mean
    return z.T @ z


def _orthonormal(t: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of ``t`` have outside ``against``."""
    kept = against
    for column in t.T:
        size = np.linalg.norm(column)
        if not np.isfinite(size) or size == 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - kept @ (kept.T @ column)
        size = np.linalg.norm(column)
        if size > 1e-10:
            column = column / size
            column = column - kept @ (kept.T @ column)
            kept = np.column_stack([kept, column / np.linalg.norm(column)])
    return kept[:, against.shape[1] :]


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """MINRES on every column of ``b`` at once; ``apply`` takes and gives all columns.

    A column that is solved to ``enough`` of its right side, or whose Krylov space is used
    up, stays as it is while the others go on.
    """
    size = np.linalg.norm(b, axis=0)
    live = size > 0
    x, old, now = np.zeros_like(b), np.zeros_like(b), np.divide(b, size, out=np.zeros_like(b), where=live)
    beta, phi = np.zeros(b.shape[1]), size.copy()
    c, s = -np.ones(b.shape[1]), np.zeros(b.shape[1])
    step, step_old = np.zeros_like(b), np.zeros_like(b)
    delta_next, eps = np.zeros(b.shape[1]), np.zeros(b.shape[1])
    for _ in range(steps):
        if not live.any():
            break
        p = apply(now) - beta * old
        alpha = (now * p).sum(axis=0)
        p = p - alpha * now
        after = np.linalg.norm(p, axis=0)
        delta = c * delta_next + s * alpha
        gamma_bar = s * delta_next - c * alpha
        eps_now, eps = eps, s * after
        delta_next = -c * after
        gamma = np.hypot(gamma_bar, after)
        usable = live & (gamma > 0)
        c, s = (np.divide(g, gamma, out=np.zeros_like(gamma), where=usable) for g in (gamma_bar, after))
        tau, phi = c * phi, s * phi
        fresh = np.divide(now - delta * step - eps_now * step_old, gamma, out=np.zeros_like(b), where=usable)
        x = x + np.where(usable, tau, 0) * fresh
        step_old, step = step, fresh
        live = usable & (np.abs(phi) > enough * size) & (after > 1e-14 * np.maximum(np.abs(alpha), 1e-300))
        old, now = now, np.divide(p, after, out=np.zeros_like(p), where=live)
        beta = after
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric operator on ``d`` numbers, falling, their
    unit vectors as columns, and the norms of their residuals.

    ``product`` gives the operator's product with the columns of a matrix. Pairs are locked
    from the largest on, when their residual is at rounding level: below ``8 * eps * sqrt(d)``
    of the largest eigenvalue, or when the space can't grow any more.
    """
    most = min(d, max(WIDE * k, k + 8))
    basis = _orthonormal(np.random.default_rng(0).standard_normal((d, min(d, k + 4))), np.zeros((d, 0)))
    image = product(basis)
    best = np.inf
    stuck = 0
    for turn in range(ROUNDS):
        small = basis.T @ image
        values, inside = np.linalg.eigh((small + small.T) / 2)
        values, inside = values[::-1], inside[:, ::-1]
        ritz, ritz_image = basis @ inside, image @ inside
        residual = ritz_image[:, :k] - ritz[:, :k] * values[:k]
        norms = np.linalg.norm(residual, axis=0)
        level = 8 * np.finfo(float).eps * np.sqrt(d) * max(values[0], 0.0)
        open_ones = [i for i in range(min(k, len(values))) if norms[i] > level]
        # sums in another order differ in their last digits; no gain in two rounds means that they are all that is left
        worst = norms.max(initial=0.0)
        stuck = stuck + 1 if worst > 0.5 * best and worst <= 1e3 * level else 0
        best = min(best, worst)
        if not open_ones or stuck >= 2:
            break
        if basis.shape[1] == d:
            # the space is whole: only rounding is left, which fresh products of the Ritz vectors settle
            basis, _ = np.linalg.qr(ritz)
            image = product(basis)
            stuck += 1
            continue
        if basis.shape[1] + len(open_ones) > most:
            keep = min(ritz.shape[1], k + max(4, k // 2), most - len(open_ones))
            basis, image = ritz[:, :keep], ritz_image[:, :keep]
        near, shift = ritz[:, :k], values[open_ones]

        def outside(t: np.ndarray, near: np.ndarray = near) -> np.ndarray:
            return t - near @ (near.T @ t)

        def corrected(t: np.ndarray, shift: np.ndarray = shift) -> np.ndarray:
            inner = outside(t)
            return outside(product(inner) - inner * shift)

        found = minres(corrected, -outside(residual[:, open_ones]), INNER, max(1e-4, 0.5 ** (turn + 1)))
        more = _orthonormal(outside(found), basis)
        if not more.shape[1]:
            more = _orthonormal(np.random.default_rng(turn + 1).standard_normal((d, 1)), basis)
        basis, image = np.column_stack([basis, more]), np.column_stack([image, product(more)])
    flips = np.where(np.take_along_axis(ritz[:, :k], np.abs(ritz[:, :k]).argmax(axis=0)[None], axis=0)[0] < 0, -1.0, 1.0)
    return values[:k], ritz[:, :k] * flips, norms


def fit_components(fit: DataFrame, d: int, k: int) -> Components | None:
    """The ``k`` leading components of the rows of ``fit``, column ``x``; ``None`` without rows.

    Fewer come back where there are fewer dimensions, or where the rows span fewer.
    """
    n = fit.count()
    if not n:
        return None
    shifted = _summed(fit, _shifted, (d,), "long")
    sums = np.array(shifted, np.int64) if all(abs(s) < 2**62 for s in shifted) else np.array(shifted, float)
    given = {"n": n, "sums": sums}
    made = 0

    def product(to: np.ndarray) -> np.ndarray:
        nonlocal made
        made += 1
        return _summed(fit, partial(_product, **given, to=to), to.shape) / n

    trace = float(_summed(fit, partial(_square, **given), (1,))[0]) / n
    if trace == 0:
        return Components(n, [int(s) + n * SHIFT for s in shifted], np.zeros((d, 0)), np.zeros(0), 0.0, 0.0, np.zeros(0), made)
    values, vectors, residuals = jacobi_davidson(product, d, min(k, d))
    whole = values > RANK * values[0]
    values, vectors, residuals = values[whole], vectors[:, whole], residuals[whole]
    to = vectors / np.sqrt(values)
    mean = _summed(fit, partial(_whitened_sum, **given, to=to), (len(values),)) / n
    square = _summed(fit, partial(_whitened_square, **given, to=to, mean=mean), (len(values), len(values))) / n
    error = float(np.abs(square - np.eye(len(values))).max())
    return Components(n, [int(s) + n * SHIFT for s in shifted], vectors, values, trace, error, residuals, made)


def _whiten(batches: Iterator[pa.RecordBatch], found: Components) -> Iterator[pa.RecordBatch]:
    sums = [s - found.n * SHIFT for s in found.sums]
    exact = all(abs(s) < 2**62 for s in sums)
    low = np.array(sums, np.int64) if exact else np.array(sums, float)
    to = found.vectors / np.sqrt(found.values)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch)
        z = _whitened(x, found.n, low, to)
        largest = found.n * float(np.abs(x - SHIFT).max(initial=0)) + max(map(abs, sums))
        if exact and x.shape[1] * largest**2 < 2**62:
            off = ((found.n * (x - SHIFT) - low) ** 2).sum(axis=1)
        else:
            off = [sum((found.n * (int(a) - SHIFT) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
        lists = pa.ListArray.from_arrays(np.arange(0, z.size + 1, max(1, z.shape[1]), dtype=np.int32), z.ravel()) if z.shape[1] else pa.array([[]] * len(x), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(off, pa.int64()), lists], ["vec_id", "deviation", "whitened"])


def whitened(vectors: DataFrame, k: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Components | None]:
    """``(vec_id, deviation, whitened)`` of every row that :func:`longs` keeps, and the fit.

    The fit is over each distinct vector once. ``deviation`` is the exact sum over dimensions
    of ``(n * x - sums)^2``; where it is beyond a long the job fails. Without rows the result
    is empty; where all vectors are equal no component has a direction and the lists are empty.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "whitening")
    schema = "vec_id long, deviation long, whitened array<double>"
    rows = work.put(longs(vectors, id_col, vector_col), "longs")
    d = _usual_length(rows)
    if d is None:
        return spark.createDataFrame([], schema), None
    rows = rows.where(F.size("x") == d)
    fit = work.put(rows.groupBy("x").agg(F.count("*").alias("n_rows")).select("x"), "fit")
    found = fit_components(fit, d, k)
    work.drop(fit)
    return rows.mapInArrow(partial(_whiten, found=found), schema), found
