"""Embedding whitening by contour integration (FEAST, operator 12).

1. Vectors become integers, ``floor(scale * component)``.  The fit list holds each
   distinct vector once.  Its count, sums and products about an integer centre near the mean are
   gathered exactly: tasks split products into limbs that Spark adds as longs, so
   the covariance is rounded once, from its exact fraction.
2. Components: the covariance V of the dimensions (no larger when rows are added)
   is sliced into intervals of few eigenvalues.  For each, the projector on the
   eigenvectors inside a circle around the interval is a quadrature of solves with the
   complex shifted V; Rayleigh-Ritz on the projected vectors gives eigenpairs, and the steps
   repeat until residuals vanish.
3. Inertia: the signs of the pivots of V - sI say how many eigenvalues lie beyond
   s.  They place the slices, and a slice is done only when it holds exactly as
   many converged pairs; else more directions are taken.
4. Whitening projects every row on the components, over the roots of their
   eigenvalues; a pass over the fit list measures how far its covariance is from the identity.

Rows whose vector is null or holds a null or non-finite component, or one whose
integer no long holds, are left out.  Shorter vectors are filled with zeros.
Repeated rows are in the fit list once and in the result each; a null id stays
null.  Components without variance (one distinct vector, dependent dimensions)
have explained 0 and a null projection; a deviation beyond a long is null; vectors
without components and empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, narrow

SCALE = 256
#: Quadrature nodes on the half circle, and eigenvalues of a slice at most (if they can be parted).
NODES, SLICE = 8, 12
#: Residual of a converged pair and size of a vanishing eigenvalue, as shares of the norm of V.
RESIDUAL, VANISHING = 2e-14, 1e-14
#: Steps of a slice before it takes more directions.
STEPS = 20
#: Bits of the limbs of factors and of sums; rows whose products of limbs are exact in a double.
FACTOR_BITS, SUM_BITS, EXACT_ROWS = 20, 40, 4096


# --- eigenpairs of a symmetric matrix ---

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the inertia of ``v`` at every shift (Householder)."""
    a = v.copy()
    for k in range(len(a) - 2):
        u = a[k + 1:, k].copy()
        u[0] += np.copysign(np.linalg.norm(u), u[0])
        size = u @ u
        if size > 0:
            a[k + 1:, k:] -= np.outer(u, (2 / size) * (u @ a[k + 1:, k:]))
            a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ u, (2 / size) * u)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(t: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Eigenvalues over ``shift``: positive pivots of the shifted matrix."""
    diagonal, beside = t
    least = np.finfo(float).tiny ** 0.5
    count, pivot = 0, 1.0
    for i, d in enumerate(diagonal.tolist()):
        pivot = d - shift - (beside[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < least:
            pivot = -least
        count += pivot > 0
    return count


def slices(t: tuple[np.ndarray, np.ndarray], k: int, top: float) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside), high ones first, that together hold the k largest at least."""
    low, high, within = -0.01 * top, top, count_above(t, -0.01 * top)
    bottom = low
    # the largest shift (to a thousandth) that has k eigenvalues over it
    for _ in range(60):
        if high - low < 1e-3 * max(high, 1e-12):
            break
        mid = (low + high) / 2
        low, high = (mid, high) if count_above(t, mid) >= k else (low, mid)
    within, parts = count_above(t, low), []
    pending = [(max(low, bottom), top, within)]
    while pending:
        a, b, c = pending.pop()
        if c > SLICE and b - a > 1e-6 * top:
            mid = (a + b) / 2
            above = count_above(t, mid) - count_above(t, b)
            pending += [(a, mid, c - above), (mid, b, above)]
        elif c:
            parts.append((a, b, c))
    return parts


def resolvents(v: np.ndarray, low: float, high: float, nodes: int) -> list[np.ndarray]:
    """Weighted inverses of v shifted to the nodes of the upper half of the circle through low and high."""
    x, weight = np.polynomial.legendre.leggauss(nodes)
    middle, radius, unit = (low + high) / 2, (high - low) / 2, np.eye(len(v))
    turns = zip(radius * np.exp(0.5j * np.pi * (1 - x)), weight, strict=True)
    return [0.5 * w * turn * np.linalg.inv((middle + turn) * unit - v) for turn, w in turns]


def eigenpairs(v: np.ndarray, low: float, high: float, count: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in (low, high] and their vectors (columns), largest first.

    ``count`` is the inertia's; too few converged pairs in ``STEPS`` steps double the directions, and
    with all of them Rayleigh-Ritz is the whole problem.
    """
    width = min(len(v), 2 * count + 4)
    shifted = resolvents(v, low, high, nodes) if width < len(v) else []
    while True:
        y = np.linalg.qr(np.random.default_rng(width).standard_normal((len(v), width)))[0]
        for _ in range(STEPS):
            # the quadrature's lower half is the conjugate of the upper one
            basis = np.linalg.qr(sum((r @ y).real for r in shifted) if width < len(v) else y)[0]
            value, turn = np.linalg.eigh(basis.T @ v @ basis)
            y = basis @ turn
            inside = np.flatnonzero((value > low) & (value <= high))[::-1]
            residual = np.linalg.norm(v @ y[:, inside] - y[:, inside] * value[inside], axis=0)
            if len(inside) == count and (residual <= RESIDUAL * len(v) ** 0.5).all():
                return value[inside], y[:, inside]
            if width == len(v):
                break
        if width == len(v):
            # rounding may put a value at an edge on its other side: the nearest ones inside
            best = np.argsort(np.maximum(low - value, value - high), kind="stable")[:count]
            best = best[np.argsort(-value[best], kind="stable")]
            return value[best], y[:, best]
        width = min(len(v), 2 * width)


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a positive semidefinite matrix (those that don't vanish) and unit vectors."""
    norm = float(np.abs(v).sum(axis=1).max(initial=0))
    if not norm:
        return np.zeros(0), np.zeros((len(v), 0))
    v = v / norm
    t = tridiagonal(v)
    k = min(k, count_above(t, VANISHING * len(v)))
    if not k:
        return np.zeros(0), np.zeros((len(v), 0))
    found = [eigenpairs(v, *part) for part in slices(t, k, 1 + 1e-9)]
    basis = np.linalg.qr(np.concatenate([y for _, y in found], axis=1))[0]
    value, turn = np.linalg.eigh(basis.T @ v @ basis)
    best = np.argsort(-value, kind="stable")[:k]
    y = basis @ turn[:, best]
    sign = np.sign(y[np.abs(y).argmax(axis=0), np.arange(k)])
    return value[best] * norm, y * sign


# --- exact sums ---

def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """x as sum of parts * 2**(bits * place): all but the last are under 2**bits, the last has the sign."""
    out = []
    while len(x) and max(-int(x.min()), int(x.max())) >= 1 << bits:
        out.append(x & ((1 << bits) - 1))
        x = x >> bits
    return [*out, x]


def centred(x: np.ndarray, centre: np.ndarray, times: int = 1) -> np.ndarray:
    """times * x - centre, in Python integers where longs might not hold it."""
    most = times * max(-int(x.min(initial=0)), int(x.max(initial=0))) + max([abs(int(c)) for c in centre], default=0)
    if most < 1 << 62:
        return times * x - np.array(centre, np.int64)
    return times * x.astype(object) - np.array(centre, object)


def products(x: np.ndarray) -> np.ndarray:
    """x^T x of integers, exact, as Python integers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for at in range(0, len(x), EXACT_ROWS):
        parts = [p.astype(float) for p in limbs(x[at:at + EXACT_ROWS], FACTOR_BITS)]
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                total += (a.T @ b).astype(np.int64).astype(object) << (FACTOR_BITS * (i + j))
    return total


def moments(fit: DataFrame, centre: list[int], second: bool) -> dict[tuple[int, int], int]:
    """Exact sums over the fit list of x - centre, at (i, -1), and of its products, at (i, j); the count at (-1, -1)."""
    width = len(centre)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, first, both = 0, np.zeros(width, object), np.zeros((width, width), object)
        for pdf in batches:
            if len(pdf):
                d = centred(matrix(pdf["x"], width), np.array(centre, object))
                count += len(d)
                first += d.astype(object).sum(axis=0)
                if second:
                    both += products(d)
        rows = [(-1, -1, count), *((i, -1, s) for i, s in enumerate(first))]
        if second:
            rows += [(i, j, both[i, j]) for i in range(width) for j in range(i + 1)]
        out = []
        for i, j, s in rows:
            place, left = 0, int(s)
            while left.bit_length() > SUM_BITS:
                out.append((i, j, place, left & ((1 << SUM_BITS) - 1)))
                left >>= SUM_BITS
                place += 1
            if left:
                out.append((i, j, place, left))
        yield pd.DataFrame(out, columns=["i", "j", "place", "part"])

    sums = fit.mapInPandas(gather, "i int, j int, place int, part long").groupBy("i", "j", "place").agg(F.sum("part").alias("part"))
    total: dict[tuple[int, int], int] = {}
    for r in sums.collect():  # a few rows for each pair of dimensions
        total[r["i"], r["j"]] = total.get((r["i"], r["j"]), 0) + (int(r["part"]) << (SUM_BITS * r["place"]))
    return total


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[:len(v)] = v
    return out


# --- the operator ---

def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows (vec_id, x array<long>) of the vectors that take part."""
    src = narrow(df, vec_id=id_col, v=vector_col).withColumn("v", F.col("v").cast("array<double>"))
    good = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) * scale < 2.0 ** 63), F.lit(False)))
    # floor gives longs, in which no zero is negative
    return src.where(F.col("v").isNotNull() & good).select("vec_id", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))


class Whitening:
    """Exact mean and deviation, components and their eigenvalues, of ``n`` distinct vectors."""

    def __init__(self, n: int, total: list[int], covariance: np.ndarray, components: int):
        self.n, self.total, self.trace = n, total, float(np.trace(covariance))
        self.values, self.vectors = leading(covariance, components)
        self.shown = min(components, len(total))

    def project(self, deviation: np.ndarray) -> np.ndarray:
        """Rows of n * x - total on the components, over the roots of their eigenvalues."""
        d = deviation.astype(float) / self.n
        out = np.zeros((len(d), len(self.values)))
        for column, row in zip(d.T, self.vectors / np.sqrt(self.values), strict=True):
            out += column[:, None] * row  # in one order for all rows: equal rows get equal results
        return out


def fit(vectors: DataFrame, components: int = 4) -> tuple[Whitening, DataFrame] | None:
    """The whitening of (vec_id, x) rows and the written fit list; None without rows or dimensions."""
    width = vectors.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return None
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    distinct = materialize(vectors.select(filled.alias("x")).distinct(), "fit-list")
    sums = moments(distinct, [0] * width, second=False)
    n, total = sums[-1, -1], [sums.get((i, -1), 0) for i in range(width)]
    centre = [(2 * s + n) // (2 * n) for s in total]
    sums = moments(distinct, centre, second=True)
    first = [sums.get((i, -1), 0) for i in range(width)]
    v = np.zeros((width, width))
    for i in range(width):
        for j in range(i + 1):
            # quotient of integers, rounded once
            v[i, j] = v[j, i] = (n * sums.get((i, j), 0) - first[i] * first[j]) / (n * n)
    return Whitening(n, total, v, components), distinct


def identity_error(model: Whitening, distinct: DataFrame) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k, width = len(model.values), len(model.total)
    if not k:
        return None

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = np.zeros((k + 1, k))
        for pdf in batches:
            if len(pdf):
                w = model.project(centred(matrix(pdf["x"], width), np.array(model.total, object), model.n))
                both[:k] += w.T @ w
                both[k] += w.sum(axis=0)
        yield pd.DataFrame([(i, j, both[i, j]) for i in range(k + 1) for j in range(k)], columns=["i", "j", "s"])

    rows = distinct.mapInPandas(gather, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    s = np.zeros((k + 1, k))
    for r in rows:
        s[r["i"], r["j"]] = r["s"] / model.n
    return float(np.abs(s[:k] - np.outer(s[k], s[k]) - np.eye(k)).max())


def whiten(df: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) of all vectors that take part."""
    vectors = integer_vectors(df, id_col, vector_col, scale)
    fitted = fit(vectors, components)
    if fitted is None:
        return vectors.where("false").select(
            "vec_id", F.lit(0).alias("component"), *[F.lit(0).cast("long").alias(c) for c in ("n", "deviation")],
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])
    model, distinct = fitted
    error, width = identity_error(model, distinct), len(model.total)

    @F.pandas_udf("struct<deviation: long, whitened: array<double>>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for xs in batches:
            d = centred(matrix(xs, width), np.array(model.total, object), model.n)
            if d.dtype != object and float(np.abs(d).max(initial=0)) ** 2 * width < 2.0 ** 62:
                squares = (d * d).sum(axis=1).tolist()
            else:
                squares = [s if s < 1 << 63 else None for s in (sum(int(c) ** 2 for c in row) for row in d)]
            yield pd.DataFrame({"deviation": pd.array(squares, "Int64"), "whitened": list(model.project(d))})

    share = [float(e / model.trace) for e in model.values] + [0.0] * (model.shown - len(model.values))
    rows = vectors.select("vec_id", project("x").alias("p")).select(
        "vec_id", "p.deviation", "p.whitened", F.explode(F.sequence(F.lit(1), F.lit(model.shown))).alias("component"))
    at = lambda c: F.get(c, F.col("component") - 1)
    return rows.select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation",
                       at(F.col("whitened")).alias("whitened"), at(F.lit(share)).alias("explained"),
                       F.lit(error).cast("double").alias("identity_error"))


__all__ = ["whiten", "fit", "leading", "Whitening"]
