"""Whitening of vectors by an incremental eigendecomposition.

Every partition keeps the eigendecomposition of its own scatter matrix and, for
each vector, applies one centred rank-one update: the new eigenvalues are the
roots of the secular equation 1 + rho sum z_i^2 / (d_i - x), entries that cannot
move are deflated first, and the eigenvectors come from weights recomputed from
the roots found, which keeps them orthogonal.  Spectra of partitions are combined
a few at a time, again by successive rank-one updates: one for each component of
the smaller side and one for the difference of the means.  The basis found is
then refined: one distributed pass projects the covariance into it, and the small
matrix that comes out is diagonalised (Rayleigh-Ritz).

A task holds one d x d basis and one batch of vectors; d x d sums are added by
Spark, so nothing that grows with the vectors reaches a task or the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from countloom.llm.ship import ship
from countloom.llm.store import stored

COMPONENTS = 32
#: Fixed values of the integer grid: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Spectra that one task combines, and longest vector (its basis has that many squared entries).
FAN, MAX_SIZE = 16, 4096
#: Components with a smaller share of the trace count as none: their values would be rounding noise.
LEAST_SHARE = 1e-12
EPS = float(np.finfo(float).eps)
SPECTRUM = "n long, mean array<double>, values array<double>, vectors array<double>"


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho sum z_j^2 / (d_j - x) for ascending distinct d, |z| = 1, rho > 0.

    Returns (index of the pole each root is measured from, offset from that pole).
    Root i lies between d_i and d_i+1, the last one below d_last + rho.  Each is
    found by steps that match the slopes of the two sums to the left and to the
    right, kept inside a bracket that bisection halves when a step leaves it.
    """
    k = len(d)
    z2 = rho * z * z
    gap = np.append(np.diff(d), rho)
    rows = np.arange(k)
    # The nearer pole: the sign of the function in the middle of the interval says on which side the root lies.
    middle = d + gap / 2
    value = 1.0 + (z2[None, :] / (d[None, :] - middle[:, None])).sum(axis=1)
    right = (value < 0) & (rows < k - 1)
    pole = rows + right
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where((value < 0) & (rows == k - 1), gap, gap / 2))
    low = np.where((value < 0) & (rows == k - 1), gap / 2, low)
    delta = d[None, :] - d[pole][:, None]
    out = np.zeros(k)
    active, x = rows, (low + high) / 2
    left = rows[None, :] <= rows[:, None]
    to_left, last = delta[rows, rows], rows == k - 1
    to_right = delta[rows, np.minimum(rows + 1, k - 1)]
    tiny = np.finfo(float).tiny
    for _ in range(80):
        away = delta - x[:, None]
        ratio = z2 / away
        value = 1.0 + ratio.sum(axis=1)
        rounding = 4 * EPS * (1.0 + np.abs(ratio).sum(axis=1))
        low, high = np.where(value < 0, x, low), np.where(value >= 0, x, high)
        done = (np.abs(value) <= rounding) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)) + tiny)
        out[active] = x
        if done.all():
            break
        if done.any():
            keep = ~done
            active, x, low, high, value = active[keep], x[keep], low[keep], high[keep], value[keep]
            delta, left, ratio, away = delta[keep], left[keep], ratio[keep], away[keep]
            to_left, to_right, last = to_left[keep], to_right[keep], last[keep]
        ratio /= away
        whole_slope = ratio.sum(axis=1)
        left_slope = np.where(last, whole_slope, (ratio * left).sum(axis=1))
        right_slope = whole_slope - left_slope
        # f(x + t) is near c + a / (p - t) + b / (q - t), with the same value and the same slope on either side.
        p, q = to_left - x, np.where(last, 1.0, to_right - x)
        a, b = left_slope * p * p, right_slope * q * q
        c = value - left_slope * p - right_slope * q
        with np.errstate(all="ignore"):
            linear = -(c * (p + q) + a + b)
            constant = c * p * q + a * q + b * p
            root = np.sqrt(np.maximum(linear * linear - 4 * c * constant, 0.0))
            large = np.where(linear > 0, -linear - root, -linear + root)
            one, two = 2 * constant / large, large / (2 * c)
            step = np.where((x + one > low) & (x + one < high), one, two)
            moved = x + np.where(last, p + a / c, step)
        inside = (moved > low) & (moved < high)
        x = np.where(inside, moved, (low + high) / 2)
    return pole, out


def rank_one_update(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigendecomposition of U diag(values) U' + rho v v' (rho >= 0), from that of the first term; values ascending."""
    z = v @ vectors
    norm = float(np.sqrt(z @ z))
    if norm == 0.0 or rho == 0.0:
        return values, vectors
    z, rho = z / norm, rho * norm * norm
    tolerance = 8 * EPS * max(abs(values[-1]), rho)
    # Equal values: turn their vectors so that one of them takes the whole share of v.
    close = np.diff(values) <= tolerance
    if close.any():
        vectors, first = vectors.copy(), 0
        for last in [*(np.flatnonzero(~close)).tolist(), len(values) - 1]:
            size = last + 1 - first
            part = z[first : last + 1]
            length = float(np.sqrt(part @ part))
            if size > 1 and length > 0:
                mirror = part.copy()
                mirror[-1] += length if part[-1] >= 0 else -length
                mirror /= np.sqrt(mirror @ mirror)
                block = vectors[:, first : last + 1]
                block -= 2.0 * np.outer(block @ mirror, mirror)
                z[first : last + 1] = 0.0
                z[last] = -length if part_sign(mirror[-1]) > 0 else length
            first = last + 1
    moving = np.flatnonzero(rho * np.abs(z) > tolerance)
    if not len(moving):
        return values, vectors
    d, w = values[moving], z[moving]
    w = w / np.sqrt(w @ w)
    pole, offset = secular_roots(d, w, rho)
    k = len(d)
    apart = (d[None, :] - d[pole][:, None]) - offset[:, None]  # d_j minus root i
    apart = np.where(apart == 0.0, np.finfo(float).tiny, apart)
    # The weights for which the roots found are exact.
    rows = np.arange(k)
    after = np.append(d[1:], 0.0)
    below = np.where(rows[:, None] < rows[None, :], d[:, None] - d[None, :], after[:, None] - d[None, :])
    below[k - 1, :] = 1.0
    weights = np.sqrt(np.abs(np.prod(-apart / below, axis=0)))
    turned = np.copysign(weights, w)[None, :] / apart
    turned /= np.sqrt((turned * turned).sum(axis=1))[:, None]
    values, vectors = values.copy(), vectors.copy()
    values[moving] = d[pole] + offset
    vectors[:, moving] = vectors[:, moving] @ turned.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def part_sign(x: float) -> float:
    return 1.0 if x >= 0 else -1.0


class Spectrum:
    """Number, mean and eigendecomposition of the scatter matrix of vectors seen one by one."""

    def __init__(self, size: int) -> None:
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def add(self, v: np.ndarray) -> None:
        off = v - self.mean
        self.values, self.vectors = rank_one_update(self.values, self.vectors, off, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + off / self.n

    def join(self, other: Spectrum) -> None:
        """Adds the scatter of ``other``, one component after another, and that between the means."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one_update(self.values, self.vectors, vector, float(value))
        off, n = other.mean - self.mean, self.n + other.n
        self.values, self.vectors = rank_one_update(self.values, self.vectors, off, self.n * (other.n / n))
        self.n, self.mean = n, self.mean + off * (other.n / n)

    def row(self) -> tuple:
        return self.n, self.mean, self.values, self.vectors.ravel()

    @classmethod
    def read(cls, n: int, mean, values, vectors) -> Spectrum:
        out = cls(len(mean))
        out.n, out.mean, out.values = int(n), np.asarray(mean), np.asarray(values)
        out.vectors = np.asarray(vectors).reshape(len(mean), len(mean))
        return out


def grid(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and all finite, with ``_x``: each entry c as floor(64 c), without the fixed shift.

    Where lengths differ, the most frequent one stays (ties: the longer); vectors without an entry go.
    """
    whole = F.col(vector).isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    )
    rows = df.where(whole & (F.size(vector) > 0))
    lengths = rows.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.col("n").desc(), F.col("d").desc()).first()
    size = first["d"] if first else 0
    if size > MAX_SIZE:
        raise ValueError(f"vectors of {size} entries: a basis is bounded at {MAX_SIZE}")
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))
    return rows.where(F.size(vector) == size).withColumn("_x", x)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()) if len(column) else np.empty((0, 0), dtype=np.int64)


def spectra(rows: DataFrame) -> DataFrame:
    """One spectrum of each partition of ``_x``."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            for v in _matrix(batch["_x"]).astype(np.float64):
                held = held or Spectrum(len(v))
                held.add(v)
        if held:
            yield pd.DataFrame([held.row()], columns=["n", "mean", "values", "vectors"])

    return rows.select("_x").mapInPandas(build, SPECTRUM)


def combine(parts: DataFrame, fan: int = FAN) -> Spectrum | None:
    """All spectra joined, ``fan`` at a time, until one is left; None without any."""

    def join(group: pd.DataFrame) -> pd.DataFrame:
        total = None
        for row in group.sort_values("seat").itertuples():
            one = Spectrum.read(row.n, row.mean, row.values, row.vectors)
            if total:
                total.join(one)
            else:
                total = one
        return pd.DataFrame([total.row()], columns=["n", "mean", "values", "vectors"])

    parts = stored(parts, "spectra")
    while (number := parts.count()) > 1:
        # One row a partition: few and narrow, so one window numbers them.
        seat = F.row_number().over(W.orderBy("n", "mean", "values")) - 1
        keyed = parts.withColumn("seat", seat).withColumn("pack", F.floor(F.col("seat") / fan).cast("int"))
        parts = stored(keyed.repartition(max(1, -(-number // fan)), "pack").groupBy("pack").applyInPandas(join, SPECTRUM), "spectra")
    row = parts.first()
    return Spectrum.read(row["n"], row["mean"], row["values"], row["vectors"]) if row else None


def _moments(rows: DataFrame, project, size: int) -> np.ndarray:
    """Sum of p p' over the projected vectors p, made of one matrix a batch; the entries are added by Spark."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            if len(batch):
                p = project(_matrix(batch["_x"]))
                total += p.T @ p
        yield pd.DataFrame({"i": np.arange(size * size), "v": total.ravel()})

    summed = rows.select("_x").mapInPandas(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    out = np.zeros(size * size)
    for r in summed.collect():  # d x d numbers
        out[r["i"]] = r["v"]
    return out.reshape(size, size)


def whiten(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``whitened``, an array of the first ``components`` coordinates, for every row with a whole vector.

    Further columns: ``n``, ``deviation`` (decimal, exact sum of (n x - S)^2),
    ``explained`` (array, share of the trace of each component), ``identity_error``
    (largest deviation of the whitened covariance from the identity).  Rows with a
    null vector, or one with null, NaN or infinite entries, go, and so do vectors of
    another than the most frequent length.  Components whose variance is below 1e-12
    of the trace have no whitened value and are left out: n, fewer than two distinct
    vectors or a constant table give empty arrays and no error.  Repeated rows count
    as often as they come; columns of these names are replaced.
    """
    ship(df.sparkSession)
    names = ("whitened", "n", "deviation", "explained", "identity_error")
    kept = [c for c in df.columns if c not in names]
    inner = grid(df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)]), f"k{kept.index(vector)}")
    total = combine(spectra(inner))
    size = len(total.mean) if total else 0
    sums = inner.select(F.posexplode("_x")).groupBy("pos").agg(F.sum("col").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    n = sums[0]["n"] if sums else 0
    s = np.zeros(size, dtype=np.int64)
    for r in sums:
        s[r["pos"]] = r["s"]

    def centred(x: np.ndarray) -> np.ndarray:
        """x - S / n with one rounding, from whole numbers."""
        return (x * n - s) / n

    values, vectors = np.zeros(0), np.zeros((size, 0))
    explained, error = [], None
    if total:
        basis = np.linalg.qr(total.vectors)[0]
        small = _moments(inner, lambda x: centred(x) @ basis, size) / n
        found, turn = np.linalg.eigh((small + small.T) / 2)
        found, turn = found[::-1], turn[:, ::-1]
        trace = float(np.trace(small))
        enough = int(np.sum(found[:components] > LEAST_SHARE * max(trace, 0.0))) if trace > 0 else 0
        values, vectors = found[:enough], (basis @ turn)[:, :enough]
        explained = [float(v / trace) for v in values]
    shape = vectors / np.sqrt(values) if len(values) else vectors
    if len(values):
        spread = _moments(inner, lambda x: centred(x) @ shape, len(values)) / n
        error = float(np.abs(spread - np.eye(len(values))).max())

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["_x"])
            if len(x):
                off = x * n - s
                # 64-bit sums are exact while they cannot reach 2^62.
                safe = float(np.abs(off).max()) ** 2 * size < 2.0**62
                squares = (off * off).sum(axis=1) if safe else (off.astype(object) ** 2).sum(axis=1)
                batch["deviation"] = [str(int(v)) for v in squares]
                batch["whitened"] = list((off / n) @ shape)
            else:
                batch["deviation"], batch["whitened"] = [], []
            yield batch.drop(columns="_x")

    fields = [f for f in inner.schema.fields if f.name != "_x"]
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in fields], "deviation string, whitened array<double>"])
    made = inner.mapInPandas(project, schema)
    return made.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)],
        F.lit(n).cast("bigint").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened",
        F.array(*[F.lit(v) for v in explained]).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
