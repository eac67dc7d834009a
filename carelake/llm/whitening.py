"""Embedding whitening by incremental eigendecomposition.

Method
    Entry c becomes the integer x = floor(64 * c) + 1000000. A task keeps the spectrum (count, mean,
    eigenvalues, eigenvectors) of the rows it has seen and takes new rows as centred rank-one updates: the roots of
    the secular equation 1 + rho * sum(z_i^2 / (d_i - mu)) = 0, one in each gap between the old eigenvalues, with
    deflation of vanishing z_i and of equal d_i, and eigenvectors from the recomputed z (Gu and Eisenstat), which
    keeps them orthogonal. The rows of a block are first turned by an orthogonal factor to
    at most as many rows as there are dimensions, with the same scatter; with ``block_rows=1`` each row is an update of its own.
    Spectra of tasks are combined FAN_IN at a time by the same updates, one for each eigenvector of the other
    and one for the difference of the means. One distributed Rayleigh-Ritz step then takes the covariance of all
    rows in the basis found, and turns the basis to that matrix' eigenvectors, so that rounding of
    the updates doesn't stay.

Scale
    Five passes over the vectors (sums, spectra, Rayleigh-Ritz, identity check, output), none of which shuffles them.
    What is shuffled is one row of dims^2 numbers a task; ``MAX_DIMS`` bounds what reaches the driver. No key, so no skew.

Defined results
    A row is dropped if its vector is null or empty, holds a null, NaN or infinite entry or one whose x is beyond
    2^53, or has another length than most rows (ties: the longer). Repeated rows and null ids are rows of their own. An empty table gives
    no rows. A component without variance (constant dimensions, fewer rows than dimensions) has whitened and
    explained 0 and doesn't count in identity_error. Equal eigenvalues: any basis, the same for all rows.
    A deviation beyond a long is null. A component's largest entry is positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import base

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Rows that are turned to at most ``dims`` rows before they are applied; 1 applies each row by itself.
BLOCK_ROWS = 1024
#: Spectra that one task combines.
FAN_IN = 16
#: dims^2 doubles reach the driver and every task.
MAX_DIMS = 2048
#: Eigenvalues up to this share of the largest count as none.
NO_VARIANCE = 1e-12
EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - mu)) for ascending distinct d and z2 > 0.

    Returns (origin, tau): root j is ``d[origin[j]] + tau[j]``, near the pole that it lies next to,
    so that differences between roots and poles keep their relative accuracy.
    """
    k = len(d)
    w = rho * z2
    width = np.append(np.diff(d), w.sum())
    j = np.arange(k)
    with np.errstate(divide="ignore", invalid="ignore"):
        half = (w[:, None] / ((d[:, None] - d[None, :]) - width / 2)).sum(0) + 1
    right = (half < 0) & (j < k - 1)  # the root lies in the upper half: count from the upper pole
    origin = np.where(right, j + 1, j)
    poles = d[:, None] - d[origin][None, :]
    lo = np.where(right, -width / 2, 0.0)
    hi = np.where(right, 0.0, np.where(j < k - 1, width / 2, width))
    if k and half[-1] > 0:
        hi[-1] = width[-1] / 2
    elif k:
        lo[-1] = width[-1] / 2
    below = j[None, :] >= np.arange(k)[:, None]  # poles at or below the root
    gap_lo = poles[j, j]  # the two poles next to the root, as seen from the origin
    gap_hi = np.where(j < k - 1, poles[np.minimum(j + 1, k - 1), j], np.inf)
    x = (lo + hi) / 2
    for _ in range(100):
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            t = w[:, None] / (poles - x)
            f = 1 + t.sum(0)
            size = 1 + np.abs(t).sum(0)
            up = f < 0
            lo, hi = np.where(up, x, lo), np.where(up, hi, x)
            slope = t / (poles - x)
            s_lo, s_hi = np.where(below, slope, 0).sum(0), np.where(below, 0, slope).sum(0)
            # two poles with the slopes of the sums below and above: c + a/(gap_lo - x) + b/(gap_hi - x)
            a, b = s_lo * (gap_lo - x) ** 2, np.where(np.isinf(gap_hi), 0.0, s_hi * (gap_hi - x) ** 2)
            c = f - a / (gap_lo - x) - np.where(np.isinf(gap_hi), 0.0, b / (gap_hi - x))
            # in the step y: (c)(dl - y)(dh - y) + a(dh - y) + b(dl - y) = 0
            dl, dh = gap_lo - x, gap_hi - x
            qa, qb, qc = c, -(c * (dl + dh) + a + b), c * dl * dh + a * dh + b * dl
            root = np.sqrt(np.maximum(qb * qb - 4 * qa * qc, 0))
            q = -0.5 * (qb + np.where(qb < 0, -root, root))
            y1, y2 = q / qa, qc / q
            step = np.where((x + y1 > lo) & (x + y1 < hi), y1, y2)
            step = np.where(np.isinf(gap_hi), dl + a / c, step)  # one pole: c + a/(dl - y) = 0
            new = x + step
        bad = ~np.isfinite(new) | (new <= lo) | (new >= hi)
        # far from any fit, halve the bracket; next to the origin by ratio, as the root may be tiny
        near = np.where(lo > 0, np.sqrt(np.maximum(lo, 0) * np.maximum(hi, 0)),
                        np.where(hi < 0, -np.sqrt(np.maximum(-lo, 0) * np.maximum(-hi, 0)), (lo + hi) / 2))
        new = np.where(bad, near, new)
        done = (np.abs(f) <= 4 * EPS * k * size) | (hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
        new = np.where(done, x, new)
        if done.all():
            break
        x = new
    return origin, x


def rank_one(d: np.ndarray, u: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of u diag(d) u' + rho v v', for rho > 0."""
    z = u.T @ v
    norm = np.sqrt(z @ z)
    if norm == 0 or rho <= 0:
        return d, u
    z, rho = z / norm, rho * norm * norm
    tol = 8 * EPS * max(np.abs(d).max(), rho)
    u = u.copy()
    live = rho * np.abs(z) > tol
    at = np.flatnonzero(live)
    last = -1
    if len(at) > 1 and (np.diff(d[at]) <= tol).any():
        for i in at:  # equal eigenvalues: turn the pair so that all of z is in the later one
            if last >= 0 and d[i] - d[last] <= tol:
                r = np.hypot(z[last], z[i])
                c, s = z[i] / r, z[last] / r
                u[:, last], u[:, i] = c * u[:, last] - s * u[:, i], s * u[:, last] + c * u[:, i]
                z[last], z[i] = 0.0, r
                live[last] = False
            last = i
        at = np.flatnonzero(live)
    d = d.copy()
    if len(at):
        da = d[at]
        origin, tau = secular_roots(da, z[at] ** 2, rho)
        diff = (da[:, None] - da[origin][None, :]) - tau  # pole i less root j
        k = len(at)
        with np.errstate(divide="ignore"):
            poles = np.abs(da[:, None] - da[None, :])
            poles[np.arange(k), np.arange(k)] = 1.0
            log = np.log(np.abs(diff)).sum(1) - np.log(poles).sum(1)
        zz = np.exp(0.5 * log) * np.where(z[at] < 0, -1.0, 1.0)
        q = zz[:, None] / diff
        q /= np.sqrt((q * q).sum(0))
        u[:, at] = u[:, at] @ q
        d[at] = da[origin] + tau
    order = np.argsort(d, kind="stable")
    return d[order], u[:, order]


class Spectrum:
    """Count, mean, and eigenvalues and eigenvectors of the scatter around the mean."""

    def __init__(self, dims: int):
        self.n, self.mean, self.d, self.u = 0, np.zeros(dims), np.zeros(dims), np.eye(dims)

    def _shift(self, n: int, mean: np.ndarray) -> None:
        delta = mean - self.mean
        if self.n:
            self.d, self.u = rank_one(self.d, self.u, self.n * n / (self.n + n), delta)
        self.mean = self.mean + delta * (n / (self.n + n))
        self.n += n

    def add(self, rows: np.ndarray) -> None:
        """Rows of a block: centred on their own mean, turned to at most ``dims`` rows, then one update each."""
        mean = rows.mean(0)
        mid = rows - mean
        if len(mid) > mid.shape[1]:
            mid = np.linalg.qr(mid, mode="r")
        if len(rows) > 1:
            for r in mid:
                self.d, self.u = rank_one(self.d, self.u, 1.0, r)
        self._shift(len(rows), mean)

    def merge(self, other: "Spectrum") -> None:
        for e, v in zip(other.d, other.u.T):
            if e > 0:
                self.d, self.u = rank_one(self.d, self.u, e, v)
        self._shift(other.n, other.mean)

    def pack(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.d, self.u.ravel()]).astype("<f8").tobytes()

    @classmethod
    def unpack(cls, data: bytes, dims: int) -> "Spectrum":
        x, s = np.frombuffer(data, "<f8"), cls(dims)
        s.n, s.mean, s.d, s.u = int(x[0]), x[1:dims + 1], x[dims + 1:2 * dims + 1], x[2 * dims + 1:].reshape(dims, dims)
        return s


def vectors(col: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, x as longs) of a batch's usable rows; with no ``dims``, the row numbers and their lengths."""
    n = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    flat = pc.fill_null(col.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(SCALE * flat)
        bad = ~(np.abs(x) <= 2.0 ** 53 - SHIFT)
    ends = np.cumsum(n)
    worst = np.concatenate([[0], np.cumsum(bad)])
    ok = (n > 0) & (worst[ends] == worst[ends - n])
    if dims is None:
        return np.flatnonzero(ok), n[ok]
    ok &= n == dims
    if ok.all():
        return np.arange(len(n)), x.astype(np.int64).reshape(-1, dims) + SHIFT
    rows = np.flatnonzero(ok)
    at = (ends - n)[rows][:, None] + np.arange(dims)
    return rows, x[at].astype(np.int64).reshape(-1, dims) + SHIFT


def _plain(df: DataFrame, vec: str) -> DataFrame:
    return df.select(F.col(base._q(vec)).cast("array<double>").alias("v"))


def _blocks(batches, dims: int, rows: int) -> Iterator[np.ndarray]:
    """The usable rows' x, ``rows`` at a time."""
    held, n = [], 0
    for b in batches:
        x = vectors(b.column(0), dims)[1]
        while len(x):
            held.append(x[:rows - n])
            n += len(held[-1])
            x = x[len(held[-1]):]
            if n == rows:
                yield np.concatenate(held)
                held, n = [], 0
    if n:
        yield np.concatenate(held)


def sums(df: DataFrame, vec: str = "embedding") -> tuple[int, np.ndarray] | None:
    """Row count and per-dimension sums of x over the fit list; None if it is empty."""
    lengths = base.emit(_plain(df, vec), ["v"], "dims long, n long", lambda bs: (
        {"dims": k, "n": c} for b in bs for k, c in [np.unique(vectors(b.column(0))[1], return_counts=True)]))
    top = lengths.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if top is None:
        return None
    dims = int(top.dims)
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} dimensions; at most {MAX_DIMS}")

    def add(batches):
        total = np.zeros(dims, np.int64)
        for b in batches:
            total += vectors(b.column(0), dims)[1].sum(0)
        yield {"dim": np.arange(dims), "s": total}

    got = base.emit(_plain(df, vec), ["v"], "dim int, s long", add).groupBy("dim").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(dims, np.int64)
    for r in got:
        out[r.dim] = r.s
    return int(top.n), out


def spectrum(df: DataFrame, dims: int, vec: str = "embedding", block_rows: int = BLOCK_ROWS) -> Spectrum:
    """The spectrum of all usable rows, from those of the tasks, FAN_IN at a time."""
    def fit(batches):
        s = Spectrum(dims)
        for x in _blocks(batches, dims, block_rows):
            s.add((x - SHIFT).astype(float))
        if s.n:
            yield {"part": [0], "data": [s.pack()]}

    def combine(part, rows):
        out = Spectrum(dims)
        for data in rows.column("data").to_pylist():
            out.merge(Spectrum.unpack(data, dims))
        return pa.table({"part": part[0:1] if part else pa.array([0], pa.int64()), "data": [out.pack()]})

    found = base.stash(base.emit(_plain(df, vec), ["v"], "part long, data binary", fit).select(
        F.monotonically_increasing_id().alias("id"), "data"), "spectra")
    n = found.count()
    while n > 1:
        n = -(-n // FAN_IN)
        dealt = found.select(F.pmod(F.xxhash64("id"), F.lit(n)).alias("part"), "data")
        found = base.stash(dealt.groupBy("part").applyInArrow(combine, "part long, data binary")
                           .select(F.col("part").alias("id"), "data"), "spectra")
        n = found.count()
    return Spectrum.unpack(bytes(found.first().data), dims)


def second_moments(df: DataFrame, turn: np.ndarray, n: int, total: np.ndarray, vec: str = "embedding") -> np.ndarray:
    """Mean of y y' over all rows, y = (x - S/n) turn: sums of tasks, added in a shuffle by matrix row."""
    dims, k = turn.shape

    def add(batches):
        m = np.zeros((k, k))
        for x in _blocks(batches, dims, BLOCK_ROWS):
            y = centred(x, n, total) @ turn
            m += y.T @ y
        yield {"row": np.arange(k), "m": list(m)}

    out = np.zeros((k, k))
    parts = base.emit(_plain(df, vec), ["v"], "row int, m array<double>", add)
    for r in parts.select("row", F.posexplode("m").alias("col", "x")).groupBy("row", "col").agg(F.sum("x").alias("x")).toLocalIterator():
        out[r.row, r.col] = r.x
    return out / n


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x - S/n: the whole part of the mean is taken off in integers."""
    whole = total // n
    return (x - whole).astype(float) - (total - whole * n) / n


def fit(df: DataFrame, vec: str = "embedding", components: int = COMPONENTS, block_rows: int = BLOCK_ROWS):
    """(n, S, eigenvectors as columns, eigenvalues, trace) of all rows, by falling eigenvalue; None for an empty table."""
    got = sums(df, vec)
    if got is None:
        return None
    n, total = got
    dims = len(total)
    basis = spectrum(df, dims, vec, block_rows).u[:, ::-1]
    basis = np.linalg.qr(basis)[0]
    v = second_moments(df, basis, n, total, vec)
    e, w = np.linalg.eigh((v + v.T) / 2)
    e, basis = e[::-1], basis @ w[:, ::-1]
    trace = float(np.trace(v))
    basis = basis * np.where(basis[np.abs(basis).argmax(0), np.arange(dims)] < 0, -1.0, 1.0)
    e = np.where(e > NO_VARIANCE * max(e[0], 0.0), e, 0.0)
    k = min(components, dims)
    return n, total, basis[:, :k], e[:k], trace


def whiten(df: DataFrame, id_col: str = "vec_id", vec: str = "embedding", components: int = COMPONENTS,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row ``vec_id, component, n, deviation, whitened, explained, identity_error`` for each usable row and component."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    model = fit(df, vec, components, block_rows)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    n, total, basis, e, trace = model
    dims, k = basis.shape
    turn = basis * np.where(e > 0, 1 / np.sqrt(np.where(e > 0, e, 1)), 0.0)
    cov = second_moments(df, turn, n, total, vec)
    error = float(np.abs((cov - np.eye(k))[np.ix_(e > 0, e > 0)]).max(initial=0.0))
    explained = e / trace if trace > 0 else e

    def run(batches):
        for b in batches:
            rows, x = vectors(b.column(1), dims)
            for a in range(0, len(rows), BLOCK_ROWS):
                r, xs = rows[a:a + BLOCK_ROWS], x[a:a + BLOCK_ROWS]
                y = centred(xs, n, total) @ turn
                ids = b.column(0).take(pa.array(np.repeat(r, k)))
                m = len(r)
                dev = pa.array(deviations(xs, n, total), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield {"vec_id": ids, "component": np.tile(np.arange(1, k + 1), m), "n": np.full(m * k, n), "deviation": dev,
                       "whitened": y.ravel(), "explained": np.tile(explained, m), "identity_error": np.full(m * k, error)}

    src = df.select(F.col(base._q(id_col)).alias("i"), F.col(base._q(vec)).cast("array<double>").alias("v"))
    return base.emit(src, ["i", "v"], schema, run)


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """sum((n * x - S)^2) of each row, exact; None beyond a long."""
    far = np.abs(centred(x, n, total)).max(initial=0.0) + 1
    if n * far < 2.0 ** 31 / np.sqrt(x.shape[1]):
        whole = total // n
        d = (x - whole) * n - (total - whole * n)
        return (d * d).sum(1).tolist()
    s = [int(t) for t in total]
    out = [sum((n * int(c) - t) ** 2 for c, t in zip(r, s)) for r in x]
    return [d if d < 2 ** 63 else None for d in out]


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(base.table(spark, sf_dir, "embeddings"))
