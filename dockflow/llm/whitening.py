"""Operator 13: embedding whitening through an incremental eigendecomposition.

Vectors become integers ``x = floor(64 c) + 1000000``; the *fit list* holds each
distinct x once. Its covariance is decomposed without ever being formed from
uncentred products:

1. Each partition of the fit list keeps count, mean and a spectrum (d values,
   d x d vectors) and takes its vectors one by one: a vector adds the centred
   rank-one term n/(n+1) (x - mean)(x - mean)' to the scatter. The new
   eigenvalues are the roots of the secular equation 1 + r sum z_k^2/(d_k - t),
   found between its poles; coordinates without weight and equal eigenvalues
   are deflated first.
2. Spectra are merged in rounds of ``FAN_IN``: every eigenpair of one is a
   rank-one update of the other, and one more stands for the distance of the
   two means.
3. Rayleigh-Ritz: one distributed pass projects the centred fit list on the
   merged basis and sums the products; the eigenvectors of that d x d Ritz
   matrix turn the basis into the components, to double precision. The centre
   is exact: (n x - S) / n with integer n x - S.

Only d x d matrices (d: the embedding's width) are shipped or reach the driver.
Partial matrices are added in rounds as well, in the order of their partitions.

Defined results: rows with a null vector, a null, NaN or infinite entry, or an
entry of 2**31 or more in size are dropped; so are vectors whose length is not
the table's commonest (of equally common ones the larger). All other rows stay,
repeated and null ids included. Components whose eigenvalue is at most 1e-12 of
the trace don't exist (constant dimensions, fewer vectors than dimensions), so
a table with fewer than two distinct vectors returns no rows. ``deviation`` is
null where it exceeds a 64-bit number. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import materialize, ship, unpack

SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0 ** 31
COMPONENTS = 16
#: Spectra (or partial matrices) that one task merges in a round.
FAN_IN = 8
#: An eigenvalue of at most this share of the trace counts as zero.
RANK_TOL = 1e-12
_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots t_i of 1 + rho * sum(z_k^2 / (d_k - t)) for rising distinct poles d, rho > 0 and z without zeros.

    Returns the pole that each root is measured from and its distance from it,
    which keeps d_k - t_i exact to the last digits. Each step fits the two
    halves of the sum by simple poles (and falls back to halving the bracket).
    """
    n, w = len(d), rho * z * z
    right = np.append(d[1:], d[-1] + w.sum())
    gap = right - d
    mid = d + gap / 2
    f_mid = 1 + (w / (d - mid[:, None])).sum(1)
    near = np.where((f_mid < 0) & (np.arange(n) < n - 1), np.arange(n) + 1, np.arange(n))  # the pole on the root's side
    origin = d[near]
    lo = np.where(near == np.arange(n), 0.0, -gap / 2)
    hi = np.where(near == np.arange(n), np.where(f_mid < 0, gap, gap / 2), 0.0)
    lo[-1], hi[-1] = (gap[-1] / 2, gap[-1]) if f_mid[-1] < 0 else (0.0, gap[-1] / 2)
    t = (lo + hi) / 2
    poles = d - origin[:, None]  # row i: poles as seen from root i's origin
    left, inner = np.tri(n), np.arange(n) < n - 1
    a, b = np.diagonal(poles).copy(), np.append(np.diagonal(poles, 1), 0.0)
    for _ in range(60):
        inverse = 1 / (poles - t[:, None])
        square = inverse * inverse
        ql, dl = (np.einsum("ij,ij,j->i", m, left, w) for m in (inverse, square))
        qr, dr = inverse @ w - ql, square @ w - dl
        f = 1 + ql + qr
        lo, hi = np.where(f < 0, t, lo), np.where(f < 0, hi, t)  # f rises between its poles
        done = (np.abs(f) <= 8 * n * _EPS * (1 + np.abs(ql) + qr)) | (hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if done.all():
            break
        # left part ~ p + s/(a - t), right part ~ r + u/(b - t), equal in value and slope
        ga, gb = a - t, b - t
        s, u = dl * ga * ga, dr * gb * gb
        c = f - dl * ga - np.where(inner, dr * gb, 0.0)
        with np.errstate(all="ignore"):
            # c (a-x)(b-x) + s (b-x) + u (a-x) = 0 with x the new root; solved for the step x - t
            A, B, C = c, -(c * (ga + gb) + s + u), c * ga * gb + s * gb + u * ga
            disc = np.sqrt(np.maximum(B * B - 4 * A * C, 0))
            step = np.where(B <= 0, 2 * C / (-B + disc), (-B - disc) / (2 * A))
            last = ga[-1] + s[-1] / c[-1]
        step[-1] = last
        new = t + step
        bad = ~(np.isfinite(new) & (new > lo) & (new < hi))
        t = np.where(done, t, np.where(bad, (lo + hi) / 2, new))
    return near, t


def rank_one(d: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of u diag(d) u' + rho v v' (rho >= 0; d rising)."""
    z = u.T @ v
    size = rho * float(z @ z)
    if not size > 0:
        return d, u
    tol = 8 * _EPS * max(abs(d[-1]), abs(d[0]), size)
    starts = np.flatnonzero(np.diff(d, prepend=-np.inf) > tol)
    if len(starts) < len(d):  # equal eigenvalues: a reflection leaves one of them all the weight
        u = u.copy()
        for i, j in zip(starts, np.append(starts[1:], len(d)), strict=True):
            norm = float(np.linalg.norm(z[i:j]))
            if j - i > 1 and norm > 0:
                h = z[i:j].copy()
                h[-1] += np.copysign(norm, h[-1])
                h /= np.linalg.norm(h)
                u[:, i:j] -= 2 * np.outer(u[:, i:j] @ h, h)
                z[i:j] = 0
                z[j - 1] = u[:, j - 1] @ v
    live = np.flatnonzero(np.sqrt(rho) * np.abs(z) * np.sqrt(size) > tol)
    if not len(live):
        return d, u
    p, w = d[live], z[live]
    near, t = secular_roots(p, w, rho)
    diff = (p[:, None] - p[near]) - t  # pole k minus root i
    # weights that have exactly these roots: vectors made from them are orthogonal
    ratio = -diff / np.where(np.eye(len(p), dtype=bool), 1.0, p[:, None] - p)
    np.fill_diagonal(ratio, -np.diagonal(diff))
    exact = np.sqrt(np.abs(np.prod(ratio, axis=1)))
    q = np.copysign(exact, w)[:, None] / diff
    q /= np.sqrt((q * q).sum(0))
    values, vectors = d.copy(), u.copy()
    values[live] = p[near] + t
    vectors[:, live] = u[:, live] @ q
    o = np.argsort(values, kind="stable")
    return values[o], vectors[:, o]


class Spectrum:
    """Count, mean and eigendecomposition of the centred scatter of the vectors seen."""

    def __init__(self, width: int):
        self.n, self.mean = 0, np.zeros(width)
        self.values, self.vectors = np.zeros(width), np.eye(width)

    def add(self, x: np.ndarray) -> None:
        off = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        off = other.mean - self.mean
        n = self.n + other.n
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n * other.n / n)
        self.mean = self.mean + off * (other.n / n)
        self.n = n

    def pack(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def unpack(cls, raw: bytes, width: int) -> Spectrum:
        a, s = np.frombuffer(raw), cls(width)
        s.n, s.mean, s.values = int(a[0]), a[1:1 + width], a[1 + width:1 + 2 * width]
        s.vectors = a[1 + 2 * width:].reshape(width, width)
        return s


def usable(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): the rows that stay, as integers; see the module's text."""
    c = F.col(vector)
    x = F.transform(c, lambda e: F.floor(e.cast("double") * SCALE) + SHIFT)
    # NaN compares as larger than any number
    fine = F.forall(c, lambda e: F.coalesce(F.abs(e.cast("double")) < LARGEST, F.lit(False)))
    own = table.where(c.isNotNull() & (F.size(c) > 0) & F.coalesce(fine, F.lit(False))).select(F.col(vec_id).alias("vec_id"), x.alias("x"))
    common = own.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return own.where(F.size("x") == (common["w"] if common else 0))


def _matrix(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(column))
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _rounds(parts: DataFrame, fold) -> bytes | None:
    """Fold (part, blob) rows into one blob: ``FAN_IN`` of them a task and round, in the order of ``part``."""
    n = parts.count()
    while n > 1:
        def merge(t: pa.Table) -> pa.Table:
            order = np.argsort(t.column("part").to_numpy())
            blobs = t.column("blob").to_pylist()
            return pa.table({"part": pa.array([int(t.column("grp")[0].as_py())], pa.int64()), "blob": pa.array([fold([blobs[i] for i in order])], pa.binary())})
        parts = materialize(parts.withColumn("grp", F.floor(F.col("part") / FAN_IN).cast("long")).groupBy("grp")
                            .applyInArrow(merge, "part long, blob binary"), "folded")
        n = parts.count()
    row = parts.first()
    return bytes(row["blob"]) if row else None


def _numbered(parts: DataFrame) -> DataFrame:
    """(part, blob) with parts numbered from 0 without large gaps, so that rounds group ``FAN_IN`` of them."""
    return materialize(parts.withColumn("part", F.spark_partition_id().cast("long")), "parts")


def fit_spectrum(fit: DataFrame, width: int) -> Spectrum:
    """Steps 1 and 2 over the fit list: the merged spectrum."""
    def local(batches):
        s = Spectrum(width)
        for batch in batches:
            for x in _matrix(batch, "x", width).astype(float):
                s.add(x)
        if s.n:
            yield pa.RecordBatch.from_arrays([pa.array([s.pack()], pa.binary())], names=["blob"])

    def fold(blobs):
        s = Spectrum.unpack(blobs[0], width)
        for b in blobs[1:]:
            s.merge(Spectrum.unpack(b, width))
        return s.pack()
    raw = _rounds(_numbered(fit.select("x").mapInArrow(local, "blob binary")), fold)
    return Spectrum.unpack(raw, width) if raw else Spectrum(width)


def _products(fit: DataFrame, width: int, centre: tuple[int, np.ndarray], basis: np.ndarray) -> np.ndarray:
    """Sum over the fit list of y y', y the centred vector times ``basis``, divided by its count."""
    held = ship(fit.sparkSession, (centre, basis))
    k = basis.shape[1]

    def local(batches):
        (n, total), b = unpack(held)
        out, seen = np.zeros((k, k)), False
        for batch in batches:
            y = (n * _matrix(batch, "x", width) - total) / n @ b
            out += y.T @ y
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["blob"])
    raw = _rounds(_numbered(fit.select("x").mapInArrow(local, "blob binary")), lambda blobs: sum(np.frombuffer(x) for x in blobs).tobytes())
    return np.frombuffer(raw).reshape(k, k) / centre[0]


class Whitener:
    """Fitted components: ``vectors`` (d x k), ``values`` (k), the exact centre and the trace."""

    def __init__(self, centre, vectors, values, trace, identity_error):
        self.centre, self.vectors, self.values = centre, vectors, values
        self.trace, self.identity_error = trace, identity_error


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on the distinct x of ``rows`` (as of ``usable``); None if there is no component."""
    distinct = materialize(rows.select("x").distinct(), "fit_list")
    head = distinct.select(F.size("x").alias("w")).first()
    if head is None:
        return None
    width = head["w"]
    sums = {r["i"]: r for r in distinct.select(F.posexplode("x").alias("i", "e")).groupBy("i").agg(F.sum("e").alias("s"), F.count("e").alias("n")).collect()}
    n, total = sums[0]["n"], np.array([sums[i]["s"] for i in range(width)], np.int64)
    basis = fit_spectrum(distinct, width).vectors
    ritz = _products(distinct, width, (n, total), basis)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    trace = float(np.trace(ritz))
    keep = [i for i in range(width - 1, -1, -1) if values[i] > RANK_TOL * trace][:components]
    if not keep:
        return None
    vectors, values = basis @ turn[:, keep], values[keep]
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(len(keep))] < 0, -1.0, 1.0)
    white = _products(distinct, width, (n, total), vectors / np.sqrt(values))
    return Whitener((n, total), vectors, values, trace, float(np.abs(white - np.eye(len(keep))).max()))


def transform(rows: DataFrame, model: Whitener) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per row and component."""
    held = ship(rows.sparkSession, model)

    def run(batches):
        m = unpack(held)
        n, total = m.centre
        k = len(m.values)
        turn, share = m.vectors / np.sqrt(m.values), m.values / m.trace
        for batch in batches:
            off = n * _matrix(batch, "x", len(total)) - total
            white = off / n @ turn
            exact = np.abs(off).astype(float).max(1, initial=0) < np.sqrt(2.0 ** 62 / len(total))
            dev = (np.where(exact[:, None], off, 0) ** 2).sum(1).tolist()
            for i in np.flatnonzero(~exact):
                v = sum(int(e) ** 2 for e in off[i])
                dev[i] = v if v < 1 << 63 else None
            size = len(off)
            rep = np.repeat(np.arange(size), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rep)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                 pa.array(np.full(size * k, n)), pa.array(dev, pa.int64()).take(pa.array(rep)), pa.array(white.ravel()),
                 pa.array(np.tile(share, size)), pa.array(np.full(size * k, m.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on ``table`` and project its rows."""
    rows = usable(table, vec_id, vector)
    model = fit(rows, components)
    if model is None:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return transform(rows, model)
