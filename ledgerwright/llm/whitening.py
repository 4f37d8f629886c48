"""Embedding whitening by QDWH spectral divide-and-conquer.

Each entry c of a vector becomes the whole number floor(256 * c). The covariance is
taken over the distinct whole-number vectors (the fit list), so copies weigh nothing. Its
sums are exact: vectors are centred on the whole numbers nearest to their means before
they are multiplied, products are added in pieces that a double holds exactly, and what
is left of the means is taken off in whole-number arithmetic. So the covariance doesn't
depend on how rows are dealt out.

Components come from spectral divide-and-conquer. The polar factor U of the covariance,
shifted into its spectrum, is found by QDWH (dynamically weighted Halley iterations by QR);
(U + I) / 2 projects on the eigenvectors above the shift and (I - U) / 2 on those below.
Bases of both ranges split the matrix into two blocks, which are split again until a block has
one row or is a multiple of the identity. Only blocks that the wanted components need are
split. The whitening matrix, ``components`` vectors of one dimension's length, is
broadcast; rows are projected where they are read.

Only counts and sums reach the driver: one row per dimension, then one per pair of dimensions
(of vectors of 1024 entries, half a million), whatever the number of rows. A vector that
a third of all rows repeat is reduced before its shuffle.

Defined cases: rows whose vector is null or holds a null, a NaN or an infinity go, and so
do vectors of another length than most (the shorter at a tie). Numbers beyond a long are
cut to its range; a deviation beyond it is null. Components without variance (all vectors
equal, or more components than dimensions in use) whiten to 0 and aren't part of the identity
error; vectors of d entries have d components at most. Null and repeated ids are rows of
their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables

UNIT = 256
EXACT = 2**53                      # whole numbers up to here are exact as doubles
ROWS = 4096                        # vectors that are multiplied at a time
LONG = (-(1 << 63), (1 << 63) - 1)


# ---------------------------------------------------------------- whole-number vectors

def whole_vectors(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers of the usable vectors of a batch, and each as whole numbers."""
    lists = batch.column(column).cast(pa.large_list(pa.float64()))
    values = pc.fill_null(lists.values, float("nan")).to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    present = lists.is_valid().to_numpy(zero_copy_only=False)
    usable = np.flatnonzero(present & (bad[offsets[1:]] == bad[offsets[:-1]]))
    with np.errstate(over="ignore"):
        scaled = np.floor(values * UNIT)
    top = float(2**63)
    whole = np.where(scaled >= top, LONG[1], np.where(scaled < -top, LONG[0], 0)).astype(np.int64)
    inside = (scaled < top) & (scaled >= -top)
    whole[inside] = scaled[inside].astype(np.int64)
    return usable, [whole[offsets[i]:offsets[i + 1]] for i in usable]


def pack(vector: np.ndarray) -> bytes:
    """Bytes of a vector, in the narrowest of 2, 4 or 8 bytes an entry that holds it; equal for equal vectors."""
    for kind in (np.int16, np.int32):
        limit = np.iinfo(kind)
        if not len(vector) or (vector.min() >= limit.min and vector.max() <= limit.max):
            return vector.astype(kind).tobytes()
    return vector.astype(np.int64).tobytes()


def unpack(data: list[bytes], width: int) -> np.ndarray:
    """The packed vectors of ``width`` entries as one matrix of longs."""
    out = np.empty((len(data), width), np.int64)
    for i, one in enumerate(data):
        out[i] = np.frombuffer(one, f"<i{len(one) // width}")
    return out


def fit_list(tables: Tables, embeddings: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Distinct vectors (x binary) of the commonest length, as a written table, and that length."""
    def run(batches):
        for batch in batches:
            _, vectors = whole_vectors(batch, column)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(v) for v in vectors], pa.int32()), pa.array(map(pack, vectors), pa.binary())], ["width", "x"])
    each = embeddings.select(column).mapInArrow(run, "width int, x binary")
    counts = each.groupBy("width").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "width").first()
    width = counts.width if counts else 0
    return tables.put(each.where(F.col("width") == width).select("x").distinct(), "fit-list"), width


# ---------------------------------------------------------------- exact sums

def products(y: np.ndarray) -> np.ndarray:
    """Exact sums of the products of columns, as Python whole numbers where a long can't hold them."""
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    largest = int(max(abs(int(y.min())), abs(int(y.max())))) if y.size else 0
    piece = EXACT // max(1, largest * largest)
    if piece == 0:  # entries beyond 2**26
        return y.astype(object).T @ y.astype(object)
    for at in range(0, len(y), piece):
        part = y[at:at + piece].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and sum of each dimension."""
    def run(batches):
        n, total = 0, np.zeros(width, dtype=object)
        for batch in batches:
            x = unpack(batch.column("x").to_pylist(), width)
            n += len(x)
            total = total + (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()),
                                          pa.array(total.tolist(), pa.decimal128(38, 0))], ["i", "n", "total"])
    rows = fit.mapInArrow(run, "i int, n long, total decimal(38,0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    by = {r.i: r for r in rows}
    return by[0].n, [int(by[i].total) for i in range(width)]


def covariance(fit: DataFrame, width: int, n: int, total: list[int]) -> np.ndarray:
    """The covariance of the fit list, each entry the double nearest to the exact value."""
    centre = [(2 * s + n) // (2 * n) for s in total]  # the whole numbers nearest to the means
    shift = np.array([min(max(c, LONG[0]), LONG[1]) for c in centre], np.int64)

    def run(batches):
        moment = np.zeros((width, width), dtype=object)
        for batch in batches:
            data = batch.column("x").to_pylist()
            for at in range(0, len(data), ROWS):
                x = unpack(data[at:at + ROWS], width)
                near = x.size and max(abs(int(x.min())), abs(int(x.max()))) < 1 << 61 and np.abs(shift).max() < 1 << 61
                moment = moment + products(x - shift if near else x.astype(object) - shift.astype(object))
        i, j = np.triu_indices(width)
        parts = [[int(v) >> 60 for v in moment[i, j]], [int(v) & (1 << 60) - 1 for v in moment[i, j]]]  # exact decimals
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                          *(pa.array(v, pa.decimal128(38, 0)) for v in parts)], ["i", "j", "high", "low"])
    rows = (fit.mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
            .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).toArrow())
    left = [s - n * int(c) for s, c in zip(total, shift)]  # n times what is left of the means
    out = np.empty((width, width))
    for i, j, high, low in zip(*(rows.column(c).to_pylist() for c in ("i", "j", "high", "low"))):
        out[i, j] = out[j, i] = (n * ((int(high) << 60) + int(low)) - left[i] * left[j]) / (n * n)
    return out


# ---------------------------------------------------------------- spectral divide-and-conquer

def qdwh(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley iterations (QR form)."""
    d = len(a)
    x = a / np.linalg.norm(a)
    low = np.finfo(float).eps  # below the smallest singular value of interest; weights follow it up to 1
    for _ in range(40):
        q = low * low
        root = np.cbrt(4 * (1 - q) / (q * q)) if q < 1 else 0.0
        wa = np.sqrt(1 + root) + 0.5 * np.sqrt(max(0.0, 8 - 4 * root + 8 * (2 - q) / (q * np.sqrt(1 + root))))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        both = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(d)]))[0]
        step = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (both[:d] @ both[d:].T)
        step = (step + step.T) / 2
        moved = np.linalg.norm(step - x)
        x, low = step, min(1.0, low * (wa + wb * q) / (1 + wc * q))
        if moved <= 1e-14 * d and 1 - low < 1e-15:
            break
    return x


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, int] | None:
    """A basis of which the first k columns span the upper eigenvectors of ``a``, the rest the lower; None if none parts it."""
    d = len(a)
    spread = np.sort(np.diag(a))
    shifts = [np.median(spread), spread.mean(), *((spread[:-1] + spread[1:]) / 2)[np.argsort(np.diff(spread))[::-1]][:8]]
    shifts += [s + np.linalg.norm(a - s * np.eye(d)) / np.sqrt(d) * t for s in shifts[:2] for t in (0.3, -0.3, 0.07, -0.07, 0.9, -0.9)]
    draw = np.random.default_rng(11)
    best = None
    for shift in shifts:
        moved = a - shift * np.eye(d)
        if not np.linalg.norm(moved):
            continue
        upper = (qdwh(moved) + np.eye(d)) / 2  # the spectral projector
        k = round(float(np.trace(upper)))
        if not 0 < k < d:
            continue
        basis = np.linalg.qr(upper @ draw.standard_normal((d, k)))[0]
        basis = np.linalg.qr(upper @ basis)[0]
        whole = np.linalg.qr(np.hstack([basis, (np.eye(d) - upper) @ draw.standard_normal((d, d - k))]))[0]
        error = np.linalg.norm(whole[:, k:].T @ a @ whole[:, :k])
        if best is None or error < best[0]:
            best = error, whole, k
        if error <= 1e-14 * d * scale:
            break
    return best and (best[1], best[2])


def spectrum(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale = np.linalg.norm(a)
    found: list[tuple[float, np.ndarray]] = []

    def go(block: np.ndarray, basis: np.ndarray) -> None:
        if len(found) >= wanted:
            return
        d = len(block)
        middle = np.trace(block) / d
        if d == 1 or np.linalg.norm(block - middle * np.eye(d)) <= 4e-16 * d * scale:
            found.extend((float(block[i, i]), basis[:, i]) for i in range(d))
            return
        parts = _split(block, scale)
        if parts is None:  # nearly a multiple of the identity: its own axes, by falling diagonal
            found.extend((float(block[i, i]), basis[:, i]) for i in np.argsort(-np.diag(block), kind="stable"))
            return
        q, k = parts
        for cols in (q[:, :k], q[:, k:]):  # all eigenvalues of the first block are above those of the second
            part = cols.T @ block @ cols
            go((part + part.T) / 2, basis @ cols)

    go(a, np.eye(len(a)))
    found = sorted(found[:max(wanted, 0)], key=lambda x: -x[0])
    vectors = np.stack([v / np.linalg.norm(v) for _, v in found], axis=1) if found else np.zeros((len(a), 0))
    return np.array([float(v @ a @ v) for v in vectors.T]), vectors


# ---------------------------------------------------------------- whitening

@dataclass
class Whitening:
    """A fitted model: ``n`` vectors with sums ``total``, eigenvalues, unit vectors as columns, and shares of variance."""

    width: int
    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    used: np.ndarray      # whether a component has variance
    identity_error: float = 0.0

    def transform(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of whole-number vectors, one row each."""
        mean = [Fraction(s, self.n) for s in self.total]
        near = np.array([m.numerator // m.denominator for m in mean], dtype=object)
        rest = np.array([float(m - int(c)) for m, c in zip(mean, near)])
        low = np.array([min(max(c, LONG[0]), LONG[1]) for c in near], np.int64)
        small = not x.size or max(abs(int(x.min())), abs(int(x.max()))) < 1 << 61 and np.abs(low).max(initial=0) < 1 << 61
        centred = ((x - low).astype(np.float64) if small else (x.astype(object) - near).astype(np.float64)) - rest
        scale = np.where(self.used, 1 / np.sqrt(np.where(self.used, self.values, 1.0)), 0.0)
        return centred @ self.vectors * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - total) squared, exact; None beyond a long."""
        largest = max((abs(self.n * int(v) - s) for i, s in enumerate(self.total) for v in (x[:, i].min(), x[:, i].max())),
                      default=0) if len(x) else 0
        if largest * largest * self.width < 1 << 63 and abs(self.n) * (largest + 1) < 1 << 62:
            moved = self.n * x - np.array(self.total, np.int64)
            return (moved * moved).sum(axis=1).tolist()
        moved = self.n * x.astype(object) - np.array(self.total, dtype=object)
        return [v if v <= LONG[1] else None for v in (moved * moved).sum(axis=1).tolist()] if self.width else [0] * len(x)


def fit(embeddings: DataFrame, column: str = "embedding", components: int = 4) -> Whitening:
    """Fit on the distinct vectors of ``embeddings``; the identity error is measured over all of them."""
    tables = Tables(embeddings.sparkSession, "whitening")
    vectors, width = fit_list(tables, embeddings, column)
    if not width:
        empty = np.zeros(0)
        return Whitening(width, 1, [], empty, np.zeros((0, 0)), empty, empty.astype(bool))
    n, total = _sums(vectors, width)
    cov = covariance(vectors, width, n, total)
    values, axes = spectrum(cov, min(components, width))
    trace = float(np.trace(cov))
    used = values > 1e-14 * width * trace
    model = Whitening(width, n, total, values, axes, values / trace if trace > 0 else np.zeros(len(values)), used)
    sent = embeddings.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        k = len(sent.value.values)
        moment = np.zeros((k, k))
        for batch in batches:
            data = batch.column("x").to_pylist()
            for at in range(0, len(data), ROWS):
                z = sent.value.transform(unpack(data[at:at + ROWS], width))  # centred: the mean is taken off
                moment += z.T @ z
        i, j = np.divmod(np.arange(k * k), max(k, 1))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(moment.ravel())], ["i", "j", "v"])
    rows = vectors.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    both = [(r.i, r.j, r.v / n) for r in rows if used[r.i] and used[r.j]]
    model.identity_error = max((abs(v - (i == j)) for i, j, v in both), default=0.0)
    tables.drop("fit-list")
    return model


def whiten(embeddings: DataFrame, column: str = "embedding", components: int = 4) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error): one per usable row and component."""
    model = fit(embeddings, column, components)
    sent = embeddings.sparkSession.sparkContext.broadcast(model)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        model = sent.value
        k = len(model.values)
        for batch in batches:
            usable, vectors = whole_vectors(batch, column)
            fits = [i for i, v in enumerate(vectors) if len(v) == model.width]
            ids = batch.column("vec_id").take(pa.array(usable[fits]))
            for at in range(0, len(fits) if k else 0, ROWS):
                x = np.stack([vectors[i] for i in fits[at:at + ROWS]])
                rows = len(x)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(np.arange(at, at + rows), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n)),
                     pa.array([v for v in model.deviations(x) for _ in range(k)], pa.int64()),
                     pa.array(model.transform(x).ravel()), pa.array(np.tile(model.explained, rows)),
                     pa.array(np.full(rows * k, model.identity_error))], names)
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), column).mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
