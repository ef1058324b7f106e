"""Whitening of embeddings by incremental eigendecomposition.

The covariance of all distinct vectors is never summed up as a matrix in one place. Every task keeps a spectrum:
the number and mean of its vectors and the eigenvalues and eigenvectors of their scatter, and takes vectors in by

* centred rank-one updates. A block of vectors is centred on its own mean and reduced to the triangular factor of
  its QR decomposition, whose rows have exactly the block's scatter; each row r updates the spectrum to that of
  scatter + r r'. The difference of the block's mean from the mean so far is one more such row.
* Secular equations. With z = U'r the new eigenvalues are the roots of 1 + sum z_i^2 / (d_i - t) = 0, one between
  each two neighbours; they are found by bisection from the nearer pole, so their distances to the poles keep full
  relative precision. Eigenvectors come from the z that the roots found belong to exactly, so they stay orthogonal.
* Deflation. Entries of z that are nothing against the spectrum leave their eigenpair as it is; of eigenvalues that
  are equal a plane rotation moves the whole entry to one of them.

Spectra of tasks are combined ``FAN_IN`` at a time: the scaled eigenvectors of one are rank-one updates of the
other, and the difference of the means another. What is left is one spectrum (dimension squared numbers). Then a
Rayleigh-Ritz pass over all vectors projects them, centred on the exact mean, on the orthonormal basis found, sums
the products of the projections per task and over tasks, and turns the basis by the eigenvectors of that matrix;
the basis spans the whole space, so this gives the covariance's eigenvectors to working precision.

Vectors are integers: x = floor(64 c) + 1,000,000, so sums over them are exact.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries give no row; so do vectors
whose length is not the commonest one (ties: the longest), as components need one dimension; a null id is kept as it
is; repeated rows give their rows each, and count once in the fit; components whose eigenvalue is nothing against
the largest (``NOTHING`` of it) cannot be whitened and give no row, so a single distinct vector gives none; equal
eigenvalues come in any order; entries beyond 2^52 in size are cut there; a deviation beyond 64 bits is null; an
empty table gives an empty table. Extra columns are ignored.
"""
from __future__ import annotations

import decimal

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
FAN_IN = 16                # spectra that one task combines
BLOCK_ROWS = 64            # vectors, times the dimension, that one QR step reduces
NOTHING = 1e-12
LARGEST = float(1 << 52)
SPECTRUM = "n bigint, mean binary, values binary, vectors binary"


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2_i / (d_i - t) = 0 for ascending, different d and positive z2: (pole each root is
    measured from, distance from it), root k between d_k and d_k+1 (the last below d_last + sum z2)."""
    k = len(d)
    gap = np.append(np.diff(d), z2.sum())
    rows = np.arange(k)
    # the sign in the middle of the gap says which pole is nearer
    middle = 1 + (z2 / (d - (d + gap / 2)[:, None])).sum(axis=1)
    right = (middle < 0) & (rows < k - 1)
    pole = rows + right
    away = d[None, :] - d[pole][:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where(rows < k - 1, gap / 2, gap))
    low = np.where(~right & (rows == k - 1) & (middle < 0), gap / 2, low)
    high = np.where(~right & (rows == k - 1) & (middle >= 0), gap / 2, high)
    for _ in range(70):
        t = (low + high) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            value = 1 + (z2 / (away - t[:, None])).sum(axis=1)
        up = ~(value >= 0)             # the function rises from one pole to the next
        low, high = np.where(up, t, low), np.where(up, high, t)
    return pole, np.where(right, low, high)


def rank_one(values: np.ndarray, vectors: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and eigenvectors of vectors diag(values) vectors' + row row'."""
    z = row @ vectors
    size = z @ z
    if size == 0:
        return values, vectors
    small = 8 * np.finfo(float).eps * max(np.abs(values).max(), size)
    vectors = vectors.copy()
    live = np.flatnonzero(np.abs(z) * np.sqrt(size) > small)
    # equal eigenvalues: a rotation moves the entry of one to the next, and frees the first
    if len(live) > 1 and (np.diff(values[live]) <= small).any():
        kept = [int(live[0])]
        for j in map(int, live[1:]):
            i = kept[-1]
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            if (values[j] - values[i]) * abs(c * s) <= small:
                vectors[:, [i, j]] = np.column_stack([c * vectors[:, i] - s * vectors[:, j], s * vectors[:, i] + c * vectors[:, j]])
                values = values.copy()
                a, b = values[i], values[j]
                values[i], values[j] = c * c * a + s * s * b, s * s * a + c * c * b
                z[i], z[j] = 0.0, r
                kept.pop()
            kept.append(j)
        live = np.array(kept)
    if len(live) == 0:
        return values, vectors
    order = np.argsort(values[live], kind="stable")
    live = live[order]
    d = values[live]
    step = np.diff(d)
    if (step <= 0).any():                                             # bisection needs poles that differ
        d = d + np.concatenate([[0.0], np.cumsum(np.where(step <= 0, small - step, 0.0))])
    pole, t = secular_roots(d, z[live] ** 2)
    # distances d_i - root_k, each from the pole the root was measured from
    away = (d[:, None] - d[pole][None, :]) - t[None, :]
    away = np.where(away == 0, -np.finfo(float).tiny, away)
    # the entries of z for which these roots are exact
    spread = d[:, None] - d[None, :]
    np.fill_diagonal(spread, 1.0)
    ratio = -away / np.where(np.eye(len(d), dtype=bool), 1.0, -spread)
    exact = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.sign(z[live])
    turn = exact[:, None] / away
    turn /= np.linalg.norm(turn, axis=0)
    new = values.copy()
    new[live] = d[pole] + t
    vectors[:, live] = vectors[:, live] @ turn
    order = np.argsort(new, kind="stable")
    return new[order], vectors[:, order]


class Spectrum:
    """Number, mean and eigen-decomposed scatter of a set of vectors."""

    def __init__(self, dim: int, n: int = 0, mean=None, values=None, vectors=None):
        self.n, self.mean = n, np.zeros(dim) if mean is None else mean
        self.values, self.vectors = (np.zeros(dim) if values is None else values), (np.eye(dim) if vectors is None else vectors)

    def take(self, n: int, mean: np.ndarray, rows: np.ndarray) -> None:
        """Add a set of n vectors of that mean whose scatter is rows' rows."""
        if not n:
            return
        whole = self.n + n
        away = (mean - self.mean) * np.sqrt(self.n * n / whole)
        for row in [*rows, away] if self.n else rows:
            self.values, self.vectors = rank_one(self.values, self.vectors, row)
        self.mean, self.n = self.mean + (mean - self.mean) * (n / whole), whole

    def add(self, vectors: np.ndarray) -> None:
        """Take in a block of vectors."""
        mean = vectors.mean(axis=0)
        self.take(len(vectors), mean, np.linalg.qr(vectors - mean, mode="r"))

    def join(self, other: Spectrum) -> None:
        """Take in the vectors of another spectrum."""
        kept = other.values > 0
        self.take(other.n, other.mean, np.sqrt(other.values[kept])[:, None] * other.vectors[:, kept].T)

    def row(self) -> dict:
        """As a row of ``SPECTRUM``."""
        return {"n": self.n, "mean": self.mean.tobytes(), "values": self.values.tobytes(), "vectors": np.ascontiguousarray(self.vectors).tobytes()}

    @staticmethod
    def of(n: int, mean: bytes, values: bytes, vectors: bytes) -> Spectrum:
        mean = np.frombuffer(mean)
        return Spectrum(len(mean), n, mean, np.frombuffer(values), np.frombuffer(vectors).reshape(len(mean), -1))


def scaled(vector: Column) -> Column:
    """x of every entry; null where the vector takes no part."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    sound = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + SHIFT
    return F.when(sound & (F.size(vector) > 0), F.transform(entries, whole))


def matrix(column) -> np.ndarray:
    """An Arrow list column of one length as an int64 matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype=np.int64)


def folded(parts: DataFrame, schema: str, join) -> DataFrame:
    """Rows (one a task) combined ``FAN_IN`` at a time by ``join`` (list of dicts -> dict) until one is left."""
    import pyarrow as pa

    names = parts.columns
    parts = stored(parts.withColumn("part", F.spark_partition_id().cast("long")), "parts")

    def one(group):
        rows = group.sort_by("part")
        done = join(rows.select(names).to_pylist())
        return pa.table({n: pa.array([done[n]], type=group.schema.field(n).type) for n in names} | {"part": rows.column("part")[:1]})

    while parts.count() > 1:
        nearer = parts.withColumn("part", F.floor(F.col("part") / FAN_IN))
        parts = stored(nearer.groupBy("part").applyInArrow(one, schema + ", part bigint"), "parts")
    return parts.drop("part")


class Whitener:
    """Mean, eigenvalues and eigenvectors of the fit list."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums, self.values, self.vectors = n, sums, values, vectors
        self.trace = float(values.sum())
        self.identity_error = 0.0

    @property
    def components(self) -> int:
        """Components that can be whitened, ``COMPONENTS`` at most."""
        return int((self.values[:COMPONENTS] > NOTHING * max(self.values[0], 0)).sum()) if self.trace > 0 else 0

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers near it and what is left."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        return whole, np.array([(s - int(w) * self.n) / self.n for s, w in zip(self.sums, whole)])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - mean, the whole numbers subtracted exactly."""
        whole, rest = self.centre()
        return (x - whole).astype(np.float64) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of unit variance, one column a component."""
        k = self.components
        return self.centred(x) @ self.vectors[:, :k] / np.sqrt(self.values[:k])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; null beyond 64 bits."""
        whole, _ = self.centre()
        rest = np.array([s - int(w) * self.n for s, w in zip(self.sums, whole)], dtype=object)
        near = np.abs(x - whole).max(initial=0)
        bound = self.n * (int(near) + 1)
        if bound * bound * x.shape[1] < 1 << 63:
            return ((self.n * (x - whole) - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * int(a) - r) ** 2 for a, r in zip(row, rest)) for row in (x - whole).tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def fit_list(vectors: DataFrame, column: str) -> DataFrame:
    """x of every distinct vector once, all of the commonest length."""
    return vectors.groupBy(F.col(column).alias("x")).count().select("x")


def products(fit: DataFrame, rows_of, width: int) -> np.ndarray:
    """Sum over the fit list of r'r for r = ``rows_of()`` (x matrix -> matrix of that width), by task, then over tasks."""
    def run(batches):
        import pyarrow as pa

        rows, total, n = rows_of(), np.zeros((width, width)), 0
        for batch in batches:
            if batch.num_rows:
                r = rows(matrix(batch.column(0)))
                total += r.T @ r
                n += len(r)
        if n:
            yield pa.RecordBatch.from_pylist([{"total": total.tobytes()}], schema=pa.schema([("total", pa.binary())]))

    def join(rows):
        return {"total": np.sum([np.frombuffer(r["total"]) for r in rows], axis=0).tobytes()}

    found = folded(fit.mapInArrow(run, "total binary"), "total binary", join).first()
    return np.frombuffer(found["total"]).reshape(width, width) if found else np.zeros((width, width))


def train(fit: DataFrame) -> Whitener | None:
    """Fit on a stored table of distinct vectors x; None if it is empty."""
    first = fit.first()
    if first is None:
        return None
    import pyarrow as pa

    dim = len(first["x"])

    def spectra(batches):
        own, held, size = Spectrum(dim), [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS * dim):
                block = matrix(batch.column(0).slice(a, BLOCK_ROWS * dim))
                held.append(block)
                size += len(block)
                if size >= BLOCK_ROWS * dim:
                    own.add((np.concatenate(held) - SHIFT).astype(np.float64))
                    held, size = [], 0
        if size:
            own.add((np.concatenate(held) - SHIFT).astype(np.float64))
        if own.n:
            yield pa.RecordBatch.from_pylist([own.row()])

    def join(rows):
        whole = Spectrum.of(**rows[0])
        for r in rows[1:]:
            whole.join(Spectrum.of(**r))
        return whole.row()

    found = folded(fit.mapInArrow(spectra, SPECTRUM), SPECTRUM, join).first()
    rough = Spectrum.of(**found.asDict())
    def sums_of(batches):
        total = np.zeros(dim, dtype=object)
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                total = total + (x.sum(axis=0) if int(np.abs(x).max()) * len(x) < 1 << 62 else x.astype(object).sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), type=pa.int32()), pa.array([decimal.Decimal(int(t)) for t in total], type=pa.decimal128(38, 0))],
                                         names=["at", "s"])

    summed = fit.mapInArrow(sums_of, "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s").cast("decimal(38,0)").alias("s"))
    sums = [int(r["s"]) for r in summed.orderBy("at").collect()]
    basis, _ = np.linalg.qr(rough.vectors[:, ::-1])
    model = Whitener(rough.n, sums, rough.values[::-1], basis)
    # Rayleigh-Ritz on the basis found
    ritz = products(fit, lambda: lambda x: model.centred(x) @ model.vectors, dim) / model.n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    model = Whitener(rough.n, sums, np.maximum(values[::-1], 0), basis @ turn[:, ::-1])
    if model.components:
        white = products(fit, lambda: model.whiten, model.components) / model.n
        model.identity_error = float(np.abs(white - np.eye(model.components)).max())
    return model


def whiten(table: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: one row a vector and component."""
    rows = table.select(F.col(key).alias("vec_id"), scaled(F.col(vector)).alias("x")).where("x is not null")
    schema = "vec_id {}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    schema = schema.format(table.schema[key].dataType.simpleString())
    length = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.where(F.size("x") == (length["size"] if length else 0))
    model = train(stored(fit_list(rows, "x"), "fit"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            k = model.components
            if not k or not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            n, explained = batch.num_rows, model.values[:k] / model.trace
            of_row = np.repeat(np.arange(n), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(of_row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, model.n)),
                pa.array(model.deviations(x), type=pa.int64()).take(pa.array(of_row)), pa.array(model.whiten(x).ravel()),
                pa.array(np.tile(explained, n)), pa.array(np.full(n * k, model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(run, schema)
