"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers, x = floor(64 c) + 1000000, so that counts and sums are exact.  The fit list holds
each distinct x once, packed into blocks of rows on shared storage.  With C the
fit list centred by its mean, every step is one pass over the blocks: a task forms its rows of C v and,
from them, its share of Cᵀ(C v); the shares are added up in a shuffle by position and only
a vector of d numbers reaches the driver.  A left vector is never stored: it lies in the range
of C, so the d-vector w with u = C w stands for it, and tasks form the earlier left vectors again where
they are orthogonalised against.  Left and right vectors are orthogonalised against all earlier ones in
every step.  Where a step finds nothing new (a space is exhausted, as with equal eigenvalues or constant
dimensions), the next right vector is a fresh one orthogonal to all before.  After d steps the bidiagonal
matrix is the whole of C, and its small SVD gives the components (right vectors) and deviations (singular values).

A centred entry is (x - m) - r with m the rounded mean and r the rest of it: the
first difference is exact.

Rows: vectors that are null or empty, hold null or non-finite entries or entries of 2^40 or more in size, and vectors of
another length than the commonest, are dropped; rows with a null id stay; repeated rows count once in the fit
list and each come back; components exist up to the rank of the fit list (one distinct vector: none,
so no rows; an empty table: no rows); other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arlark.llm.common import staged

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Rows of one block; a matrix of a block is what a task holds.
BLOCK_ROWS = 4096
#: Entries at or above this size count as non-finite.
MOST = float(1 << 40)


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the usable rows; x is an array of longs less ``OFFSET``."""
    vector = F.col(vector_col)
    usable = F.size(vector) > 0
    usable &= F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < MOST))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    valid = rows.where(F.coalesce(usable, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
    lengths = valid.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return valid.where(F.size("x") == F.lit(lengths["dim"] if lengths else 0))


BLOCKS = pa.schema([("rows", pa.int64()), ("width", pa.int32()), ("data", pa.binary())])


def _pack(batches):
    """Blocks of rows as matrices of the narrowest integers that hold them."""
    for batch in batches:
        column = batch.column("x")
        for at in range(0, len(column), BLOCK_ROWS):
            part = column.slice(at, BLOCK_ROWS)
            flat = part.flatten().to_numpy()
            width = next(w for w in (1, 2, 4, 8) if not len(flat) or max(-int(flat.min()) - 1, int(flat.max())) < 1 << (8 * w - 1))
            yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([width], pa.int32()),
                                              pa.array([flat.astype(f"<i{width}").tobytes()], pa.binary())], schema=BLOCKS)


def _matrices(batches):
    """The blocks' integer matrices, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            rows, width = batch.column("rows")[k].as_py(), batch.column("width")[k].as_py()
            yield np.frombuffer(batch.column("data")[k].as_py(), f"<i{width}").reshape(rows, -1)


def summed(blocks: DataFrame, share, kind: str) -> list:
    """The sum over all blocks of ``share(matrix)``, an array of fixed length, added up by position in a shuffle."""
    arrow = {"double": pa.float64(), "long": pa.int64()}[kind]

    def run(batches):
        total = None
        for matrix in _matrices(batches):
            part = share(matrix)
            total = part if total is None else total + part
            if kind == "long":          # whole numbers of a few blocks fit, those of a task need not
                yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(arrow))], names=["share"])
                total = None
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(arrow))], names=["share"])

    parts = blocks.mapInArrow(run, f"share array<{kind}>").select(F.posexplode("share").alias("at", "value"))
    value = F.sum(F.col("value").cast("decimal(38,0)")) if kind == "long" else F.sum("value")
    got = parts.groupBy("at").agg(value.alias("value")).collect()       # one row for each position
    return [r["value"] for r in sorted(got, key=lambda r: r["at"])]


@dataclass
class Centre:
    """The exact mean: ``sums`` over ``n`` rows, as a whole part and the rest of it."""

    n: int
    sums: list[int]

    def __post_init__(self):
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        self.whole = np.array(whole, np.int64)
        self.left = [s - self.n * m for s, m in zip(self.sums, whole)]
        self.rest = np.array([r / self.n for r in self.left])

    def centred(self, matrix: np.ndarray) -> np.ndarray:
        return (matrix - self.whole).astype(np.float64) - self.rest

    def deviations(self, matrix: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2 for each row, exact."""
        apart = matrix - self.whole
        most = self.n * int(np.abs(apart).max(initial=0)) + max((abs(r) for r in self.left), default=0)
        if most * most * max(1, len(self.left)) < 1 << 63:
            scaled = apart * np.int64(self.n) - np.array(self.left, np.int64)
            return (scaled * scaled).sum(axis=1).tolist()
        return [sum((self.n * a - r) ** 2 for a, r in zip(row, self.left)) for row in apart.tolist()]


def _orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            vector = vector - (b @ vector) * b
    return vector


def bidiagonalise(blocks: DataFrame, centre: Centre, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(right vectors as columns, upper bidiagonal matrix) of the centred fit list, all ``dim`` steps."""
    random = np.random.default_rng(dim)

    def fresh(basis: list[np.ndarray]) -> np.ndarray:
        while True:
            v = _orthogonal(random.standard_normal(dim), basis)
            size = np.linalg.norm(v)
            if size > 1e-6:
                return _orthogonal(v / size, basis)

    rights, lefts, products = [fresh([])], [], []
    alphas, betas, largest = [], [], 0.0
    for step in range(dim):
        w = rights[step].copy()
        if step and betas[-1]:
            w -= betas[-1] * lefts[-1]
        earlier = np.stack(lefts, axis=1) if lefts else np.zeros((dim, 0))

        def share(matrix, w=w, earlier=earlier):
            c = centre.centred(matrix)
            u = c @ w
            return np.concatenate([[u @ u], c.T @ u, (c @ earlier).T @ u])

        got = np.array(summed(blocks, share, "double"))
        z, along = got[1:1 + dim], got[1 + dim:]
        if lefts:
            w, z = w - earlier @ along, z - np.stack(products, axis=1) @ along
        alpha = float(np.sqrt(max(0.0, got[0] - along @ along)))
        largest = max(largest, alpha)
        found = alpha > 1e-13 * largest
        alphas.append(alpha if found else 0.0)
        lefts.append(w / alpha if found else np.zeros(dim))
        products.append(z / alpha if found else np.zeros(dim))
        if step + 1 == dim:
            break
        v = _orthogonal(products[-1] - alphas[-1] * rights[-1], rights)
        beta = float(np.linalg.norm(v))
        going = beta > 1e-13 * largest
        betas.append(beta if going else 0.0)
        rights.append(_orthogonal(v / beta, rights) if going else fresh(rights))
        rights[-1] /= np.linalg.norm(rights[-1])
    return np.stack(rights, axis=1), np.diag(alphas) + np.diag(betas, 1)


@dataclass
class Whitening:
    """Mean, components (columns, falling eigenvalue), eigenvalues of the covariance and its trace."""

    centre: Centre
    components: np.ndarray
    values: np.ndarray
    trace: float

    def apply(self, matrix: np.ndarray) -> np.ndarray:
        return self.centre.centred(matrix) @ (self.components / np.sqrt(self.values))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame]:
    """The whitening of the distinct vectors of (id, x), and their blocks; None where there is no vector."""
    blocks = staged(vectors.select("x").distinct().mapInArrow(_pack, "rows long, width int, data binary"), "fit-blocks")
    # per position: the sums of a block, then its rows
    sums = summed(blocks, lambda m: np.append(m.sum(axis=0, dtype=np.int64), len(m)), "long")
    if not sums:
        return None, blocks
    centre, dim = Centre(int(sums[-1]), [int(s) for s in sums[:-1]]), len(sums) - 1
    rights, upper = bidiagonalise(blocks, centre, dim)
    _, deviations, turned = np.linalg.svd(upper)
    values = deviations ** 2 / centre.n
    kept = min(components, int((deviations > 1e-12 * max(deviations[0], 0.0)).sum()) if deviations[0] > 0 else 0)
    vectors_ = rights @ turned.T[:, :kept]
    vectors_ /= np.linalg.norm(vectors_, axis=0)
    vectors_ *= np.sign(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(kept)])
    return Whitening(centre, vectors_, values[:kept], float(values.sum())), blocks


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    k = len(model.values)

    def share(matrix):
        y = model.apply(matrix)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    got = np.array(summed(blocks, share, "double")) / model.centre.n
    covariance = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation decimal(38,0), whitened, explained, identity_error), one row for each usable row and component."""
    spark = rows.sparkSession
    vectors = whole_vectors(rows, id_col, vector_col)
    model, blocks = fit(vectors, components)
    names = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return spark.createDataFrame([], names).withColumnRenamed("id", id_col)
    error, centre = identity_error(blocks, model), model.centre

    def run(batches):
        for batch in batches:
            column = batch.column("x")
            if not len(column):
                continue
            matrix = column.flatten().to_numpy().reshape(len(column), -1)
            white, deviation = model.apply(matrix), [str(d) for d in centre.deviations(matrix)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(deviation), pa.array(list(white), pa.list_(pa.float64()))],
                names=["id", "deviation", "white"])

    applied = vectors.mapInArrow(run, "id long, deviation string, white array<double>")
    parts = applied.select("id", "deviation", F.posexplode("white").alias("at", "whitened"))
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return parts.select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(centre.n).cast("long").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened", explained[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"))
