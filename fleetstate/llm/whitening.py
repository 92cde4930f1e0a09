"""Embedding whitening: vectors in the eigenvectors of their covariance, each direction of variance one.

The covariance is summed over the cluster; its eigenvectors come from spectral divide and conquer. The polar factor U of the
covariance less a shift, by the dynamically weighted Halley iteration (QDWH), has eigenvalue 1 above the shift and -1 below, so
(U + I) / 2 projects on one invariant subspace and (I - U) / 2 on the other. Both are split on in the same way until single
directions are left. Whitening itself is one product with a matrix sent to all tasks.

Vectors that are null, empty, hold null or non-finite components, or components beyond 2^46, are left out, and so are those of
another length than most have (the shortest of such lengths). Directions without variance have no component: one vector, or copies of one, give no
rows. Repeated rows count each. A null vec_id is an id like others. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, table

#: A component c counts as the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
_MOST = float(1 << 46)


def grid(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): usable vectors as whole numbers."""
    v = F.col("embedding")
    fine: Column = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _MOST))
    usable = F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine, F.lit(False))
    whole = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + SHIFT)
    return vectors.filter(usable).select("vec_id", whole.alias("x"))


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]].reshape(-1, size)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each length: the number of vectors (place -1) and the sum of each component."""
    sums: dict = {}
    for batch in batches:
        sizes = np.diff(batch.column("x").offsets.to_numpy())
        for size in np.unique(sizes).tolist():
            x = _matrix(batch.column("x").filter(pa.array(sizes == size)), size)
            add = np.concatenate([[len(x)], x.sum(axis=0)])
            sums[size] = sums.get(size, 0) + add
    for size, total in sums.items():
        places = np.arange(-1, size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(places), size, dtype=np.int32)), pa.array(places), pa.array(total)], names=["size", "place", "total"]
        )


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: np.ndarray
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def size(self) -> int:
        return len(self.sums)

    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n

    def apply(self, x: np.ndarray, components: int) -> np.ndarray:
        return self.centred(x) @ (self.vectors[:, :components] / np.sqrt(self.values[:components]))


def _products(batches: Iterator[pa.RecordBatch], model, components: int | None) -> Iterator[pa.RecordBatch]:
    """Sums of products of centred (or whitened) vectors of this partition, and the sums of the vectors themselves."""
    model, total = model.value, 0
    for batch in batches:
        x = _matrix(batch.column("x"), model.size)
        for lo in range(0, len(x), 8192):
            y = model.centred(x[lo : lo + 8192]) if components is None else model.apply(x[lo : lo + 8192], components)
            y = np.concatenate([y, np.ones((len(y), 1))], axis=1)
            total = total + y.T @ y
    if not np.isscalar(total):
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "total"])


def _covariance(rows: DataFrame, model: Whitening, components: int | None = None) -> np.ndarray:
    """Of all rows, centred before they are multiplied; a matrix as wide as a vector meets on the driver."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    parts = rows.mapInArrow(partial(_products, model=sent, components=components), "i int, j int, total double")
    width = (model.size if components is None else components) + 1
    total = np.zeros((width, width))
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("total")).collect():
        total[i, j] = total[j, i] = value
    mean = total[:-1, -1] / model.n
    return total[:-1, :-1] / model.n - np.outer(mean, mean)


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH."""
    n = len(a)
    x, low, eye = a / np.linalg.norm(a), 1e-16, np.eye(n)
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        p = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:  # far from orthogonal: by a QR factorisation, which is stable then
            whole = np.linalg.qr(np.concatenate([np.sqrt(r) * x, eye]))[0]
            new = q / r * x + (p - q / r) / np.sqrt(r) * whole[:n] @ whole[n:].T
        else:
            half = np.linalg.cholesky(eye + r * x.T @ x)
            new = q / r * x + (p - q / r) * np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (p + q * square) / (1 + r * square))
        if moved < 1e-14 * np.sqrt(n) and low > 1 - 1e-12:
            break
    return x


def _split(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the subspaces above and below a shift. A diagonal entry lies between the least and the greatest
    eigenvalue, so a shift between two entries has some on either side."""
    n, diagonal = len(a), np.sort(np.diag(a))
    gaps = np.diff(diagonal)
    middle = np.abs(np.arange(1, n) - n / 2)
    scale = np.linalg.norm(a)
    for i in np.argsort(-(gaps / scale) / (1 + middle))[:8]:
        if gaps[i] < 1e-13 * scale:
            break
        for share in (0.5, 0.31, 0.73):
            sign = polar(a - (diagonal[i] + share * gaps[i]) * np.eye(n))
            projector = (sign + np.eye(n)) / 2
            above = int(round(np.trace(projector)))
            # An eigenvalue too near to the shift is on neither side.
            if 0 < above < n and np.linalg.norm(projector @ projector - projector) < 1e-10 * n:
                base = np.linalg.qr(projector @ rng.standard_normal((n, above)))[0]
                base = np.linalg.qr(projector @ base, mode="complete")[0]
                return base[:, :above], base[:, above:]
    return None


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix by spectral divide and conquer."""
    rng = np.random.default_rng(0)
    values, vectors, todo = [], [], [(a, np.eye(len(a)))]
    small = 1e-15 * np.linalg.norm(a)
    while todo:
        block, base = todo.pop()
        block = (block + block.T) / 2
        n = len(block)
        if n == 2 and abs(block[0, 1]) > small:
            angle = 0.5 * np.arctan2(2 * block[0, 1], block[0, 0] - block[1, 1])
            turn = np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])
            block, base = turn.T @ block @ turn, base @ turn
        elif n > 2 and np.linalg.norm(block - np.diag(np.diag(block))) > small:
            for _ in range(6):
                halves = _split(block, rng)
                if halves is not None:
                    break
                # Entries of the diagonal (nearly) alike: turned at random, they differ where the eigenvalues do.
                turn = np.linalg.qr(rng.standard_normal((n, n)))[0]
                block, base = turn.T @ block @ turn, base @ turn
                block = (block + block.T) / 2
            if halves is not None:
                todo += [(half.T @ block @ half, base @ half) for half in halves]
                continue
        values.append(np.diag(block))
        vectors.append(base)
    vectors = np.linalg.qr(np.concatenate(vectors, axis=1))[0] if vectors else np.empty((0, 0))
    vectors = _refined(a, vectors)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _refined(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One step towards exact eigenvectors: mixes in what a first-order correction says, where eigenvalues lie apart."""
    for _ in range(2):
        rest, inner = np.eye(len(a)) - x.T @ x, x.T @ a @ x
        values = np.diag(inner) / (1 - np.diag(rest))
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > 1e-10 * np.abs(values).max()
        step = np.where(far, (inner + values[None, :] * rest) / np.where(far, gap, 1), rest / 2)
        np.fill_diagonal(step, np.diag(rest) / 2)
        x = np.linalg.qr(x + x @ step)[0]
    return x


def fit(vectors: DataFrame) -> Whitening | None:
    """The whitening of all usable vectors; None if there are none or they are all alike."""
    rows = grid(vectors)
    totals = settle(rows.select("x").mapInArrow(_sums, "size int, place int, total bigint").groupBy("size", "place").agg(F.sum("total").alias("total")))
    most = totals.filter("place = -1").orderBy(F.desc("total"), "size").first()
    if most is None:
        return None
    found = {r["place"]: r["total"] for r in totals.filter(F.col("size") == most["size"]).collect()}
    sums = np.array([found[i] for i in range(most["size"])], dtype=np.int64)
    nothing = np.empty((0, 0))
    model = Whitening(most["total"], sums, nothing, nothing, nothing)
    covariance = _covariance(_fitting(rows, model).select("x"), model)
    if not covariance.any():
        return None
    values, directions = eigen(covariance)
    kept = values > 1e-13 * len(values) * values[0]
    return replace(model, covariance=covariance, values=values[kept], vectors=directions[:, kept])


def _fitting(rows: DataFrame, model: Whitening) -> DataFrame:
    return rows.filter(F.size("x") == model.size)


def _whiten(batches: Iterator[pa.RecordBatch], model, components: int) -> Iterator[pa.RecordBatch]:
    model = model.value
    most = int(np.sqrt((1 << 62) / model.size))
    for batch in batches:
        x = _matrix(batch.column("x"), model.size)
        y = model.apply(x, components)
        apart = model.n * x - model.sums
        if len(x) and np.abs(apart).max() > most:  # beyond 64 bits in places: exact numbers, null where they do not fit
            squares = [sum(int(v) ** 2 for v in row) for row in apart]
            squares = pa.array([s if s < 1 << 63 else None for s in squares], pa.int64())
        else:
            squares = pa.array(np.einsum("ij,ij->i", apart, apart))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * components), pa.array(y.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), squares, lists], names=["vec_id", "deviation", "whitened"])


def whiten(vectors: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, deviation, whitened): coordinates in the first components, and the squared distance from the sum, n times
    as far as from the mean."""
    many = min(components, len(model.values))
    kind = vectors.schema["vec_id"].dataType.simpleString()
    sent = vectors.sparkSession.sparkContext.broadcast(model)
    return _fitting(grid(vectors), model).mapInArrow(
        partial(_whiten, model=sent, components=many), f"vec_id {kind}, deviation bigint, whitened array<double>"
    )


def identity_error(vectors: DataFrame, model: Whitening, components: int = COMPONENTS) -> float:
    """How far the covariance of the whitened vectors is from the identity, over all of them."""
    many = min(components, len(model.values))
    found = _covariance(_fitting(grid(vectors), model).select("x"), model, many)
    return float(np.abs(found - np.eye(many)).max())


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    model = fit(vectors)
    if model is None:
        columns = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], columns)
    shares = F.array(*[F.lit(float(s)) for s in model.explained()[:COMPONENTS]])
    rows = whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(identity_error(vectors, model)).alias("identity_error"),
    )
