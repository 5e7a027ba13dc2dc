"""Embedding whitening: principal components by Golub-Kahan-Lanczos bidiagonalisation over distributed rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavid.llm.common import stored
from stratavid.llm.vectors import commonest_length, usable, whole

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
# Vectors of one stored block.
BLOCK = 4096
# Singular values below this share of the largest are zero.
TINY = 1e-12

OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def _blocks(rows: DataFrame) -> DataFrame:
    """The vectors in blocks: ids, and the entries as bytes of longs, one vector after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("vec_id"))
                yield pa.record_batch([ids, pa.array([x.tobytes()], pa.binary())], ["ids", "x"])

    return rows.mapInArrow(run, "ids array<long>, x binary")


def _opened(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    for x in batch.column("x"):
        yield np.frombuffer(x.as_buffer(), np.int64).reshape(-1, d)


def _summed(blocks: DataFrame, d: int, size: int, kind: str, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``of_block`` (``size`` values): summed in each task, then by value in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _opened(batch, d):
                found = of_block(x)
                total = found if total is None else total + found
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "v"])

    parts = blocks.mapInArrow(run, f"i int, v {kind}")
    out = np.zeros(size, np.int64 if kind == "long" else np.float64)
    for row in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():  # ``size`` rows
        out[row["i"]] = row["v"]
    return out


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n; the difference is taken between whole numbers, so nothing cancels."""
    return (n * x - sums) / n


def bidiagonal(products: Callable[[np.ndarray, np.ndarray, float], np.ndarray], d: int) -> tuple[np.ndarray, np.ndarray]:
    """V (orthonormal columns) and the upper bidiagonal B with X V = U B, U orthonormal.

    ``products(v, P, b)`` is one distributed pass over the centred rows X. With y = X v - b X p (p the
    last column of P) it gives Xᵀy, then (X P)ᵀy, then yᵀy. Left vectors are never stored: each is
    X p for a short p, so U is X P. Step by step:

    * y is made orthogonal to all earlier left vectors by the products (X P)ᵀy, its length is alpha;
    * Xᵀu, made orthogonal to all earlier right vectors, gives the next one, its length is beta.

    Where beta vanishes (an invariant subspace, as with equal singular values) the next right vector
    is a new one, orthogonal to all so far; where alpha vanishes X has no such direction and the
    left vector is left out. After d steps V is a whole basis, so no singular value is missed.
    """
    draw = np.random.default_rng(5)
    v = draw.standard_normal(d)
    v /= np.linalg.norm(v)
    right, inner, images = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    b = np.zeros((d, d))
    beta, scale = 0.0, 0.0
    for k in range(d):
        found = products(v, inner, beta)
        image, shared, square = found[:d], found[d:-1], found[-1]
        alpha = np.sqrt(max(square - shared @ shared, 0.0))
        scale = max(scale, alpha)
        right = np.column_stack([right, v])
        if alpha > TINY * scale:
            last = inner[:, -1] if inner.shape[1] else 0.0
            p = (v - beta * last - inner @ shared) / alpha
            image = (image - images @ shared) / alpha
            inner, images = np.column_stack([inner, p]), np.column_stack([images, image])
            b[k, k] = alpha
            rest = image - alpha * v
        else:
            rest = np.zeros(d)
        for _ in range(2):
            rest = rest - right @ (right.T @ rest)
        beta = float(np.linalg.norm(rest))
        if k + 1 == d:
            break
        if beta > TINY * scale:
            v = rest / beta
            b[k, k + 1] = beta
        else:
            beta = 0.0
            v = draw.standard_normal(d)
            for _ in range(2):
                v = v - right @ (right.T @ v)
            v /= np.linalg.norm(v)
    return right, b


def _products(blocks: DataFrame, d: int, n: int, sums: np.ndarray):
    root = np.sqrt(n)

    def products(v: np.ndarray, inner: np.ndarray, beta: float) -> np.ndarray:
        def of_block(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, sums) / root
            left = c @ inner
            y = c @ v
            if inner.shape[1]:
                y = y - beta * left[:, -1]
            return np.concatenate([c.T @ y, left.T @ y, [y @ y]])

        return _summed(blocks, d, d + inner.shape[1] + 1, "double", of_block)

    return products


def whiten(
    rows: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per usable vector and component: OUT.

    Entries c become x = floor(scale * c) + offset. All usable vectors are the fit list, with the
    covariance divided by their number n. ``deviation`` is the exact sum of (n * x - S)**2 over the
    dimensions, ``whitened`` the centred vector on the unit component over its deviation, ``explained``
    the component's share of the variance, ``identity_error`` the largest entry by which the covariance
    of ``whitened``, measured over all rows, differs from the identity.

    A pass over the stored blocks is made for each dimension, for the sums and for the check. A pass
    adds up in its tasks and by value in Spark; the driver sees a few numbers per dimension and never a row.

    Left out are vectors that are null, empty, or hold a null or non-finite entry, and those of another
    length than most. Null and repeated ids and repeated vectors stay, each as a row. Components of no
    variance are left out, so equal vectors (or one alone) give no rows, nor does an empty table.
    Further columns are ignored. Entries whose x, or whose deviation, exceeds a long raise an error.
    """
    vector = F.col(vector_col).cast("array<double>")
    good = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v")).where(usable(F.col("v")))
    x = stored(good.select("vec_id", whole(F.col("v"), scale, offset).alias("x")), "whiten-rows")
    d = commonest_length(x, "x")
    empty = rows.sparkSession.createDataFrame([], OUT)
    if not d:
        return empty
    blocks = stored(_blocks(x.where(F.size("x") == d)), "whiten-blocks")
    found = _summed(blocks, d, d + 1, "long", lambda x: np.append(x.sum(axis=0), len(x)))
    sums, n = found[:d], int(found[d])

    right, b = bidiagonal(_products(blocks, d, n, sums), d)
    _, sigma, turned = np.linalg.svd(b)
    real = int(np.sum(sigma > TINY**0.5 * sigma[0])) if sigma[0] > 0 else 0
    count = min(components, real)
    if not count:
        return empty
    axes = right @ turned.T[:, :count]
    explained = sigma[:count] ** 2 / np.sum(sigma**2)
    factor = axes / sigma[:count]

    def moments(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, sums) @ factor
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    total = _summed(blocks, d, count + count * count, "double", moments) / n
    mean, second = total[:count], total[count:].reshape(count, count)
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(count)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column("ids"), _opened(batch, d)):
                off = n * x - sums
                if float(np.abs(off).max()) ** 2 * d >= 2.0**63:
                    raise OverflowError("a deviation exceeds a long")
                m = len(x)
                repeat = np.repeat(np.arange(m), count)
                columns = [
                    ids.values.take(pa.array(repeat)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * count, n)),
                    pa.array((off * off).sum(axis=1)[repeat]),
                    pa.array(((off / n) @ factor).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * count, error)),
                ]
                yield pa.record_batch(columns, [c.split(" ")[0] for c in OUT.split(", ")])

    return blocks.mapInArrow(run, OUT)
