"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Vectors become integers, so that sums, centres and deviations are exact. A step takes one pass over the table: each task
multiplies its centred rows X by a vector (Xv), takes from that what lies along earlier left vectors, and multiplies back
(X'u); only sums as long as a vector come out. Left vectors have an entry for each row; they are never stored, as each is X
times a short vector that is kept instead. Right vectors are few and short and are kept orthogonal on the driver. The small
bidiagonal matrix has the singular values of X, and its singular vectors turn the right vectors into components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, reachable

#: Rows in a block; what counts as rounding beside the largest singular value; least variance, beside the largest, of a component.
ROWS, ROUNDING, LEAST = 4096, 4 * np.finfo(float).eps, 1e-12


@dataclass
class Whitening:
    """n vectors with exact sums of their integers (less `offset`), components as columns, and the variance along each."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    steps: int


def _x(blocks: pa.RecordBatch, i: int, d: int) -> np.ndarray:
    return np.frombuffer(blocks.column("x")[i].as_buffer(), "<i8").reshape(-1, d)


def _blocked(size: int):
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                b = batch.slice(at, size)
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i8")
                yield pa.record_batch([pa.array([b.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())], schema=schema)

    return run


def _summed(blocks: DataFrame, make, n: int) -> np.ndarray:
    """Sums over all blocks of the n numbers that make gives for the rows of one, added up on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for b in batches:
            for i in range(b.num_rows):
                total += make(b, i)
        yield pa.record_batch([pa.array(np.arange(n, dtype=np.int32)), pa.array(total)], names=["i", "s"])

    got = blocks.select("x").mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros(n)
    out[got.column("i").to_numpy()] = got.column("s").to_numpy()
    return out


def _off(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """v less what lies along the columns of basis, twice, as once leaves rounding behind."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def _bidiagonal(blocks: DataFrame, n: int, sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The k largest singular values of the centred rows, right singular vectors as columns, and how many steps it took."""
    d = len(sums)
    mean = sums / n
    draw = np.random.default_rng(12)
    right = np.zeros((d, 0))  # right vectors
    left = np.zeros((d, 0))  # left vector j is X @ left[:, j]
    back = np.zeros((d, 0))  # X.T @ left vector j
    alphas: list[float] = []
    betas: list[float] = []
    v, beta, low = draw.normal(size=d), 0.0, 0.0
    v /= np.linalg.norm(v)
    while True:
        w = v - beta * left[:, -1] if beta else v

        def step(b: pa.RecordBatch, i: int, w=w, left=left) -> np.ndarray:
            x = _x(b, i, d) - mean
            p = x @ w
            return np.concatenate([[p @ p], (x @ left).T @ p, x.T @ p])

        got = _summed(blocks, step, 1 + left.shape[1] + d)
        along, xp = got[1 : 1 + left.shape[1]], got[1 + left.shape[1] :]
        norm = np.sqrt(max(0.0, got[0] - along @ along))
        low = max(low, norm)
        alpha = norm if norm > ROUNDING * low * np.sqrt(n) else 0.0
        right = np.column_stack([right, v])
        # a left vector of no length is left out: its column is zero, and so is what comes of it
        left = np.column_stack([left, (w - left @ along) / alpha if alpha else np.zeros(d)])
        back = np.column_stack([back, (xp - back @ along) / alpha if alpha else np.zeros(d)])
        alphas.append(alpha)
        m = len(alphas)
        rest = _off(back[:, -1] - alpha * v, right)
        beta = float(np.linalg.norm(rest))
        b = np.diag(alphas) + np.diag(betas, 1)
        u, s, vt = np.linalg.svd(b)
        if beta <= 1e-13 * max(s[0], np.finfo(float).tiny):
            beta = 0.0
        done = m >= k and beta and (beta * np.abs(u[-1, :k]) <= ROUNDING * s[0]).all()
        if m == d or done:
            return s[:k], (right @ vt.T)[:, :k], m
        if beta:
            v = rest / beta
        else:
            # these directions are closed under X'X; others, of values met or smaller, are looked for beside them
            v = _off(draw.normal(size=d), right)
            v /= np.linalg.norm(v)
        betas.append(beta)


def embedding_blocks(rows: DataFrame, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """Vectors as integers floor(scale * c), in blocks of rows (ids, x), and their length.

    Vectors that are null or empty or hold null or non-finite entries are left out, and so are vectors of another length than
    most have (the longer one, if two lengths are as frequent). Entries beyond what longs hold count as the last one they do.
    """
    v = F.col("v")
    base = rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].cast("array<double>").alias("v"))
    sound = v.isNotNull() & (F.size("v") > 0) & ~F.coalesce(F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(True))
    base = base.filter(sound)
    most = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most.d if most else 1
    x = base.filter(F.size("v") == d).select("id", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))
    reachable(rows.sparkSession)
    return materialize(x.mapInArrow(_blocked(ROWS), "ids array<bigint>, x binary"), "whitening"), d


def fit_whitening(blocks: DataFrame, d: int, k: int = 8) -> Whitening:
    """The k components of largest variance over all rows of `embedding_blocks`; fewer where fewer vary (none for equal rows)."""
    schema = pa.schema([("i", pa.int32()), ("s", pa.int64())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = _x(b, i, d)
                yield pa.record_batch([pa.array(np.arange(d + 1, dtype=np.int32)), pa.array(np.append(x.sum(0), len(x)))], schema=schema)

    got = {r.i: int(r.s) for r in blocks.select("x").mapInArrow(sums, "i int, s long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    n, total = got.get(d, 0), [got.get(i, 0) for i in range(d)]
    if not n:
        return Whitening(0, total, np.zeros((d, 0)), np.zeros(0), 0.0, 0)
    mean = np.array(total, float) / n
    trace = float(_summed(blocks, lambda b, i: np.array([((_x(b, i, d) - mean) ** 2).sum()]), 1)[0]) / n
    if not trace:
        return Whitening(n, total, np.zeros((d, 0)), np.zeros(0), 0.0, 0)
    s, v, steps = _bidiagonal(blocks, n, np.array(total, float), min(k, d))
    e = s**2 / n
    real = e > LEAST * e[0]
    return Whitening(n, total, v[:, real], e[real], trace, steps)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of squares of n * x - sums by row; null where they are beyond what longs hold."""
    reach = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0)) * 2
    if reach * reach * len(sums) < 2**63:
        c = x * n - np.array(sums, np.int64)
        return (c * c).sum(1).tolist()
    exact = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return [e if e < 2**63 else None for e in exact]


def whiten(blocks: DataFrame, model: Whitening, id_col: str = "vec_id") -> DataFrame:
    """A row for each row of the blocks and component: id_col, component (from 1, by falling variance), n, deviation (sum over
    dimensions of the squares of n times the integer less the sum), whitened (centred row along the component, over its standard
    deviation), explained (share of the whole variance) and identity_error (largest entry by which the covariance of all
    whitened rows departs from the identity). Ids may be null or repeat. Without components there are no rows.
    """
    n, sums, d, k = model.n, model.sums, len(model.sums), len(model.variances)
    mean = np.array(sums, float) / max(n, 1)
    onto = model.components / np.sqrt(model.variances)

    def moments(b: pa.RecordBatch, i: int) -> np.ndarray:
        w = (_x(b, i, d) - mean) @ onto
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    error = 0.0
    if k:
        got = _summed(blocks, moments, k + k * k)
        at = got[:k] / n
        error = float(np.abs(got[k:].reshape(k, k) / n - np.outer(at, at) - np.eye(k)).max())
    explained = model.variances / model.trace if k else np.zeros(0)
    schema = pa.schema([(id_col, pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, ids in enumerate(b.column("ids").to_pylist()):
                x = _x(b, i, d)
                m = len(x)
                columns = [np.repeat(np.arange(m), k), np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, n), ((x - mean) @ onto).ravel(), np.tile(explained, m), np.full(m * k, error)]
                at, component, count, w, share, wrong = map(pa.array, columns)
                yield pa.record_batch([pa.array(ids, pa.int64()).take(at), component, count, pa.array(_deviations(x, n, sums), pa.int64()).take(at), w, share, wrong], schema=schema)

    return blocks.mapInArrow(run, f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double, identity_error double")
