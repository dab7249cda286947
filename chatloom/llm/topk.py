"""Exact top-k search by distributed histogram selection.

Queries and candidates are packed into blocks, and every query block meets every candidate block. A pass scores each
meeting and counts scores in bins between a query's bounds; the counts, added over all candidates, tell in which bin the
k-th score lies, and that bin becomes the query's bounds of the next pass, until a bin is one score wide. A last pass
keeps scores above the k-th and, at the k-th, as many of the smallest ids as are wanted.

What a meeting passes on is bounded without loss: a block's k-th score is no more than the k-th of all, so bins below
the one that holds it never matter, and of equal scores only the k smallest ids of a block can be among the chosen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, reachable

#: Rows in a block of queries and of candidates; bins of a pass.
QUERY_ROWS, ROWS, BINS = 1024, 2048, 256
#: Components and scores beyond this, either way, are taken as this; below EXACT, sums of doubles are exact.
MOST, EXACT = float(1 << 62), float(1 << 53)
LEAST_SCORE = -(1 << 62) + 1


def scaled(rows: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): floor(scale * x) of each component, as a double; rows whose vector is null or has null or non-finite
    components go."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(False)))
    return rows.select("id", F.transform(v, lambda x: F.floor(F.greatest(F.lit(-MOST), F.least(F.lit(MOST), x * F.lit(float(scale))))).cast("double")).alias("v"))


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows packed into blocks of at most size rows of one dimension: (block id, dim, n, ids, values as float64)."""
    schema = pa.schema([(name, pa.string()), ("dim", pa.int32()), (f"{name}_ids", pa.binary()), (f"{name}_values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        part, made = 0, 0

        def block(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, values = held.pop(dim)
            made += 1
            columns = [[f"{part}-{made}"], [dim], [np.array(ids, "<i8").tobytes()], [np.array(values, "<f8").tobytes()]]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            if batch.num_rows:
                part = batch.column(2)[0].as_py()
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = v.values.to_numpy(zero_copy_only=False)
                ids, values = held.setdefault(len(x), ([], []))
                ids.append(i)
                values.append(x)
                if len(ids) == size:
                    yield block(len(x))
        for dim in list(held):
            yield block(dim)

    return rows.select("id", "v", F.spark_partition_id().alias("p")).mapInArrow(run, f"{name} string, dim int, {name}_ids binary, {name}_values binary")


def _scores(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and scores of a meeting, and which of them take part: not a query's own row.

    Rows whose sums could pass what doubles hold exactly are summed as integers of any size instead.
    """
    q, c = np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["c_ids"], "<i8")
    a, b = np.frombuffer(r["q_values"]).reshape(len(q), -1), np.frombuffer(r["c_values"]).reshape(len(c), -1)
    long_a, long_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    if long_a.max(initial=0) * long_b.max(initial=0) * (1 + 1e-9) < EXACT:
        return q, c, (a @ b.T).astype(np.int64), q[:, None] != c[None, :]
    large_a, large_b = (np.flatnonzero(x * y.max(initial=0) * (1 + 1e-9) >= EXACT) for x, y in ((long_a, long_b), (long_b, long_a)))
    plain_a, plain_b = np.setdiff1d(np.arange(len(q)), large_a), np.setdiff1d(np.arange(len(c)), large_b)
    scores = np.zeros((len(q), len(c)), np.int64)
    scores[np.ix_(plain_a, plain_b)] = (a[plain_a] @ b[plain_b].T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)
    wide_a, wide_b = whole(a), whole(b)
    for i, j in ((large_a, np.arange(len(c))), (plain_a, large_b)):
        if len(i) and len(j):
            scores[np.ix_(i, j)] = np.clip(wide_a[i] @ wide_b[j].T, LEAST_SCORE, -LEAST_SCORE).astype(np.int64)
    return q, c, scores, q[:, None] != c[None, :]


def _counted(bins: int, step: int, width: int):
    """Counts of a meeting's scores from lo to below lo + width by query and bin, from the top as far as a k-th score can be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q, _, scores, ok = _scores(r)
                lo, want = np.frombuffer(r["lo"], "<i8"), np.frombuffer(r["want"], "<i8")
                at = scores - lo[:, None]
                ok &= (at >= 0) & (at < width)
                at //= step
                n = np.bincount((at + np.arange(len(q))[:, None] * bins)[ok], minlength=len(q) * bins).reshape(len(q), bins)
                above = np.cumsum(n[:, ::-1], 1)[:, ::-1] - n
                i, b = np.nonzero((n > 0) & (above < want[:, None]))
                yield pa.record_batch([pa.array([r["q"]] * len(i), pa.string()), pa.array(i.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(n[i, b])], names=["q", "i", "bin", "n"])

    return run


def _narrowed(bins: int, step: int, least: int):
    """Bounds of the next pass. A query that has fewer scores than it wants gets the bound below all scores."""
    schema = pa.schema([("q", pa.string()), ("lo", pa.binary()), ("want", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                lo, want = np.frombuffer(r["lo"], "<i8").copy(), np.frombuffer(r["want"], "<i8").copy()
                n = np.zeros((len(lo), bins), np.int64)
                for x in r["found"] or []:
                    n[x["i"], x["bin"]] = x["n"]
                reach = np.cumsum(n[:, ::-1], 1)[:, ::-1]
                live = lo >= least
                full = live & (reach[:, 0] >= want)
                b = (reach >= want[:, None]).sum(1) - 1
                rows = np.flatnonzero(full)
                want[rows] -= (reach - n)[rows, b[rows]]
                lo[rows] += b[rows] * step
                lo[live & ~full] = least - 1
                yield pa.record_batch([pa.array([r["q"]]), pa.array([lo.tobytes()]), pa.array([want.tobytes()])], schema=schema)

    return run


def _chosen(k: int, id_col: str):
    """A meeting's scores above the k-th, and at the k-th as many of the smallest ids as are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q, c, scores, ok = _scores(r)
                lo, want = np.frombuffer(r["lo"], "<i8"), np.frombuffer(r["want"], "<i8")
                order = np.argsort(c, kind="stable")
                c, scores, ok = c[order], scores[:, order], ok[:, order]
                tied = ok & (scores == lo[:, None])
                tied &= np.cumsum(tied, 1) <= want[:, None]
                i, j = np.nonzero(tied | ok & (scores > lo[:, None]))
                yield pa.record_batch([pa.array([r["q"]] * len(i), pa.string()), pa.array(i.astype(np.int32)), pa.array(q[i]), pa.array(c[j]), pa.array(scores[i, j])], names=["q", "i", "query_id", id_col, "score"])

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", query_rows: int = QUERY_ROWS, rows: int = ROWS, bins: int = BINS) -> DataFrame:
    """The k highest inner products of each query over all candidates but rows of its own id: query_id, rank, vec_id, score.

    Vectors are turned into floor(scale * x). Equal scores go to the smaller id; a query with fewer candidates gets
    them all, one with none has no row. Vectors that are null or hold null or non-finite components take no part, nor
    do null ids; vectors of different lengths are not compared. Repeated candidate rows count each, repeated query rows
    are queries each. The search is exact at every size of blocks and bins. Scaled components and scores beyond 2**62 in
    size count as that, as larger scores are no longs. Other columns are not read.
    """
    spark = candidates.sparkSession
    reachable(spark)
    asked = scaled(queries, scale, id_col, vector_col)
    qs = materialize(_blocks(asked.repartition(max(1, -(-asked.count() // query_rows))), query_rows, "q"), "queries")
    cs = materialize(_blocks(scaled(candidates, scale, id_col, vector_col), rows, "c"), "candidates")
    longest = scaled(candidates, scale, id_col, vector_col).union(asked).agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first().m
    if longest is None:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long")
    longest = min(int(longest * (1 + 1e-9)) + 1, -LEAST_SCORE)
    least, width = -longest, 2 * longest + 1
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = len(r["q_ids"]) // 8
                yield pa.record_batch([pa.array([r["q"]]), pa.array([np.full(n, least, "<i8").tobytes()], pa.binary()), pa.array([np.full(n, k, "<i8").tobytes()], pa.binary())], names=["q", "lo", "want"])

    def met(bounds: DataFrame) -> DataFrame:
        """Every query block, with its bounds, beside every candidate block of its dimension."""
        asking = qs.select("q", "dim", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        pairs = asking.join(cs.select("c", "dim", F.pmod(F.xxhash64("c"), F.lit(salts)).cast("int").alias("salt")), ["dim", "salt"]).select("q", "c")
        return pairs.join(qs.join(bounds, "q"), "q").join(cs.drop("dim"), "c")

    bounds = qs.select("q", "q_ids").mapInArrow(begin, "q string, lo binary, want binary")
    while width > 1:
        step = -(-width // bins)
        counts = met(bounds).mapInArrow(_counted(bins, step, width), "q string, i int, bin int, n long").groupBy("q", "i", "bin").agg(F.sum("n").alias("n"))
        found = counts.groupBy("q").agg(F.collect_list(F.struct("i", "bin", "n")).alias("found"))
        bounds = materialize(bounds.join(found, "q", "left").mapInArrow(_narrowed(bins, step, least), "q string, lo binary, want binary"), "bounds")
        width = step
    out = met(bounds).mapInArrow(_chosen(k, id_col), f"q string, i int, query_id long, {id_col} long, score long")
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("q", "i").orderBy(F.desc("score"), id_col)))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
