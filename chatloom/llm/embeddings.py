"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one representative per group.

Equal vectors are taken once, with their number. Centroids are fitted on a bounded sample; every vector has a home, the
cell of its nearest centroid, and is a guest of the cells whose border it is near. In a cell, homes are compared with all
its vectors, block by block. A block yields the number of links of its homes and a few links that connect the same
vectors as all of its links do, so that large groups cost products but no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, reachable
from .components import components

#: Vectors that centroids are fitted on (about, by a hash of the id), rounds of fitting, most cells, rows in a block.
SAMPLE, ROUNDS, CELLS, ROWS = 100_000, 4, 8192, 2048


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit vectors, in double precision, of an array column whose rows have one length. Vectors of any size keep their
    direction, as each is divided by its largest component first."""
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    v = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), -1)
    v = v / np.maximum(np.abs(v).max(1, initial=0, keepdims=True), np.finfo(float).tiny / 4)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Table]]:
    t = pa.Table.from_batches([batch])
    sizes = np.array([len(v) for v in batch.column("v")]) if batch.num_rows else np.zeros(0, int)
    for d in np.unique(sizes):
        yield int(d), t.filter(pa.array(sizes == d))


def _spread(x: np.ndarray) -> float:
    """In how many directions unit vectors spread: their dimension if evenly in all, fewer if some hold most."""
    c = x.T @ x
    return max(1.0, float(np.trace(c) ** 2 / max((c * c).sum(), 1e-300)))


def _fit(vectors: DataFrame, cells: int | None, sample: int, rounds: int) -> dict[int, tuple[np.ndarray, float]]:
    """Centroids, and the spread of vectors, by dimension. Sums of vectors by cell are made on the executors; k x dim
    numbers reach the driver."""
    out = {}
    for d, n in vectors.groupBy("dim").count().collect():
        k = cells or int(min(CELLS, max(1, round(math.sqrt(n) / 4))))
        some = materialize(vectors.filter((F.col("dim") == d) & (F.pmod(F.xxhash64("rep"), F.lit(-(-n // sample))) == 0)).select("rep", "v"), "sample")
        first = some.orderBy(F.xxhash64("rep", F.lit(1)), "rep").limit(k).toArrow()
        centre = _matrix(first.column("v")) if first.num_rows else np.zeros((0, d))
        if not len(centre):
            first = vectors.filter(F.col("dim") == d).orderBy("rep").limit(1).toArrow()
            centre = _matrix(first.column("v"))
        spread = _spread(centre)
        for _ in range(rounds if len(centre) > 1 else 0):

            def sums(batches, centre=centre):
                total = np.zeros_like(centre)
                for batch in batches:
                    if batch.num_rows:
                        x = _matrix(batch.column("v"))
                        np.add.at(total, (x @ centre.T).argmax(1), x)
                cell, place = np.nonzero(total)
                yield pa.record_batch([pa.array(cell.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(total[cell, place])], names=["cell", "place", "s"])

            moved = some.select("v").mapInArrow(sums, "cell int, place int, s double").groupBy("cell", "place").agg(F.sum("s").alias("s")).toArrow().to_pydict()
            new = np.zeros_like(centre)
            new[moved["cell"], moved["place"]] = moved["s"]
            norm = np.linalg.norm(new, axis=1)
            centre = np.where(norm[:, None] > 0, new / np.where(norm > 0, norm, 1)[:, None], centre)
        out[d] = centre, spread
    return out


def _placed(centres: Broadcast, reach: float, margin: float | None, kind: pa.DataType):
    """(dim, cell, home, rep, n, v): each vector in its home, and as a guest where it is near the border."""
    schema = pa.schema([("dim", pa.int32()), ("cell", pa.int32()), ("home", pa.bool_()), ("rep", pa.int64()), ("n", pa.int64()), ("v", pa.list_(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for d, t in _by_dim(whole):
                c, spread = centres.value[d]
                near = min(reach, 3 * reach / math.sqrt(spread) if margin is None else margin)
                apart = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))
                for part in t.to_batches(max_chunksize=2048):
                    s = _matrix(part.column("v")) @ c.T
                    home = s.argmax(1)
                    gap = s[np.arange(len(s)), home][:, None] - s
                    i, cell = np.nonzero(gap <= near * apart[home] + 1e-12)
                    at = pa.array(i)
                    yield pa.record_batch([pa.array(np.full(len(i), d, np.int32)), pa.array(cell.astype(np.int32)), pa.array(cell == home[i]), part.column("rep").take(at), part.column("n").take(at), part.column("v").take(at)], schema=schema)

    return run


def _compared(least: float):
    """For one block of homes beside one block of a cell's vectors: links of each home, and links that connect them."""
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        asks = np.array(table.column("asks"))
        ids, n, x = np.array(table.column("rep")), np.array(table.column("n")), _matrix(table.column("v"))
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        linked = (x[a] @ x[b].T >= least) & (ids[a][:, None] != ids[b][None, :])
        links = linked @ n[b]
        rows, columns = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
        linked = linked[np.ix_(rows, columns)]
        of_a, of_b, none = ids[a][rows], ids[b][columns], np.iinfo(np.int64).max
        while len(rows):
            new_b = np.minimum(of_b, np.where(linked, of_a[:, None], none).min(0))
            new_a = np.minimum(of_a, np.where(linked, new_b[None, :], none).min(1))
            if (new_a == of_a).all() and (new_b == of_b).all():
                break
            of_a, of_b = new_a, new_b
        out = [np.concatenate([ids[a][rows], ids[a][rows], ids[b][columns]]), np.concatenate([links[rows], np.zeros(len(rows) + len(columns), np.int64)]), np.concatenate([ids[a][rows], of_a, of_b])]
        return pa.table([pa.array(c, pa.int64()) for c in out], schema=schema)

    return run


def cosine_groups(rows: DataFrame, least: float = 0.95, cells: int | None = None, margin: float | None = None, sample: int = SAMPLE, rounds: int = ROUNDS, block: int = ROWS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Groups of vectors linked by a cosine of at least `least`, in double precision.

    Returns id_col, n_links (other vectors linked directly), component_id (smallest id reachable by links, itself
    included) and kept (whether the id is the component's). Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing, nor do vectors of different lengths. Rows of a null id count as vectors of
    their own but name no group: they come back without links. Repeated ids are rows each and share a component.
    Every link found has the cosine asked for. A link can be missed only where its two vectors lie on both sides of a
    border between cells and both further from it than `margin`; None stands for three standard deviations of the
    distance in as many directions as the vectors spread, a margin of sqrt(2 - 2 * least) misses none. Floats stay floats,
    other numbers become doubles. Centroids, at most CELLS for a length, are broadcast. Other columns are not read.
    """
    reachable(rows.sparkSession)
    v = F.col("v")
    kind = "float" if rows.schema[vector_col].dataType == T.ArrayType(T.FloatType(), rows.schema[vector_col].dataType.containsNull) else "double"
    rows = rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].cast(f"array<{kind}>").alias("v"))
    sound = F.col("id").isNotNull() & v.isNotNull() & (F.size("v") > 0) & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    good = rows.filter("sound").select("id", F.transform("v", lambda x: x + F.lit(0.0).cast(kind)).alias("v"))
    vectors = materialize(good.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")).withColumn("dim", F.size("v")), "vectors")
    sent = rows.sparkSession.sparkContext.broadcast(_fit(vectors, cells, sample, rounds))
    reach = math.sqrt(2 - 2 * least)
    placed = materialize(vectors.select("rep", "n", "v").mapInArrow(_placed(sent, reach, margin, pa.float32() if kind == "float" else pa.float64()), f"dim int, cell int, home boolean, rep long, n long, v array<{kind}>"), "placed")
    # a row for each cell, of which there are at most CELLS for a dimension
    sizes = placed.groupBy("dim", "cell").agg(F.ceil(F.count_if("home") / block).cast("int").alias("homes"), F.ceil(F.count("*") / block).cast("int").alias("all"))
    placed = placed.join(F.broadcast(sizes), ["dim", "cell"])
    mine = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    asked = placed.filter("home").select("dim", "cell", F.lit(True).alias("asks"), "rep", "n", "v", mine("homes").alias("i"), F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("j"))
    other = placed.filter("homes > 0").select("dim", "cell", F.lit(False).alias("asks"), "rep", "n", "v", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)).alias("i"), mine("all").alias("j"))
    found = asked.unionByName(other).groupBy("dim", "cell", "i", "j").applyInArrow(_compared(least), "rep long, links long, to long")
    found = materialize(found, "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.filter("rep <> to"), "rep", "to")
    of = vectors.join(links, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left").select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = good.join(of, "v").select("id", "n_links", "component_id")
    alone = rows.filter(~F.col("sound")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.union(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
