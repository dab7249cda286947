"""Postings in blocks with bounds, and exact searches for the best rows that leave out blocks which can't hold any.

A term's postings are dealt by a hash of the row into parts of bounded size and, within a part, stand in blocks by falling weight;
a block tells its largest. A row's score is a sum over the query's terms. With a lower bound of the query's k-th score known, a
row that reaches it is found through the first of its terms, in an order of the query's terms by what they add at most: so a
block is read only if its bound and all that later terms add at most reach the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import reachable, stored

#: Postings in a block, about how many in a part of a term, blocks of a query that its first bound is taken from.
BLOCK, PART, SEEDS = 1024, 65_536, 8
_SHAPE = "term string, part int, block int, top double, size long, ids array<bigint>, weights array<double>"


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        ids: list[int] = []
        weights: list[float] = []
        number = 0

        def block() -> tuple:
            return (*held, number, weights[0], len(ids), ids.copy(), weights.copy())

        for batch in batches:
            out = []
            for term, part, i, w in zip(*(batch.column(n).to_pylist() for n in ("term", "part", "id", "weight")), strict=True):
                if held != (term, part) or len(ids) == size:
                    if ids:
                        out.append(block())
                    number = number + 1 if held == (term, part) else 0
                    held = (term, part)
                    ids.clear()
                    weights.clear()
                ids.append(i)
                weights.append(w)
            if out:
                yield _blocks(out)
        if ids:
            yield _blocks([block()])

    return run


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["term", "part", "block", "top", "size", "ids", "weights"])


def posting_blocks(index: DataFrame, size: int = BLOCK, part: int = PART) -> DataFrame:
    """(term, part, block, top, size, ids, weights) of an index (id, term, weight). A term in most rows has many parts."""
    reachable(index.sparkSession)
    many = stored(index.groupBy("term").agg(F.count("*").alias("n")).filter(F.col("n") > part).select("term", F.ceil(F.col("n") / part).cast("int").alias("parts")), "long-postings")
    # terms with more postings than a part are fewer than postings over the size of a part; a hash deals theirs before they meet
    split = index.join(F.broadcast(many), "term", "left") if many.count() <= 1_000_000 else index.join(many, "term", "left")
    dealt = split.select("term", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("part"), F.col("id").cast("long").alias("id"), F.col("weight").cast("double").alias("weight"))
    return dealt.repartition("term", "part").sortWithinPartitions("term", "part", F.desc("weight"), "id").mapInArrow(_cut(size), _SHAPE)


def search(queries: DataFrame, blocks: DataFrame, index: DataFrame, k: int, least: float = 0.0, seeds: int = SEEDS) -> tuple[DataFrame, DataFrame]:
    """(query_id, id, score) of rows with scores above least, the k best of each query and all that tie with them among them; and
    (query_id, blocks, read, rows): blocks that hold the query's terms, those of them that were read, rows whose scores were summed.

    queries are (query_id, term, qw), index (id, term, weight) and blocks those of `posting_blocks` of it, both stored; weights
    must not be negative. A query without known terms has no rows.
    """
    key = ["term", "part", "block"]
    asked = stored(queries.filter("qw > 0").join(blocks.select(*key, "top"), "term").withColumn("bound", F.col("qw") * F.col("top")), "asked-blocks")

    def met(of: DataFrame) -> DataFrame:
        """(query_id, id, term, s): what postings of blocks add."""
        both = of.join(blocks.select(*key, "ids", "weights"), key).select(*of.columns, F.explode(F.arrays_zip("ids", "weights")).alias("p"))
        return both.select(*of.columns, F.col("p.ids").alias("id"), (F.col("qw") * F.col("p.weights")).alias("s"))

    def summed(pairs: DataFrame) -> DataFrame:
        """Whole scores of (query_id, id)."""
        return pairs.join(index, "id").join(queries, ["query_id", "term"]).groupBy("query_id", "id").agg(F.sum(F.col("qw") * F.col("weight")).alias("score"))

    # a lower bound of the k-th score: whole scores of the rows that stand out in the blocks with the highest bounds
    place = lambda *by: F.row_number().over(Window.partitionBy("query_id").orderBy(*by))
    some = met(asked.withColumn("n", place(F.desc("bound"), *key)).filter(F.col("n") <= seeds).select("query_id", "qw", *key)).groupBy("query_id", "id").agg(F.sum("s").alias("s"))
    some = summed(some.withColumn("n", place(F.desc("s"), "id")).filter(F.col("n") <= 4 * k).select("query_id", "id"))
    kth = some.withColumn("n", place(F.desc("score"))).filter(F.col("n") == k).select("query_id", F.col("score").alias("kth"))
    # what the terms after each add at most, terms in falling order of what they add
    order = Window.partitionBy("query_id").orderBy(F.desc("most"), "term")
    most = asked.groupBy("query_id", "term").agg(F.max("bound").alias("most"))
    most = most.withColumn("later", F.coalesce(F.sum("most").over(order.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0))).drop("most")
    gate = (F.greatest(F.coalesce("kth", F.lit(0.0)), F.lit(least)) - 1e-8).alias("gate")
    reached = asked.join(most, ["query_id", "term"]).join(kth, "query_id", "left").select("query_id", "qw", *key, "bound", "later", gate)
    reached = stored(reached.withColumn("read", F.col("bound") + F.col("later") >= F.col("gate")), "reached-blocks")
    # a row adds what was read of it, and for each other term at most the largest bound of the blocks left out
    left = reached.groupBy("query_id", "term").agg(F.max("gate").alias("gate"), F.coalesce(F.max(F.when(~F.col("read"), F.col("bound"))), F.lit(0.0)).alias("unread"))
    every = left.groupBy("query_id").agg(F.sum("unread").alias("all"), F.max("gate").alias("gate"))
    parts = met(reached.filter("read").select("query_id", "qw", *key)).join(left.drop("gate"), ["query_id", "term"])
    upper = parts.groupBy("query_id", "id").agg(F.sum(F.col("s") - F.col("unread")).alias("s")).join(every, "query_id").filter(F.col("s") + F.col("all") >= F.col("gate"))
    found = stored(upper.select("query_id", "id"), "found-rows")
    report = reached.groupBy("query_id").agg(F.count("*").alias("blocks"), F.count_if("read").alias("read")).join(found.groupBy("query_id").agg(F.count("*").alias("rows")), "query_id", "left")
    return summed(found).filter(F.col("score") > least), report
