"""Runs and pairs of turns over range-partitioned tables, by a scan in segments: a conversation may take many tasks.

Turns stand in order of conversation and turn. Each partition is walked by itself, as if nothing came before it, and one row of it
tells how it begins and ends; these rows, one for each partition, are chained in order, and what a partition should have known of
the ones before it is put right in its first run or pair. No window or group by conversation is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import reachable, stored

_SHIFT = 33


def in_order(turns: DataFrame) -> DataFrame:
    """(pos, conv_id, turn, role, text) with pos rising by conversation and turn; its upper bits tell the partition. Not stored: to be
    walked where it was sorted."""
    reachable(turns.sparkSession)
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn")]
    rows = turns.select("conv_id", "turn", "role", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select(F.monotonically_increasing_id().alias("pos"), "*")


def _walk_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, start, at = None, 0, 0
    for batch in batches:
        starts, places = [], []
        for pos, conv, role in zip(*(batch.column(c).to_pylist() for c in ("pos", "conv_id", "role")), strict=True):
            if (conv, role) == held and role is not None:
                at += 1
            else:
                held, start, at = (conv, role), pos, 0
            starts.append(start)
            places.append(at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(starts, pa.int64()), pa.array(places, pa.int64())], names=[*batch.schema.names, "run", "at"])


def role_runs(rows: DataFrame) -> DataFrame:
    """Rows of `in_order` with run, the place of the first turn of the run of one role that they are in, and at, their number in it,
    from 0. A null role is a run of its own."""
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    walked = stored(rows.mapInArrow(_walk_runs, f"{shape}, run long, at long"), "runs")
    part = F.shiftright("pos", _SHIFT)
    first = F.col("run") == F.shiftleft(part, _SHIFT)
    ends = walked.groupBy(part.alias("p")).agg(
        F.min_by(F.struct("conv_id", "role"), "pos").alias("a"), F.max_by(F.struct("conv_id", "role", "run", "at"), "pos").alias("z"), F.sum(first.cast("long")).alias("n")
    )
    lent, before = [], None
    for r in ends.orderBy("p").collect():
        goes_on = before is not None and r.a.role is not None and (r.a.conv_id, r.a.role) == before[:2]
        if goes_on:
            lent.append((r.p, before[2], before[3]))
        of_first = r.z.run == r.p << _SHIFT
        start, size = (before[2], before[3]) if goes_on and of_first else (r.z.run, 0)
        before = (r.z.conv_id, r.z.role, start, size + r.z["at"] + 1)
    known = rows.sparkSession.createDataFrame(lent, "p long, start long, size long")
    met = walked.withColumn("p", part).join(F.broadcast(known), "p", "left")
    mine = first & F.col("start").isNotNull()
    return met.select("pos", "conv_id", "turn", "role", "text", F.when(mine, F.col("start")).otherwise(F.col("run")).alias("run"), (F.col("at") + F.when(mine, F.col("size")).otherwise(0)).alias("at"))


_PAIR = pa.schema([("kind", pa.int32()), ("pos", pa.int64()), ("n", pa.int64()), ("opening", pa.bool_()), ("head", pa.bool_()), ("asked", pa.int64()), ("answered", pa.bool_()), ("question", pa.string()), ("answer", pa.string())])


def _walk_pairs(conv: pa.DataType):
    schema = pa.schema([("first", conv), ("conv_id", conv), *_PAIR])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, first, held, opening = False, None, None, True
        n, head, asked, question, answered, seen = 0, False, None, None, False, False
        last = 0
        for batch in batches:
            out = []
            for pos, c, role, text in zip(*(batch.column(x).to_pylist() for x in ("pos", "conv_id", "role", "text")), strict=True):
                if not some:
                    some, first, held = True, c, c
                elif c != held:
                    # head stays: it tells of the conversation that the partition begins with
                    held, opening, n, asked, question, answered, seen = c, False, 0, None, None, False, False
                last = pos
                if role == "user":
                    asked, question, answered, seen = pos, text, False, True
                elif seen and not answered:
                    out.append((first, c, 0, pos, n, opening, False, None, None, question, text))
                    n, answered = n + 1, True
                elif opening and not seen and not head:
                    # whether this answers anything is known to the partitions before
                    out.append((first, c, 0, pos, 0, True, True, None, None, None, text))
                    head = True
            if out:
                yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        if some:
            # how the partition ends, with the question that is still open
            end = (first, held, 1, last, n, opening, head, asked, answered, None if answered else question, None)
            yield pa.record_batch([pa.array([x], f.type) for x, f in zip(end, schema, strict=True)], schema=schema)

    return run


def asked_and_answered(turns: DataFrame) -> DataFrame:
    """(conv_id, n, question, answer): each assistant turn that follows a user turn which no other answered before; n from 0."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = in_order(turns.filter(F.col("role").isin("user", "assistant")))
    kind = rows.schema["conv_id"].dataType
    shape = f"first {kind.simpleString()}, conv_id {kind.simpleString()}, kind int, pos long, n long, opening boolean, head boolean, asked long, answered boolean, question string, answer string"
    walked = stored(rows.mapInArrow(_walk_pairs(to_arrow_type(kind)), shape), "pairs")
    lent, conv, open_, done = [], object(), None, 0
    for r in walked.filter("kind = 1").drop("question", "answer").orderBy("pos").collect():
        goes_on = r["first"] == conv
        taken = bool(goes_on and r["head"] and open_ is not None)
        if goes_on:
            lent.append((r.pos >> _SHIFT, done, open_ if taken else None))
        whole = goes_on and r.opening
        n = r["n"] + (done + taken if whole else 0)
        if r.asked is not None:
            open_ = None if r.answered else r.asked
        elif not whole or taken:
            open_ = None
        conv, done = r.conv_id, n
    known = rows.sparkSession.createDataFrame(lent, "p long, before long, from_pos long")
    found = walked.filter("kind = 0").withColumn("p", F.shiftright("pos", _SHIFT)).join(F.broadcast(known), "p", "left")
    found = found.filter("not head or from_pos is not null")
    # at most one row of a partition asks for the open question of another
    asked = walked.filter("kind = 1 and not answered and asked is not null").select(F.col("asked").alias("from_pos"), F.col("question").alias("carried"))
    heads = found.filter("head").join(asked, "from_pos").select("conv_id", F.col("before").alias("n"), F.col("carried").alias("question"), "answer")
    n = F.col("n") + F.when(F.col("opening"), F.coalesce("before", F.lit(0)) + F.col("from_pos").isNotNull().cast("long")).otherwise(0)
    return found.filter("not head").select("conv_id", n.alias("n"), "question", "answer").unionByName(heads)
