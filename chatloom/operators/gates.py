"""Greedy gates over time, where each decision rests on those before it, with one key spread over many tasks.

Events stand in order of key and time and are cut into slices. With a limit of one, the event that is let through next after
another is a pointer; pointers are doubled until one step crosses a slice, so a slice is a step function from the last action
before it to the last one in it. One pass over these functions tells every slice what comes before it. With larger limits
a slice is run from an empty state; what the one before it hands on is then run through again, only until the states are alike.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import reachable, stored

#: Events in a slice.
SLICE = 4096


def pointers(at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """By event of a slice: the first one at least span later (the number of events if there is none), and the last of the chain
    that these make."""
    n = len(at)
    after = np.searchsorted(at, at + span, side="left")
    last = np.where(after < n, after, np.arange(n))
    while (further := last[last]).tolist() != last.tolist():
        last = further
    return after, last


def allowed(at: np.ndarray, span: int, enter: int | None) -> np.ndarray:
    """Which events of a slice are let through one at a time, the last before it having been at enter."""
    after, _ = pointers(at, span)
    out = np.zeros(len(at), bool)
    i = 0 if enter is None else int(np.searchsorted(at, enter + span, side="left"))
    while i < len(at):
        out[i] = True
        i = int(after[i])
    return out


def limited(at: list[int], span: int, limit: int, enter: list[int], known: tuple[list[bool], list[int]] | None = None, first: list[int] = ()) -> tuple[list[bool], list[int]]:
    """Which events are let through, at most limit in any span, and the times of those that still count at the end.

    known is the answer for another state `first` to enter with: once both states are alike, the rest of it holds.
    """
    taken, other, out = deque(enter), deque(first), []
    for i, t in enumerate(at):
        while taken and taken[0] <= t - span:
            taken.popleft()
        if known is not None:
            while other and other[0] <= t - span:
                other.popleft()
            if taken == other:
                return out + known[0][i:], known[1]
            if known[0][i]:
                other.append(t)
        out.append(len(taken) < limit)
        if out[-1]:
            taken.append(t)
    return out, list(taken)


def _slices(size: int, span: int, kind: pa.DataType, id_kind: pa.DataType):
    schema = pa.schema([("key", kind), ("seg", pa.int64()), ("ids", pa.list_(id_kind)), ("at", pa.list_(pa.int64())), ("until", pa.list_(pa.int64())), ("exit", pa.list_(pa.int64())), ("end", pa.int64())])

    def made(key, seg: int, ids: list, at: list[int]) -> tuple:
        x = np.array(at, np.int64)
        last = x[pointers(x, span)[1]]
        # only what is within a span of the slice's first event can be let through first in it
        m = int(np.searchsorted(x, x[0] + span, side="left")) + 1
        ends = np.flatnonzero(np.append(last[:m][1:] != last[:m][:-1], True))
        return key, seg, ids, at, x[:m][ends].tolist(), last[:m][ends].tolist(), at[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seg, ids, at, some = None, 0, [], [], False
        for batch in batches:
            out = []
            for pos, key, i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if some and (key != held or len(ids) == size):
                    out.append(made(held, seg, ids, at))
                    ids, at = [], []
                if not ids:
                    held, seg, some = key, pos, True
                ids.append(i)
                at.append(t)
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        if ids:
            yield pa.record_batch([pa.array([c], f.type) for c, f in zip(made(held, seg, ids, at), schema, strict=True)], schema=schema)

    return run


def _entered(span: int):
    """(seg, enter): the last action before each slice of a key, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, acted, some = None, None, False
        for batch in batches:
            segs, enters = [], []
            for key, seg, until, exits, start, end in zip(*(batch.column(n).to_pylist() for n in ("key", "seg", "until", "exit", "start", "end")), strict=True):
                if not some or key != held:
                    held, acted, some = key, None, True
                segs.append(seg)
                enters.append(acted)
                bar = start if acted is None else max(start, acted + span)
                if bar <= end:
                    acted = exits[int(np.searchsorted(until, bar, side="left"))]
            yield pa.record_batch([pa.array(segs, pa.int64()), pa.array(enters, pa.int64())], names=["seg", "enter"])

    return run


def gated(events: DataFrame, id_col: str, key: str, at: Column, seconds: float, limit: int = 1, size: int = SLICE) -> DataFrame:
    """(id_col, key, accepted) of every event: in order of time, ties by id, an event is accepted if fewer than `limit` of its key
    were in the `seconds` before it; rejected ones don't count. Times, in seconds, are taken to the microsecond.

    Events without a time are rejected. A null key is one key. An empty table stays empty.
    """
    reachable(events.sparkSession)
    span = round(seconds * 1_000_000)
    rows = events.select(F.col(key).alias("key"), F.col(id_col).alias("id"), F.round(at * 1_000_000).cast("long").alias("at"))
    order = [F.asc_nulls_first("key"), F.asc("at"), F.asc_nulls_first("id")]
    dealt = rows.filter("at is not null").repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = {n: rows.schema[n].dataType.simpleString() for n in ("key", "id")}
    from pyspark.sql.pandas.types import to_arrow_type

    made = _slices(size, span, *(to_arrow_type(rows.schema[n].dataType) for n in ("key", "id")))
    slices = stored(dealt.select(F.monotonically_increasing_id().alias("pos"), "key", "id", "at").mapInArrow(made, f"key {kinds['key']}, seg long, ids array<{kinds['id']}>, at array<bigint>, until array<bigint>, exit array<bigint>, end long"), "slices")
    back = pa.schema([("key", to_arrow_type(rows.schema["key"].dataType)), ("id", to_arrow_type(rows.schema["id"].dataType)), ("accepted", pa.bool_())])

    def spread(decide):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    n = len(r["ids"])
                    yield pa.record_batch([pa.array([r["key"]] * n, back.field(0).type), pa.array(r["ids"], back.field(1).type), pa.array(decide(r), pa.bool_())], schema=back)

        return run

    shape = f"key {kinds['key']}, id {kinds['id']}, accepted boolean"
    if limit == 1:
        light = slices.select("key", "seg", "until", "exit", F.get("at", F.lit(0)).alias("start"), "end")
        enters = light.repartition("key").sortWithinPartitions(F.asc_nulls_first("key"), "seg").mapInArrow(_entered(span), "seg long, enter long")
        out = slices.select("key", "seg", "ids", "at").join(enters, "seg").mapInArrow(spread(lambda r: allowed(np.array(r["at"], np.int64), span, r["enter"])), shape)
    else:
        out = _passes(slices, span, limit).mapInArrow(spread(lambda r: limited(r["at"], span, limit, r["enter"])[0]), shape)
    late = rows.filter("at is null").select("key", "id", F.lit(False).alias("accepted"))
    return out.unionByName(late).select(F.col("id").alias(id_col), F.col("key").alias(key), "accepted")


def _passes(slices: DataFrame, span: int, limit: int) -> DataFrame:
    """Slices (key, seg, ids, at) with the times that count when they are entered, each handed on until none changes."""
    schema = pa.schema([("seg", pa.int64()), ("enter", pa.list_(pa.int64())), ("leave", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                enter = r.get("given") or []
                known = None if r.get("enter") is None else limited(r["at"], span, limit, r["enter"])
                out.append((r["seg"], enter, limited(r["at"], span, limit, enter, known, r.get("enter") or [])[1]))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 3, schema, strict=True)], schema=schema)

    shape = "seg long, enter array<bigint>, leave array<bigint>"
    states = stored(slices.select("seg", "at").mapInArrow(run, shape), "states")
    before = F.lag("leave").over(Window.partitionBy("key").orderBy("seg"))
    while True:
        handed = slices.select("key", "seg", F.get("at", F.lit(0)).alias("start")).join(states, "seg").withColumn("given", F.coalesce(before, F.array().cast("array<bigint>")))
        # what no longer counts at the slice's first event is not handed on
        handed = handed.withColumn("given", F.filter("given", lambda t: t > F.col("start") - span))
        changed = stored(handed.filter("given <> enter").select("seg", "enter", "given"), "changed")
        if not changed.limit(1).count():
            return slices.select("key", "seg", "ids", "at").join(states.select("seg", "enter"), "seg")
        again = slices.select("seg", "at").join(changed, "seg").mapInArrow(run, shape)
        states = stored(states.join(changed.select("seg"), "seg", "left_anti").unionByName(again), "states")
