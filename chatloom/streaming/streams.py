"""Structured Streaming over request logs and dialogues. Event times come as `ts`."""

from __future__ import annotations

import pickle

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from chatloom.functions.text import normalize
from chatloom.operators.storage import reachable


def audit_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by tumbling window and event type; a window comes out when the watermark has passed it."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return counted.select(F.col("window.start").alias("start"), "event_type", "n", "value")


def sliding_rate(events: DataFrame, key: str, limit: int, size: str = "60 seconds", step: str = "10 seconds", late: str = "10 minutes") -> DataFrame:
    """Events of a key by sliding window, and whether they exceed the limit."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", size, step), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), key, "n", (F.col("n") > limit).alias("over"))


class _InOrder(StatefulProcessor):
    """Points of many keys, those of a group, in order of event time, whatever order they arrive in, each once the watermark has
    passed its slot of event time.

    Points wait in chunks of some slots, a map from a chunk to its points; a timer at the end of the first slot that waits takes
    out what is due, sorted, and gives each key's points to `decide` with what is remembered of the key. A chunk is all that
    is read at once. What is remembered of a key is dropped when event time passes `expires`.
    """

    def __init__(self, decide, expires, columns: list[str], slot: float, slots: int) -> None:
        self.decide, self.expires, self.columns, self.slot, self.slots = decide, expires, columns, round(slot * 1000), slots

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "chunk long", "first long, points binary")
        self.memo = handle.getValueState("memo", "x binary")

    def _wait(self, chunk: int, points: list) -> int:
        """Keep points (at, id, key, flag, payload) of a chunk; the first slot that waits in it."""
        first = int(min(p[0] for p in points) * 1000 // self.slot)
        self.waiting.updateValue((chunk,), (first, pickle.dumps(points)))
        return first

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for pdf in rows:
            chunks = (pdf["at"] * 1000 // (self.slot * self.slots)).astype("int64")
            for chunk, part in pdf.groupby(chunks):
                at = (int(chunk),)
                points = pickle.loads(self.waiting.getValue(at)[1]) if self.waiting.containsKey(at) else []
                points += list(zip(*(part[c].tolist() for c in ("at", "id", "key", "flag", "payload")), strict=True))
                slot = self._wait(at[0], points)
                first = slot if first is None else min(first, slot)
        if first is not None:
            self.handle.registerTimer((first + 1) * self.slot)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd

        # timers that the watermark passed at once come in no order, so the first takes all slots that are due
        end = timerValues.getCurrentWatermarkInMs() // self.slot
        memos = pickle.loads(self.memo.get()[0]) if self.memo.exists() else {}
        first, changed = None, False
        for chunk in sorted(c for (c,) in self.waiting.keys()):
            if chunk * self.slots >= end:
                first = min((s for s in (first, self.waiting.getValue((chunk,))[0]) if s is not None))
                break
            points = pickle.loads(self.waiting.getValue((chunk,))[1])
            due = sorted((p for p in points if p[0] * 1000 // self.slot < end), key=lambda p: p[:2])
            left = [p for p in points if p[0] * 1000 // self.slot >= end]
            if left:
                slot = self._wait(chunk, left) if due else self.waiting.getValue((chunk,))[0]
                first = slot if first is None else min(first, slot)
            else:
                self.waiting.removeKey((chunk,))
            by_key: dict = {}
            for at, i, k, flag, payload in due:
                by_key.setdefault(k, []).append((at, i, flag, payload))
            rows = []
            for k, mine in by_key.items():
                out, memo = self.decide(mine, memos.get(k, []))
                rows += [(k, *r) for r in out]
                memos[k] = memo
                changed = True
            if rows:
                yield pd.DataFrame(rows, columns=self.columns)
        # points of slots that aren't due may be older than the watermark, so what they can still ask for stays
        until = {k: self.expires(m) if m else 0.0 for k, m in memos.items()}
        kept = {k: m for k, m in memos.items() if until[k] is None or until[k] * 1000 > end * self.slot}
        if not kept:
            self.memo.clear()
        elif changed or len(kept) < len(memos):
            self.memo.update((pickle.dumps(kept),))
        later = [int(until[k] * 1000) // self.slot for k in kept if until[k] is not None]
        # one timer for what waits, and one by which all that is remembered now has gone
        for slot in {s for s in (first, max(later, default=None)) if s is not None}:
            self.handle.registerTimer((max(slot, end) + 1) * self.slot)

    def close(self) -> None:
        pass


#: Groups that keys are dealt to; slots in a chunk.
GROUPS, SLOTS = 64, 2


def _in_order(rows: DataFrame, late: str, slot: float, decide, expires, shape: str, groups: int, slots: int) -> DataFrame:
    """rows (ts, key, id, flag, payload) through _InOrder; shape begins with the key. Keys are dealt to groups by a hash."""
    reachable(rows.sparkSession)
    columns = [c.split()[0] for c in shape.split(", ")]
    # the only store that has timers and maps; a query keeps the one it was started with
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    group = F.pmod(F.xxhash64("key"), F.lit(max(1, groups))).cast("int").alias("group")
    # as text, so that null keys stay null and long ones whole in a task's tables
    kind, text = rows.schema["key"].dataType, F.col("key").cast("string").alias("key")
    keyed = rows.withWatermark("ts", late).select(group, "ts", text, "id", "flag", "payload", F.col("ts").cast("timestamp").cast("double").alias("at"))
    shape = "key string, " + shape.split(", ", 1)[1]
    out = keyed.groupBy("group").transformWithStateInPandas(_InOrder(decide, expires, columns, slot, slots), shape, "Append", "EventTime")
    return out.withColumn("key", F.col("key").cast(kind))


def admitted(events: DataFrame, key: str, id_col: str, seconds: float, limit: int, payload: Column | None = None, late: str = "10 minutes", slot: float = 600.0, groups: int = GROUPS, slots: int = SLOTS) -> DataFrame:
    """(key, id, at, accepted, payload) of every event, once the watermark has passed its slot: in order of time, ties by id, an event
    is accepted if fewer than `limit` of its key were in the `seconds` before it; rejected ones don't count.

    The state of a group of keys is their waiting points, by chunks of slots, and at most `limit` times a key, which go when they no
    longer count; so `groups` should grow with the keys. Rows later than `late` are dropped, as the watermark has it.
    """

    def decide(points, taken):
        out = []
        for at, i, _, more in points:
            taken = [t for t in taken if t > at - seconds]
            out.append((i, at, len(taken) < limit, more))
            if out[-1][2]:
                taken = [*taken, at]
        return out, taken

    kinds = dict(events.dtypes)
    rows = events.select("ts", F.col(key).alias("key"), F.col(id_col).alias("id"), F.lit(False).alias("flag"), (F.lit(None) if payload is None else payload).cast("string").alias("payload"))
    return _in_order(rows, late, slot, decide, lambda taken: max(taken) + seconds, f"key {kinds[key]}, id {kinds[id_col]}, at double, accepted boolean, payload string", groups, slots)


def first_seen(rows: DataFrame, key: str, id_col: str, horizon: float, payload: Column | None = None, late: str = "10 minutes", slot: float = 600.0, groups: int = GROUPS, slots: int = SLOTS) -> DataFrame:
    """(key, id, at, payload) of rows whose key was not kept within `horizon` seconds of event time before them; exact for rows that
    are not late, and what is remembered of a key goes when the horizon has passed."""
    return admitted(rows, key, id_col, horizon, 1, payload, late, slot, groups, slots).filter("accepted").drop("accepted")


def cleaned(turns: DataFrame, horizon: float, late: str = "10 minutes", slot: float = 600.0, groups: int = GROUPS, slots: int = SLOTS) -> DataFrame:
    """Turns (ts, id, role, text) of users and assistants, normalised, empty ones left out, each role and text once within the
    horizon: (key, id, at, role, text)."""
    rows = turns.filter(F.col("role").isin("user", "assistant")).withColumn("text", normalize(F.coalesce("text", F.lit("")))).filter("text <> ''")
    keyed = rows.withColumn("key", F.md5(F.concat_ws(":", "role", F.lower("text"))))
    kept = first_seen(keyed, "key", "id", horizon, F.to_json(F.struct("role", "text")), late, slot, groups, slots)
    return kept.select("key", "id", "at", F.get_json_object("payload", "$.role").alias("role"), F.get_json_object("payload", "$.text").alias("text"))


def breach_alerts(points: DataFrame, key: str, id_col: str, breach: Column, hold: float, cooldown: float = 0.0, late: str = "10 minutes", slot: float = 600.0, groups: int = GROUPS, slots: int = SLOTS) -> DataFrame:
    """(key, at, since): points at which a key has been in breach for `hold` seconds, at least `cooldown` after its last alert.

    The state of a group of keys is their waiting points, by chunks of slots, and when a key's breach began and when it last alerted; a
    healthy point clears the former, and without a breach the latter goes when the cooldown is over.
    """

    def decide(waiting, memo):
        since, last = memo or (-1.0, -1.0)
        out = []
        for at, _, bad, _ in waiting:
            since = (at if since < 0 else since) if bad else -1.0
            if bad and at - since >= hold and (last < 0 or at - last >= cooldown):
                out.append((at, since))
                last = at
        return out, [since, last] if since >= 0 or last >= 0 else []

    rows = points.select("ts", F.col(key).alias("key"), F.col(id_col).alias("id"), breach.alias("flag"), F.lit(None).cast("string").alias("payload"))
    return _in_order(rows, late, slot, decide, lambda memo: None if memo[0] >= 0 else memo[1] + cooldown, f"key {dict(points.dtypes)[key]}, at double, since double", groups, slots)


def drained(stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None) -> DataFrame:
    """Run a stream over what there is, into Parquet files, and read them. partitions: those of its state, at most; every batch opens
    and keeps the store of each, which costs more than the rows where they are many."""
    conf = stream.sparkSession.conf
    was = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(min(int(was), max(1, partitions or int(was)))))
    try:
        # a query keeps the number that it was started with
        running = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        conf.set("spark.sql.shuffle.partitions", was)
    running.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
