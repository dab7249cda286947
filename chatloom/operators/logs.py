"""Request-log analytics over event time, and the greedy gates that need one pass in order of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .gates import gated


def seconds_of(ts: Column) -> Column:
    """Seconds since 1970 of a timestamp as it reads, whatever the session's time zone."""
    day = F.date_diff(ts, F.lit("1970-01-01")).cast("double") * 86400
    return day + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")


def summary(events: DataFrame, start: str, end: str, ok: Column) -> DataFrame:
    """One row of counts over the half-open window [start, end)."""
    inside = (F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp"))
    return events.filter(inside).agg(F.count("*").alias("events"), F.count_if(ok).alias("ok"), F.count_distinct("user_id").alias("keys"), F.sum("value").alias("value"))


def window_counters(events: DataFrame, start: str, end: str, names: dict[str, Column], flags: dict[str, Column], totals: dict[str, Column]) -> DataFrame:
    """(kind, name, n) over the half-open window [start, end): how many events have each value of each named expression (null
    ones count as "unknown"), how many have each flag (kind flag), and sums (kind total). One reading of the events."""
    inside = (F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp"))
    one = lambda kind, name, n: F.struct(F.lit(kind).alias("kind"), name.alias("name"), n.cast("double").alias("n"))
    said = [one(k, F.coalesce(c.cast("string"), F.lit("unknown")), F.lit(1)) for k, c in names.items()]
    marked = [one("flag", F.lit(k), F.coalesce(c, F.lit(False)).cast("int")) for k, c in flags.items()]
    summed = [one("total", F.lit(k), F.coalesce(c, F.lit(0))) for k, c in totals.items()]
    rows = events.filter(inside).select(F.explode(F.array(*said, *marked, *summed)).alias("x"))
    return rows.groupBy("x.kind", "x.name").agg(F.sum("x.n").alias("n"))


def compare_windows(events: DataFrame, start: str, end: str, ok: Column) -> DataFrame:
    """Counts of a window and of the equally long one before it, with signed differences."""
    a, b = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    before = a - (b - a)
    now, past = (F.col("ts") >= a) & (F.col("ts") < b), (F.col("ts") >= before) & (F.col("ts") < a)
    out = events.filter((F.col("ts") >= before) & (F.col("ts") < b)).agg(F.count_if(now).alias("events"), F.count_if(past).alias("events_before"), F.count_if(now & ok).alias("ok"), F.count_if(past & ok).alias("ok_before"))
    return out.withColumn("events_delta", F.col("events") - F.col("events_before")).withColumn("ok_delta", F.col("ok") - F.col("ok_before"))


def top_counts(rows: DataFrame, group: list[str], key: str, k: int = 3) -> DataFrame:
    """The k commonest keys of each group: (group, key, n, rank); ties by key."""
    order = Window.partitionBy(*group).orderBy(F.desc("n"), key)
    return rows.groupBy(*group, key).agg(F.count("*").alias("n")).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def trailing_count(events: DataFrame, key: str, seconds: int) -> DataFrame:
    """Events with `recent`, how many of their key lie in the trailing window that ends with them."""
    at = seconds_of(F.col("ts"))
    return events.withColumn("recent", F.count("*").over(Window.partitionBy(key).orderBy(at).rangeBetween(-seconds, 0)))


def admitted(events: DataFrame, key: str, seconds: int, limit: int) -> DataFrame:
    """Events (event_id, key) with `accepted`: at most `limit` accepted ones of a key in any trailing window; rejected ones don't
    count. Decided in order of (ts, event_id), a key's slices side by side; see `gates`."""
    return gated(events, "event_id", key, seconds_of(F.col("ts")), seconds, limit)


def cooled(points: DataFrame, key: str, at: str, cooldown: float) -> DataFrame:
    """(key, at, action): action only if at least `cooldown` since the key's last action; in order of time."""
    rows = points.select(F.col(key).alias("key"), F.struct(F.col(at).alias("at"), F.rand(3).alias("n")).alias("id"))
    return gated(rows, "id", "key", F.col("id.at"), cooldown).select("key", F.col("id.at").alias("at"), F.col("accepted").alias("action"))


def sustained(points: DataFrame, at: str, breach: Column, seconds: int, least: int) -> DataFrame:
    """Points with `sustained`: at least `least` points in the trailing window, and every one a breach."""
    window = Window.partitionBy("key").orderBy(F.col(at)).rangeBetween(-seconds, 0)
    return points.withColumn("sustained", (F.count("*").over(window) >= least) & F.bool_and(breach).over(window))


def latest_steps(lines: DataFrame, key: str, at: str, line: str, metrics: dict[str, str]) -> DataFrame:
    """(key, step, one column for each metric, lines): of log lines in order of `at` the last step, told as a/b, the last number
    that each metric's pattern finds, and how many lines tell a step."""
    step = F.regexp_extract(line, "step ([0-9]+)/([0-9]+)", 1).try_cast("long")
    rows = lines.select(key, at, step.alias("step"), *(F.regexp_extract(line, p, 1).try_cast("double").alias(m) for m, p in metrics.items()))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(at))).alias(c)
    return rows.groupBy(key).agg(last("step"), *map(last, metrics), F.count("step").alias("lines"))
