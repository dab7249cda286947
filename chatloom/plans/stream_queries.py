"""Streaming queries, run over the files there are, with SQL twins in batch form."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from chatloom.operators.storage import stored
from chatloom.sources.io import page_units
from chatloom.streaming import streams

from .common import chain_sql, sql_normalize, table
from .retrieval_queries import _PAGES

QUERIES, SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: Files that a table is fed to a stream in, one a batch.
_FILES = 6


def _fed(spark, rows):
    """rows, which have `ts`, as a stream of files that come one a batch, each row up to ten minutes after those of its time."""
    rows = rows.withColumn("_arrival", F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64(*rows.columns), F.lit(600)) * 999_000)
    cuts = rows.agg(F.percentile_approx("_arrival", [i / _FILES for i in range(1, _FILES)], 1000)).first()[0] or []
    kept = stored(rows.withColumn("_file", sum((F.when(F.col("_arrival") > c, 1).otherwise(0) for c in cuts), F.lit(0))), "arrivals")
    folder = f"{_folder(spark)}/feed-{uuid.uuid4().hex}"
    for i in range(_FILES):
        # a file after another, as a stream takes them by age
        kept.filter(F.col("_file") == i).drop("_arrival", "_file").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.drop("_arrival").schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _events(spark, d):
    """The events table as a stream."""
    return _fed(spark, table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))


#: Slots that are kept and read together: half a day of a group.
_SLOTS = 72


def _groups(rows) -> int:
    """Groups that keys are dealt to, so that a group's points stay as many however large the table is."""
    return max(streams.GROUPS, rows.count() // 20_000)


def _folder(spark):
    return spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-")


def _drained(spark, stream, groups: int | None = None):
    """What a stream gives; keys that were dealt to groups share partitions, eight groups each, two of them for a core at least."""
    run = f"{_folder(spark)}/stream-{uuid.uuid4().hex}"
    return streams.drained(stream, f"{run}/out", f"{run}/state", groups and max(2 * spark.sparkContext.defaultParallelism, groups // 8))


@query("""select epoch(date_trunc('hour', ts))::bigint as start, event_type, count(*) as n, round(sum(value), 6) as value from events
where date_trunc('hour', ts) + interval 1 hour <= (select max(ts) from events) - interval 10 minutes group by all""")
def STR1_audit_counts(spark, d):
    out = _drained(spark, streams.audit_counts(_events(spark, d)))
    return out.select(F.unix_timestamp("start").alias("start"), "event_type", "n", F.round("value", 6).alias("value"))


@query("""with s as (select unnest(range(0, 6)) as k), w as (select (floor(epoch(ts) / 3600)::bigint - k) * 3600 as start, user_id from events, s),
m as (select epoch(max(ts)) as top from events)
select start, user_id, count(*) as n, count(*) > 2 as over from w, m where start + 21600 <= top - 600 group by start, user_id""")
def STR2_sliding_rate(spark, d):
    out = _drained(spark, streams.sliding_rate(_events(spark, d), "user_id", 2, "6 hours", "1 hour"))
    return out.select(F.unix_timestamp("start").alias("start"), "user_id", "n", "over")


#: A slot of ten minutes comes out once the watermark, ten minutes behind the newest row, has passed its end.
_OUT = "floor(tm / 600) * 600 + 600 <= (select max(tm) from e) - 600"
_ISLANDS = """e as (select user_id as key, event_id as id, epoch(ts) as tm, event_type = 'error' as bad from events),
g as (select *, count(*) filter (where not bad) over (partition by key order by tm, id) as g from e), b as (select key, id, tm, min(tm) over (partition by key, g) as since from g where bad),
h as (select key, id, tm, since from b where tm - since >= 3600)"""


@query(f"with {_ISLANDS} select key, tm as \"at\", since from h where {_OUT}")
def STR3_breach_since(spark, d):
    groups = _groups(table(spark, d, "events"))
    return _drained(spark, streams.breach_alerts(_events(spark, d), "user_id", "event_id", F.col("event_type") == "error", 3600.0, groups=groups, slots=_SLOTS), groups)


@query(f"with recursive {_ISLANDS}, {chain_sql('h', 5 * 86400.0)} select h.key, h.tm as \"at\", h.since from h join c on h.key = c.key and h.id = c.x.id where {_OUT}")
def STR4_cooled_alerts(spark, d):
    groups = _groups(table(spark, d, "events"))
    return _drained(spark, streams.breach_alerts(_events(spark, d), "user_id", "event_id", F.col("event_type") == "error", 3600.0, 5 * 86400.0, groups=groups, slots=_SLOTS), groups)


@query(f"with recursive e as (select user_id as key, event_id as id, epoch(ts) as tm from events), {chain_sql('e', 6 * 3600.0)} select e.id as event_id, e.key as user_id, c.key is not null as accepted from e left join c on c.key = e.key and c.x.id = e.id where {_OUT}")
def STR2_admission(spark, d):
    """One event of a user in any six hours, decided as the stream goes."""
    groups = _groups(table(spark, d, "events"))
    out = _drained(spark, streams.admitted(_events(spark, d), "user_id", "event_id", 6 * 3600.0, 1, groups=groups, slots=_SLOTS), groups)
    return out.select(F.col("id").alias("event_id"), F.col("key").alias("user_id"), "accepted")


@query(f"with recursive e as (select md5(concat(user_id, ':', event_type)) as key, event_id as id, epoch(ts) as tm from events), {chain_sql('e', 7 * 86400.0)} select count(*) as kept, count(distinct key) as keys from (select key, x.tm as tm from c) where {_OUT}")
def STR5_first_seen(spark, d):
    """Kinds of events of a user that were not seen in the seven days before."""
    keyed = _events(spark, d).withColumn("key", F.md5(F.concat_ws(":", F.col("user_id").cast("string"), "event_type")))
    groups = _groups(table(spark, d, "events"))
    return _drained(spark, streams.first_seen(keyed, "key", "event_id", 7 * 86400.0, groups=groups, slots=_SLOTS).select("key"), groups).agg(F.count("*").alias("kept"), F.count_distinct("key").alias("keys"))


@query(f"""with recursive e as (select md5(role || ':' || lower({sql_normalize('text')})) as key, conv_id * 1000 + turn as id, role, length({sql_normalize('text')}) as size, 86400.0::double + conv_id * 60 + turn as tm from conversations where role in ('user', 'assistant') and {sql_normalize('text')} <> ''),
{chain_sql('e', 7200.0)} select e.key, e.role, e.size from e join c on c.key = e.key and c.x.id = e.id where floor(e.tm / 600) * 600 + 600 <= (select max(tm) from e) - 600""")
def STR5_cleaned_turns(spark, d):
    """Turns as a stream, cleaned, each text of a role once in two hours; a turn's time is made of its place."""
    turns = table(spark, d, "conversations").select(F.timestamp_seconds(F.lit(86400) + F.col("conv_id") * 60 + F.col("turn")).alias("ts"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role", "text")
    groups = _groups(turns)
    return _drained(spark, streams.cleaned(_fed(spark, turns), 7200.0, groups=groups, slots=_SLOTS).select("key", "role", F.length("text").alias("size")), groups)


@query(f"with {_PAGES} select pc.id || '-' || (row_number() over (partition by pc.id order by p.char_start) - 1) as unit_id, pg.url as source_url, title, p.chunk as text from pc join pg on page_id = pc.id")
def SRC5_page_units(spark, d):
    return page_units(table(spark, d, "pages"))
