"""Dialogues: turns to message arrays and back, merging, pairing and export views. Turns come as (conv_id, turn, role, text)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runs import asked_and_answered, in_order, role_runs


def assemble(turns: DataFrame, roles: Sequence[str] | None = None, part: int = 1000) -> DataFrame:
    """(conv_id, part, messages): turns of the given roles in order of turn, in parts of `part` turn numbers, so that no dialogue,
    however long, has to fit one row."""
    rows = turns.filter(F.col("role").isin(*roles)) if roles else turns
    rows = rows.withColumn("part", F.floor(F.col("turn") / part))
    return rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m")).select("conv_id", "part", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def explode_turns(dialogues: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) from messages; turns are numbered from 0."""
    rows = dialogues.select("conv_id", "part", F.size("messages").alias("n"), F.posexplode("messages").alias("at", "m"))
    sizes = dialogues.select("conv_id", "part", F.size("messages").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.join(sizes.select("conv_id", "part", before.alias("before")), ["conv_id", "part"])
    return placed.select("conv_id", (F.col("before") + F.col("at")).alias("turn"), "m.role", F.col("m.content").alias("text"))


def merge_same_role(turns: DataFrame, part: int = 1000) -> DataFrame:
    """Adjacent turns of one role joined by line ends: (conv_id, turn, role, text, merged). A run of over `part` turns comes back as
    several rows, in order of turn, so that no run has to fit one; see `runs`."""
    rows = role_runs(in_order(turns))
    k = F.floor(F.col("at") / part)
    joined = rows.groupBy("run", k.alias("k")).agg(F.first("conv_id").alias("conv_id"), F.min("turn").alias("turn"), F.first("role").alias("role"), F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("m"))
    merged = F.size("m") - F.when(F.col("k") == 0, 1).otherwise(0)
    return joined.select("conv_id", "turn", "role", F.array_join(F.transform("m", lambda x: x["text"]), "\n").alias("text"), merged.alias("merged"))


def qa_pairs(turns: DataFrame) -> DataFrame:
    """Each assistant turn with the user turn before it that no other took: (pair_id, conv_id, question, answer)."""
    found = asked_and_answered(turns)
    return found.select(F.concat_ws("_single_", "conv_id", "n").alias("pair_id"), "conv_id", "question", "answer")


def first_pair(turns: DataFrame) -> DataFrame:
    """(conv_id, question, answer): the first non-empty user turn and the next non-empty assistant turn."""
    said = turns.filter(F.length(F.trim("text")) > 0)
    user = said.filter("role = 'user'").groupBy("conv_id").agg(F.min("turn").alias("asked"), F.min_by("text", "turn").alias("question"))
    after = said.filter("role = 'assistant'").join(user, "conv_id").filter("turn > asked")
    return after.groupBy("conv_id").agg(F.first("question").alias("question"), F.min_by("text", "turn").alias("answer"))


def shape(turns: DataFrame) -> DataFrame:
    """(conv_id, users, assistants, single): counts by role and whether there is exactly one of each."""
    out = turns.groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("users"), F.count_if(F.col("role") == "assistant").alias("assistants"))
    return out.withColumn("single", (F.col("users") == 1) & (F.col("assistants") == 1))


def last_query(turns: DataFrame) -> DataFrame:
    """(conv_id, query): the last user turn with text."""
    return turns.filter((F.col("role") == "user") & (F.length(F.trim("text")) > 0)).groupBy("conv_id").agg(F.max_by("text", "turn").alias("query"))


def drop_reason(turns: DataFrame, low: Sequence[str], least: int = 12, most: int = 6000, shortest: int = 4) -> DataFrame:
    """(conv_id, reason): the first gate that a dialogue fails, or null.

    Gates in order: no user turn, no reply, too short or too long in all, users' texts of low value only, replies too short.
    """
    said = F.length(F.coalesce("text", F.lit("")))
    user, reply = F.col("role") == "user", F.col("role") == "assistant"
    a = turns.groupBy("conv_id").agg(
        F.count_if(user).alias("users"), F.count_if(reply).alias("replies"), F.sum(F.when(user | reply, said).otherwise(0)).alias("size"),
        F.count_if(user & ~F.lower(F.trim("text")).isin(*low)).alias("worthy"), F.max(F.when(reply, said)).alias("longest"),
    )
    reason = F.when(F.col("users") == 0, "no_user").when(F.col("replies") == 0, "no_reply").when(F.col("size") < least, "too_short").when(F.col("size") > most, "too_long")
    return a.select("conv_id", reason.when(F.col("worthy") == 0, "low_value").when(F.col("longest") < shortest, "reply_too_short").alias("reason"))


def turn_quality(turns: DataFrame, low: str, policy: str, least: int = 40, most: int = 1200) -> DataFrame:
    """(conv_id, verdict, truncated, policy, chars): the first of no_user, no_reply, short_reply (one of under `least` characters),
    low_value (all user texts match low) that holds, else ok; turns that are cut at `most` characters, whether a reply matches policy,
    and the characters left."""
    user, reply, size = F.col("role") == "user", F.col("role") == "assistant", F.length("text")
    a = turns.groupBy("conv_id").agg(
        F.count_if(user).alias("u"), F.count_if(reply).alias("r"), F.min(F.when(reply, size)).alias("least"), F.count_if(size > most).alias("truncated"), F.count_if(user & ~F.trim("text").rlike(low)).alias("worthy"),
        F.coalesce(F.bool_or(reply & F.col("text").rlike(policy)), F.lit(False)).alias("policy"), F.sum(F.least(size, F.lit(most))).alias("chars"),
    )
    verdict = F.when(F.col("u") == 0, "no_user").when(F.col("r") == 0, "no_reply").when(F.coalesce("least", F.lit(0)) < least, "short_reply").when(F.col("worthy") == 0, "low_value").otherwise("ok")
    return a.select("conv_id", verdict.alias("verdict"), "truncated", "policy", "chars")


def dialogue_hash(turns: DataFrame, numbers: bool = True, size: int = 20, segment: int = 1000) -> DataFrame:
    """(conv_id, hash): sha256 prefix over the turns in order, as role:text lower-cased, with white space collapsed and digits as
    <NUM>.

    Turns are told by their sha256, the digests of `segment` turn numbers are digested, and those of a dialogue once more, so
    that texts of a dialogue are never gathered.
    """
    text = F.trim(F.lower(F.coalesce("text", F.lit(""))))
    text = F.regexp_replace(text, "[0-9]+", "<NUM>") if numbers else text
    text = F.concat("role", F.lit(":"), F.regexp_replace(text, "[ \\t\\n\\r\\f]+", " "))

    def digested(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
        rows = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, "t"))).alias("m"))
        return rows.select(*keys, F.sha2(F.array_join(F.transform("m", lambda x: x["t"]), "\n"), 256).alias("t"))

    rows = turns.select("conv_id", "turn", F.floor(F.col("turn") / segment).alias("segment"), F.sha2(text, 256).alias("t"))
    whole = digested(digested(rows, ["conv_id", "segment"], "turn"), ["conv_id"], "segment")
    return whole.select("conv_id", F.substring("t", 1, size).alias("hash"))


def neighbours(rows: DataFrame, group: str, order: str, text: str, wanted: Column) -> DataFrame:
    """Wanted rows with the nearest non-empty texts before and after them: (group, order, before, after, context)."""
    past = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    next_ = Window.partitionBy(group).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    said = F.when(F.length(F.trim(text)) > 0, F.col(text))
    out = rows.withColumn("before", F.last(said, ignorenulls=True).over(past)).withColumn("after", F.first(said, ignorenulls=True).over(next_))
    return out.filter(wanted).select(group, order, "before", "after", F.concat_ws("\n", "before", "after").alias("context"))
