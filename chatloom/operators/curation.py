"""Curation of dialogues: cleaning of messages, gates with reasons, and removal of polluted lines. Turns come as (conv_id, turn,
role, text). Texts of a dialogue are never gathered: decisions rest on sums, flags and digests of its turns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions import text as tx
from chatloom.operators import dialogue as dl
from chatloom.operators import quality as ql


def clean_messages(turns: DataFrame, noise: Sequence[str], masks: Sequence[tuple[str, str]], most: int = 1200, longest_line: int = 2500) -> DataFrame:
    """(conv_id, turn, role, text, noise, repeats, truncated, repetitive) of user and assistant turns with text.

    Carriage returns end lines; each line is normalised, and empty, long or noisy ones go; masks apply; a line equal to the
    one before it goes; texts are cut at `most` characters. repetitive marks assistant turns that repeat themselves, which the
    caller drops.
    """
    role = F.lower(F.trim("role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), F.split(F.regexp_replace(F.coalesce("text", F.lit("")), "\\r", "\n"), "\n").alias("raw")).filter(F.col("role").isin("user", "assistant"))
    pattern = "(?i)" + "|".join(f"(?:{p})" for p in noise)
    rows = rows.withColumn("lines", F.transform("raw", tx.normalize))
    rows = rows.withColumn("kept", F.filter("lines", lambda x: (x != "") & (F.length(x) <= longest_line) & ~x.rlike(pattern)))
    rows = rows.withColumn("masked", F.split(tx.replace_all(F.array_join("kept", "\n"), masks), "\n")).withColumn("fresh", tx.unrepeated(F.col("masked")))
    rows = rows.withColumn("whole", F.array_join("fresh", "\n")).filter(tx.strip(F.col("whole")) != "")
    rows = rows.select("conv_id", "turn", "role", tx.strip(F.substring("whole", 1, most)).alias("text"), (F.size("lines") - F.size("kept")).alias("noise"), (F.size("masked") - F.size("fresh")).alias("repeats"), (F.length("whole") > most).cast("int").alias("truncated"))
    return rows.withColumn("repetitive", (F.col("role") == "assistant") & ql.heavy(F.col("text")))


def cleaned_turns(turns: DataFrame, noise: Sequence[str], masks: Sequence[tuple[str, str]], most: int = 1200) -> DataFrame:
    """(conv_id, turn, role, text, merged): clean_messages without repetitive turns, adjacent turns of one role joined."""
    rows = clean_messages(turns, noise, masks, most).filter(~F.col("repetitive"))
    return dl.merge_same_role(rows.select("conv_id", "turn", "role", "text"))


@dataclass
class Gates:
    """Rule packs of the gates, in the order in which they are asked."""

    low: Sequence[str] = ()
    leak: Sequence[str] = ()
    ticket_hard: str = "(?!)"
    ticket_soft: Sequence[str] = ()
    ticket_flow: str = "(?!)"
    marketing: Sequence[str] = ()
    risk: dict[str, Sequence[str]] = field(default_factory=dict)
    least: int = 12
    most: int = 6000
    shortest: int = 4


def _any(patterns: Sequence[str]) -> str:
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns) if patterns else "(?!)"


def reject_reason(cleaned: DataFrame, gates: Gates) -> DataFrame:
    """(conv_id, reason, risks): the first gate that a dialogue of cleaned turns fails, or null, and its risk labels.

    Gates in order: those of drop_reason; structured leaks, ticket templates and thrice repeated sentences in replies; marketing
    and risks in any turn; a dialogue that another one of a smaller id has said.
    """
    reply = F.col("role") == "assistant"
    said = lambda p: F.coalesce(F.bool_or(reply & F.col("text").rlike(p)), F.lit(False))
    soft = [f"s{i}" for i in range(len(gates.ticket_soft))]
    labels = list(gates.risk)
    flags = cleaned.groupBy("conv_id").agg(
        said(_any(gates.leak)).alias("leak"), said(gates.ticket_hard).alias("hard"), said(gates.ticket_flow).alias("flow"),
        *(said("(?i)" + p).cast("int").alias(s) for s, p in zip(soft, gates.ticket_soft, strict=True)),
        F.bool_or(F.col("text").rlike(_any(gates.marketing))).alias("marketing"),
        *(F.bool_or(F.col("text").rlike(_any(gates.risk[k]))).alias(f"r{i}") for i, k in enumerate(labels)),
    )
    n = sum((F.col(s) for s in soft), F.lit(0))
    risks = F.array_sort(F.filter(F.array(F.lit(None).cast("string"), *(F.when(F.col(f"r{i}"), k) for i, k in enumerate(labels))), lambda x: x.isNotNull()))
    flags = flags.select("conv_id", "leak", (F.col("hard") | (n >= 2) | ((n >= 1) & F.col("flow"))).alias("ticket"), "marketing", risks.alias("risks"))
    sentences = ql.repeated_sentences(cleaned.filter(reply), "conv_id", F.col("text")).select(F.col("id").alias("conv_id")).distinct().withColumn("repeats", F.lit(True))
    shape = dl.drop_reason(cleaned, list(gates.low), gates.least, gates.most, gates.shortest).withColumnRenamed("reason", "shape")
    rows = shape.join(flags, "conv_id").join(sentences, "conv_id", "left").join(dl.dialogue_hash(cleaned), "conv_id")
    reason = F.coalesce("shape", F.when(F.col("leak"), "structured_leak").when(F.col("ticket"), "ticket_template").when(F.coalesce("repeats", F.lit(False)), "sentence_repetition").when(F.col("marketing"), "marketing").when(F.size("risks") > 0, "risk"))
    rows = rows.withColumn("reason", reason)
    first = F.min(F.when(F.col("reason").isNull(), F.col("conv_id"))).over(Window.partitionBy("hash"))
    return rows.select("conv_id", F.when(F.col("reason").isNull() & (F.col("conv_id") > first), "duplicate").otherwise(F.col("reason")).alias("reason"), "risks")


def _cleaned_reply(text: Column, drop: str, filler: str) -> Column:
    """struct(lines, dropped, repeats, collapsed) of a reply without polluted and repeated lines; of filler alone one line stays."""
    found = tx.lines(text)
    kept = F.filter(found, lambda x: ~x.rlike(drop))
    formed = F.filter(kept, lambda x: tx.line_form(x) != "")
    fresh = tx.first_of_each(kept, tx.line_form)

    def collapsed(p: Column) -> Column:
        only = (F.size(p["f"]) >= 2) & F.forall(p["f"], lambda x: x.rlike(filler))
        return F.struct(F.when(only, F.slice(p["f"], 1, 1)).otherwise(p["f"]).alias("lines"), p["d"].alias("dropped"), p["r"].alias("repeats"), only.alias("collapsed"))

    return tx.let(F.struct(fresh.alias("f"), (F.size(found) - F.size(kept)).alias("d"), (F.size(formed) - F.size(fresh)).alias("r")), collapsed)


def decontaminate(turns: DataFrame, severe: dict[str, str], drop: Sequence[str], filler: Sequence[str], least: int = 12) -> tuple[DataFrame, DataFrame]:
    """((conv_id, action, reasons), (conv_id, turn, role, text)): what is done with each dialogue, and the turns that stay.

    A dialogue whose replies hold a severe pattern (name: pattern) is dropped. Else polluted and repeated lines of replies go, and
    replies without any left; one with nothing left, or under `least` characters beside a user turn, is dropped; others are
    kept as they are or modified. reasons are sorted.
    """
    reply = F.col("role") == "assistant"
    rows = turns.withColumn("c", F.when(reply, _cleaned_reply(F.coalesce("text", F.lit("")), _any(drop), _any([f"^(?:{p})$" for p in filler]))))
    rows = rows.withColumn("clean", F.when(reply, F.array_join("c.lines", "\n")).otherwise(F.col("text")))
    stays = F.length("clean") > 0
    a = rows.groupBy("conv_id").agg(
        *(F.coalesce(F.bool_or(reply & F.col("text").rlike("(?i)" + p)), F.lit(False)).alias(f"s{i}") for i, p in enumerate(severe.values())),
        F.coalesce(F.sum("c.dropped"), F.lit(0)).alias("dropped"), F.coalesce(F.sum("c.repeats"), F.lit(0)).alias("repeats"), F.coalesce(F.bool_or("c.collapsed"), F.lit(False)).alias("collapsed"),
        F.sum(F.when(reply & stays, F.length("clean")).otherwise(0)).alias("chars"), F.count_if(reply & stays).alias("left"), F.count_if(F.col("role") == "user").alias("users"),
    )
    bad = F.filter(F.array(*(F.when(F.col(f"s{i}"), f"severe:{k}") for i, k in enumerate(severe))), lambda x: x.isNotNull())
    size = F.col("chars") + F.greatest(F.col("left") - 1, F.lit(0))
    soft = F.array(F.when(F.col("dropped") > 0, "drop_line"), F.when(F.col("repeats") > 0, F.concat(F.lit("dedupe_lines:"), F.col("repeats").cast("string"))), F.when(F.col("collapsed"), "collapse_filler_only"), F.when(F.col("chars") == 0, "empty_after_clean").when((size < least) & (F.col("users") > 0), "too_short_after_clean"))
    a = a.withColumn("bad", bad).withColumn("soft", F.array_sort(F.filter(soft, lambda x: x.isNotNull())))
    gone = (F.size("bad") > 0) | F.exists("soft", lambda x: x.isin("empty_after_clean", "too_short_after_clean"))
    done = a.select("conv_id", F.when(gone, "drop").when(F.size("soft") > 0, "modify").otherwise("keep").alias("action"), F.when(F.size("bad") > 0, F.array_sort("bad")).otherwise(F.col("soft")).alias("reasons"))
    left = rows.filter(~reply | stays).join(done.filter("action <> 'drop'").select("conv_id"), "conv_id", "left_semi")
    return done, left.select("conv_id", "turn", "role", F.col("clean").alias("text"))
