"""Filters and quality gates over tables of texts. Texts may be null: they count as empty, unless a gate says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions import text as tx

from .storage import reachable


#: Hashes of n-grams that are sorted at once; a longer text takes several passes, each over the grams of some hashes.
HELD = 4_000_000


def _hashes(points: np.ndarray, n: int) -> np.ndarray:
    """64-bit rolling hashes of all runs of n code points, each point being mixed first."""
    x = points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    m = len(x) - n + 1
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x5851F42D4C957F2D) + x[i : i + m]
    return out ^ (out >> np.uint64(29))


def most_of_one(text: str, n: int, held: int = HELD) -> int | None:
    """How often the commonest run of n characters occurs in a text; null if it is shorter."""
    if len(text) < n:
        return None
    passes, most = -(-len(text) // held), 0
    for k in range(passes):
        parts = []
        for at in range(0, len(text) - n + 1, held):
            h = _hashes(np.frombuffer(text[at : at + held + n - 1].encode("utf-32-le", "surrogatepass"), "<u4"), n)
            parts.append(h[h % np.uint64(passes) == k] if passes > 1 else h)
        found = np.sort(np.concatenate(parts))
        ends = np.flatnonzero(np.append(found[1:] != found[:-1], True)) if len(found) else np.zeros(0, int)
        most = max(most, int(np.diff(ends, prepend=-1).max(initial=0)))
    return most


def commonest(squeezed: Column, n: int) -> Column:
    """How often the commonest of a text's character n-grams, told by 64-bit hashes, occurs; null for texts shorter than n. Grams of
    a text are hashed and sorted in arrays of bounded size; texts pass to Python in batches."""

    reachable()

    @F.pandas_udf("long")
    def most(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else most_of_one(t, n) for t in texts], dtype="Int64")

    return most(squeezed)


def heavy(text: Column, n: int = 12, least: int = 80, times: int = 6, share: float = 0.35) -> Column:
    """Whether the commonest n-gram of a text without white space occurs `times` or more and covers the share of it; texts under
    `least` characters don't count. An expression, for texts that were cut to some length; longer ones are `heavy_repetition`'s."""

    def test(s: Column) -> Column:
        # a look-ahead matches at every place, so that one pass over the text finds all grams
        grams = F.regexp_extract_all(s, F.lit("(?s)(?=(.{%d}))" % n), F.lit(1))
        most = tx.most_often(F.transform(grams, lambda x: F.xxhash64(x)))
        return (F.length(s) >= max(least, n * times)) & tx.let(most, lambda m: (m >= times) & (m * n >= share * F.length(s)))

    return F.coalesce(tx.let(tx.squeeze(F.coalesce(text, F.lit(""))), test), F.lit(False))


def heavy_repetition(rows: DataFrame, id_col: str, text: Column, n: int = 12, least: int = 80, times: int = 6, share: float = 0.35) -> DataFrame:
    """(id, most, heavy): the count of the commonest n-gram, and whether it is `times` or more and covers the share."""
    base = rows.select(F.col(id_col).alias("id"), tx.squeeze(F.coalesce(text, F.lit(""))).alias("s")).withColumn("size", F.length("s"))
    top = base.filter(F.col("size") >= max(least, n * times)).select("id", "size", commonest(F.col("s"), n).cast("long").alias("most"))
    return top.select("id", "most", ((F.col("most") >= times) & (F.col("most") * n >= share * F.col("size"))).alias("heavy"))


def span_score(rows: DataFrame, id_col: str, text: Column, n: int = 8) -> DataFrame:
    """(id, score): how often the commonest n-gram occurs; 1 for texts shorter than n."""
    return rows.select(F.col(id_col).alias("id"), F.coalesce(commonest(tx.squeeze(F.coalesce(text, F.lit(""))), n), F.lit(1)).cast("long").alias("score"))


def repeated_sentences(rows: DataFrame, id_col: str, text: Column, least: int = 8, times: int = 3) -> DataFrame:
    """(id, sentence, count) of sentences of at least `least` characters that occur `times` or more in a text."""
    spread = rows.select(F.col(id_col).alias("id"), F.explode(tx.sentences(text)).alias("sentence")).filter(F.length("sentence") >= least)
    return spread.groupBy("id", "sentence").agg(F.count("*").alias("count")).filter(F.col("count") >= times)


def repeated_lines(rows: DataFrame, id_col: str, text: Column, least: int = 4, times: int = 2) -> DataFrame:
    """(id, line, count): forms of at least `least` characters that lines of a text share; line is the first's spelling."""
    spread = rows.select(F.col(id_col).alias("id"), F.posexplode(tx.lines(text)).alias("at", "line")).withColumn("form", tx.line_form(F.col("line")))
    spread = spread.filter(F.length("form") >= least)
    return spread.groupBy("id", "form").agg(F.min_by("line", "at").alias("line"), F.count("*").alias("count")).filter(F.col("count") >= times).drop("form")


def keyword_audit(rows: DataFrame, text: Column, groups: dict[str, Sequence[str]]) -> DataFrame:
    """(group, keyword, texts): in how many texts each keyword of each group occurs, whatever the case."""
    found = F.array(*(F.struct(F.lit(g).alias("group"), F.lit(k).alias("keyword"), F.contains(F.lower(text), F.lit(k)).alias("hit")) for g, ks in groups.items() for k in ks))
    spread = rows.select(F.explode(F.filter(found, lambda x: x["hit"])).alias("x"))
    return spread.groupBy("x.group", "x.keyword").agg(F.count("*").alias("texts"))


def ticket_like(text: Column, hard: str, soft: Sequence[str], flow: str) -> Column:
    """Whether a hard pattern matches, or two soft ones, or one soft one and a flow id."""
    n = tx.hits(text, soft)
    return text.rlike(hard) | (n >= 2) | ((n >= 1) & text.rlike(flow))


def denied(rows: DataFrame, deny: DataFrame, key: str) -> DataFrame:
    """rows without those whose key is in deny; Spark sends deny to all tasks if it is small."""
    return rows.join(deny.select(key).distinct(), key, "left_anti")


def best_lines(rows: DataFrame, id_col: str, text: Column, words: Sequence[str], least: int = 8, share: float = 0.45, take: int = 8, letters: int = 6, banned: str = "(?!)") -> DataFrame:
    """Texts curated to their `take` most relevant lines: (id, kept, hits, reason).

    Lines need `least` characters, so many letters and a share of them, and nothing banned; they are ordered by keyword hits, then
    length, then place. A text with a banned line is banned, one without lines no_lines, one with under two hits low_relevance,
    else ok.
    """
    from pyspark.sql import Window

    pattern = "(?i)" + "|".join(words)
    spread = rows.select(F.col(id_col).alias("id"), F.posexplode_outer(tx.lines(text)).alias("at", "line"))
    found = F.regexp_count("line", F.lit(r"\p{L}"))
    spread = spread.withColumn("bad", F.coalesce(F.col("line").rlike(banned), F.lit(False)))
    spread = spread.withColumn("fine", (F.length("line") >= least) & (found >= letters) & (found >= share * F.length(tx.squeeze(F.col("line")))) & ~F.col("bad"))
    spread = spread.withColumn("n", F.when(F.col("fine"), F.regexp_count("line", F.lit(pattern))).otherwise(0))
    order = Window.partitionBy("id").orderBy(F.desc(F.coalesce("fine", F.lit(False))), F.desc("n"), F.desc(F.length("line")), "at")
    top = spread.withColumn("any", F.max("bad").over(Window.partitionBy("id"))).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= take)
    out = top.groupBy("id").agg(F.count_if("fine").alias("kept"), F.sum("n").alias("hits"), F.bool_or("any").alias("any"))
    return out.select("id", "kept", "hits", F.when(F.col("any"), "banned").when(F.col("kept") == 0, "no_lines").when(F.col("hits") < 2, "low_relevance").otherwise("ok").alias("reason"))


def contaminated(rows: DataFrame, id_col: str, text: Column, groups: dict[str, Sequence[str]], prefix: str, least: int = 4) -> DataFrame:
    """(id, groups, terms, repeated, prefixed, contaminated): the groups with a keyword in a text and the keywords, whether two of its
    lines of at least `least` characters are the same, whether it begins with the pattern prefix, and whether it is any of these."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = F.filter(F.array(*(F.struct(F.lit(g).alias("g"), F.lit(k).alias("k")) for g, ks in groups.items() for k in ks)), lambda x: F.contains(low, x["k"]))
    lines = F.filter(tx.lines(F.coalesce(text, F.lit(""))), lambda x: F.length(x) >= least)
    out = rows.select(F.col(id_col).alias("id"), F.array_sort(F.array_distinct(F.transform(found, lambda x: x["g"]))).alias("groups"), F.array_sort(F.transform(found, lambda x: x["k"])).alias("terms"), (F.size(lines) > F.size(F.array_distinct(lines))).alias("repeated"), F.coalesce(F.ltrim(text).rlike("^(?:" + prefix + ")"), F.lit(False)).alias("prefixed"))
    return out.withColumn("contaminated", (F.size("groups") > 0) | F.col("repeated") | F.col("prefixed"))
