"""Dedup, merge, split and sampling over tables. "First" is always by given order columns; ties go by the last of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered_within

def keep_first(rows: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def prioritised_union(sources: Sequence[DataFrame], key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """Sources merged by priority: rows whose key came first, with `prio`, and (prio, added, skipped) counts."""
    rows = None
    for prio, s in enumerate(sources):
        one = s.withColumn("prio", F.lit(prio))
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("prio", order)))
    counts = rows.groupBy("prio").agg(F.count_if(F.col("_n") == 1).alias("added"), F.count_if(F.col("_n") > 1).alias("skipped"))
    return rows.filter("_n = 1").drop("_n"), counts


def merge_base_wins(base: DataFrame, extra: DataFrame, key: str, order: str) -> DataFrame:
    """base and those rows of extra whose key is in neither base nor an earlier row of extra; null keys always stay."""
    fresh = extra.filter(F.col(key).isNotNull()).join(base.select(key), key, "left_anti")
    return base.unionByName(keep_first(fresh, [key], [order])).unionByName(extra.filter(F.col(key).isNull()))


def md5_mod(key: Column, n: int) -> Column:
    """md5 of a key, a 128-bit number, modulo n."""
    h = F.md5(key)
    high, low = (F.conv(F.substring(h, i, 16), 16, 10).cast("decimal(20,0)") for i in (1, 17))
    return (((high % n) * ((1 << 64) % n) + low % n) % n).cast("int")


def md5_share(key: Column) -> Column:
    """The first eight hex digits of md5 as a share of the largest such number, 0 to 1."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def weighted_split(key: Column, weights: Sequence[tuple[str, float]]) -> Column:
    """A name for each key, by cumulative weights over its share; the last takes the rest."""
    total, share, out = 0.0, md5_share(key), None
    for name, w in weights[:-1]:
        total += w
        out = F.when(share < total, name) if out is None else out.when(share < total, name)
    return out.otherwise(weights[-1][0])


def capped(rows: DataFrame, strata: Sequence[str | Column], order: Sequence[str | Column], cap: int | Column) -> DataFrame:
    """At most `cap` rows of each stratum, by order."""
    n = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    return rows.withColumn("_n", n).filter(F.col("_n") <= cap).drop("_n")


def largest_remainder(quotas: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """(key, quota): weights, one row each, scaled to integers that sum to total; remainders go to the largest fractions."""
    every = Window.partitionBy()
    q = quotas.withColumn("_x", F.lit(total) * F.col(weight) / F.sum(weight).over(every)).withColumn("_f", F.floor("_x"))
    left = F.lit(total) - F.sum("_f").over(every)
    rank = F.row_number().over(Window.orderBy(F.desc(F.col("_x") - F.col("_f")), key))
    return q.withColumn("_left", left).withColumn("_rank", rank).select(key, (F.col("_f") + (F.col("_rank") <= F.col("_left")).cast("int")).cast("long").alias("quota"))


def repeated(rows: DataFrame, times: Column) -> DataFrame:
    """Each row as often as `times` says, numbered by `copy` from 1."""
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), times))).filter(F.col("copy") >= 1)


def variants(rows: DataFrame, text: str, forms: Sequence[tuple[str, str]]) -> DataFrame:
    """Each row once for every named form, whose {text} is the row's: adds variant and query. Equal queries of one row stay one."""
    made = F.array(*(F.struct(F.lit(n).alias("variant"), F.concat(F.lit(f.split("{text}")[0]), F.col(text), F.lit(f.split("{text}")[1])).alias("query")) for n, f in forms))
    return rows.withColumn("_v", F.explode(made)).select(*rows.columns, "_v.variant", "_v.query")


def drawn_pairs(pool: DataFrame, bucket: str, text: str, order: Sequence[str], quota: int, attempts: int = 50) -> DataFrame:
    """(bucket, place, digest): pairs of different texts of a bucket, drawn by hashes of the attempt's number; distinct ones in order
    of attempt up to the quota, which attempts times quota draws must fill."""
    rows, sizes = numbered_within(pool, bucket, order, "i")
    pool = rows.select(F.col(bucket).alias("bucket"), F.col(text).alias("t"), "i")
    draws = sizes.withColumnRenamed(bucket, "bucket").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(quota * attempts - 1))))
    pick = lambda slot: F.conv(F.substring(F.md5(F.concat_ws(":", "bucket", F.lit(slot), F.col("k").cast("string"))), 1, 8), 16, 10).cast("long") % F.col("size")
    draws = draws.select("bucket", "k", pick("a").alias("a"), pick("b").alias("b")).filter("a <> b")
    one, two = (pool.select("bucket", F.col("i").alias(x), F.col("t").alias(f"t{x}")) for x in "ab")
    found = draws.join(one, ["bucket", "a"]).join(two, ["bucket", "b"]).groupBy("bucket", F.md5(F.concat_ws("\n", "ta", "tb")).alias("digest")).agg(F.min("k").alias("k"))
    return found.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy("k"))).filter(F.col("place") <= quota).select("bucket", "place", "digest")
