"""Exact quantiles of large groups: a histogram tells in which bin a rank lies, and only that bin's values are sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def quantiles(rows: DataFrame, group: Sequence[str], value: str, named: dict[str, float], bins: int = 1024, nearest: bool = False) -> DataFrame:
    """(group columns, one column for each name): quantiles of value, linear between ranks; or, nearest, the value at the rank
    that is rounded half to even. Nulls don't count; groups of nulls only are left out.

    No group is held or sorted in one task: its values are counted by bin, and those of the bins asked for by value.
    """
    key = F.to_json(F.struct(*group))
    rows = rows.select(*group, key.alias("_k"), F.col(value).cast("double").alias("_v")).filter("_v is not null")
    stats = rows.groupBy("_k", *group).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    place = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))
    binned = rows.select("_k", "_v").join(stats.select("_k", "_lo", "_hi"), "_k").select("_k", "_v", F.when(F.col("_hi") > F.col("_lo"), place).otherwise(0).cast("int").alias("_b"))

    def counted(df: DataFrame, keys: list[str], order: str) -> DataFrame:
        df = df.groupBy(*keys, order).agg(F.count("*").alias("_c"))
        return df.withColumn("_before", F.sum("_c").over(Window.partitionBy(*keys).orderBy(order)) - F.col("_c"))

    at = {n: F.bround(F.lit(q) * (F.col("_n") - 1), 0) if nearest else F.lit(q) * (F.col("_n") - 1) for n, q in named.items()}
    wanted = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(side).alias("side"), f(x).cast("long").alias("rank")) for n, x in at.items() for side, f in (("low", F.floor), ("high", F.ceil))))
    asked = stats.select("_k", F.explode(wanted).alias("w")).select("_k", "w.*")
    within = (F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("_c"))
    hit = asked.join(counted(binned, ["_k"], "_b"), "_k").filter(within).select("_k", "_b", "name", "side", (F.col("rank") - F.col("_before")).alias("rank"))
    inside = counted(binned.join(hit.select("_k", "_b").distinct(), ["_k", "_b"]), ["_k", "_b"], "_v")
    found = hit.join(inside, ["_k", "_b"]).filter(within)
    pick = lambda n, side: F.max(F.when((F.col("name") == n) & (F.col("side") == side), F.col("_v"))).alias(f"_{side}_{n}")
    found = stats.join(found.groupBy("_k").agg(*(pick(n, side) for n in named for side in ("low", "high"))), "_k")
    return found.select(*group, *((F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * (x - F.floor(x))).alias(n) for n, x in at.items()))
