"""Numbers of rows in an order, without a window over all of them or over a large group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored


def numbered(rows: DataFrame, order: Sequence[str], name: str = "n") -> DataFrame:
    """rows with the place of each, from 0, in the order of some columns, nulls first.

    Rows are dealt by ranges and sorted there; a place is that in the partition and the number of rows in those before it, of
    which one count for each partition goes to all tasks. Equal rows share a partition but are numbered apart. An empty table
    stays empty; a column called `name` is replaced.
    """
    keys = [F.asc_nulls_first(c) for c in order]
    at = rows.drop(name).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id())
    at = stored(at, "numbered")
    # the upper bits of the number tell the partition, the lower 33 the place in it
    sizes = at.groupBy(F.shiftright(name, 33).alias("p")).agg(F.count("*").alias("c")).orderBy("p").collect()
    before, total = [], 0
    for r in sizes:
        before.append((r.p, total))
        total += r.c
    part, base = (f"{name}_{x}" for x in ("part", "base"))
    starts = rows.sparkSession.createDataFrame(before, f"`{part}` long, `{base}` long")
    placed = at.join(F.broadcast(starts), F.shiftright(name, 33) == F.col(part))
    return placed.withColumn(name, F.col(name) - F.shiftleft(F.col(part), 33) + F.col(base)).drop(part, base)


def numbered_within(rows: DataFrame, group: str, order: Sequence[str], name: str = "n") -> tuple[DataFrame, DataFrame]:
    """rows with the place of each, from 0, in its group (null is one), and (group, size): a group may hold most of all rows."""
    n = numbered(rows, [group, *order], name)
    first, size = f"{name}_first", "size"
    groups = n.groupBy(group).agg(F.min(name).alias(first), F.count("*").alias(size))
    # a group is a range of numbers, so its first is found by the number itself, without gathering the group
    bounds = groups.select(F.col(group).alias(f"{name}_group"), first)
    out = n.join(bounds, F.col(group).eqNullSafe(F.col(f"{name}_group"))).withColumn(name, F.col(name) - F.col(first))
    return out.drop(first, f"{name}_group"), groups.select(group, size)
