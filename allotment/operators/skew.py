"""Joins and expansions that hold when one key owns a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it owns more than 1/HOT_SHARE of all rows, so there can be
# fewer than HOT_SHARE hot keys, however large the data.
HOT_SHARE = 1000
HOT_MINIMUM = 100_000
# Rows that the groups of all hot keys together may have for a broadcast.
HOT_ROWS = 200_000


def hot_keys(
    sizes: DataFrame, size: str, total: int | None, largest: int | None, minimum: int = HOT_MINIMUM
) -> DataFrame | None:
    """Rows of ``sizes`` (one per key) whose key is hot, or None when none is.

    ``total`` and ``largest`` are the sum and the maximum of the sizes.
    """
    limit = max(minimum, (total or 0) // HOT_SHARE)
    if (largest or 0) <= limit:
        return None
    return sizes.filter(F.col(size) > limit)


def join_to_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    hot: DataFrame | None,
) -> DataFrame:
    """Inner join of many ``rows`` to few rows per key in ``groups``; NULL matches NULL.

    Rows of hot keys stay where they are and meet a broadcast of their groups
    (fewer than HOT_SHARE keys, and counted to be HOT_ROWS rows at most); all others go
    through an ordinary join.
    """
    def matched(left: DataFrame, right: DataFrame) -> DataFrame:
        left, right = left.alias("l"), right.alias("r")
        same = reduce(Column.__and__, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
        others = [F.col(f"r.{c}") for c in right.columns if c not in keys]
        return left.join(right, same).select("l.*", *others)

    if hot is None:
        return matched(rows, groups)

    def split(df: DataFrame, how: str) -> DataFrame:
        left, right = df.alias("l"), F.broadcast(hot.select(*keys)).alias("h")
        same = reduce(Column.__and__, [F.col(f"l.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys])
        return left.join(right, same, how)

    hot_groups = split(groups, "left_semi")
    if hot_groups.limit(HOT_ROWS + 1).count() > HOT_ROWS:
        return matched(rows, groups)
    hot_part = matched(split(rows, "left_semi"), F.broadcast(hot_groups))
    cold_part = matched(split(rows, "left_anti"), split(groups, "left_anti"))
    return hot_part.unionByName(cold_part)


def repeat_rows(df: DataFrame, copies: str, most: int | None, number: str, chunk: int = 4096) -> DataFrame:
    """Each row ``copies`` times (at least once), numbered 1.. in ``number``.

    ``most`` is the largest number of copies. Rows with many copies are first
    cut into chunks that are spread over the tasks, so neither an array nor a
    task has to hold all copies of one row.
    """
    one, step = F.lit(1).cast("bigint"), F.lit(chunk).cast("bigint")
    if (most or 1) <= 1:
        return df.withColumn(number, one)
    times = F.greatest(F.coalesce(F.col(copies), one), one).cast("bigint")
    few = df.filter(times <= step).withColumn(number, F.explode(F.sequence(one, times)))
    if most <= chunk:
        return few
    starts = F.sequence(F.lit(0).cast("bigint"), F.floor((times - 1) / step).cast("bigint"))
    many = df.filter(times > step).withColumn("_chunk", F.explode(starts))
    done = F.col("_chunk") * step
    many = (
        many.repartition(*many.columns)
        .withColumn(number, F.explode(F.sequence(one, F.least(step, times - done))))
        .withColumn(number, F.col(number) + done)
        .drop("_chunk")
    )
    return few.unionByName(many)
