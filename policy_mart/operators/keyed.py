"""Joins against sides that hold one row per key, and other group work that survives hot keys.

A window over the whole group would send a hot key's rows to one task. Here the group is first
aggregated (partially before the shuffle, so a hot key sends one row per map task) and the result
is joined back. The join conditions are null-safe. That makes Spark shuffle the aggregated side
once more instead of reusing the partitioning of the aggregate, and only joins with a shuffle on
both sides have their hot partitions split by AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_unique(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", match_nulls: bool = False
) -> DataFrame:
    """Join `right`, which has one row per key, to `left`, keeping the key columns of `left`.

    `how` is "left", "inner", "left_semi" or "left_anti". As in SQL a key with a null matches
    nothing, unless `match_nulls` lets nulls meet, as they do in a group.
    """
    names = {k: f"__right_{k}" for k in keys}
    if not match_nulls:
        right = _complete(right, keys)
    condition = None
    for k, r in names.items():
        same = F.col(k).eqNullSafe(F.col(r))
        condition = same if condition is None else condition & same
    joined = left.join(right.withColumnsRenamed(names), condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*names.values())


def _complete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a null in the keys, by conditions that a source can evaluate."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys without the ones holding a null, which never equal anything."""
    return _complete(df.select(*keys), keys).distinct()


def not_in(left: DataFrame, right: DataFrame, keys: Sequence[str], unique: bool = True) -> DataFrame:
    """Rows of `left` whose key is absent from `right`. A key with a null is always absent.

    Without `unique` the right side's keys are shuffled as they are, which saves a shuffle where
    few of them repeat.
    """
    present = unique_keys(right, keys) if unique else _complete(right.select(*keys), keys)
    return join_unique(left, present, keys, "left_anti")


def present_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` whose key occurs in `right`."""
    return join_unique(left, unique_keys(right, keys), keys, "left_semi")


def with_flag(left: DataFrame, right: DataFrame, column: str, other: str, flag: str) -> DataFrame:
    """Add a boolean `flag`: does the value of `column` occur among `right`'s `other` values?"""
    members = (
        right.select(F.col(other).alias("__member")).dropna().distinct().withColumn("__found", F.lit(True))
    )
    joined = left.join(members, F.col(column).eqNullSafe(F.col("__member")), "left")
    return joined.withColumn(flag, F.col("__found").isNotNull()).drop("__member", "__found")


def with_group_stats(df: DataFrame, keys: Sequence[str], *stats: Column) -> DataFrame:
    """Add aggregates of each row's group, as `agg(...).over(partitionBy(keys))` would."""
    return join_unique(df, df.groupBy(*keys).agg(*stats), keys, match_nulls=True)
