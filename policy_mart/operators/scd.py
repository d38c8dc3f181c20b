"""Versioned dimensions: latest row per key, and changes against the current rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keyed import join_unique


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The row with the highest `order_cols` of each key; later columns break ties.

    Spark keeps only the first row per key and map task before the shuffle (WindowGroupLimit),
    so a hot key does not gather in one task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return df.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1").drop("__rank")


def scd_delta(
    source: DataFrame, current: DataFrame, keys: Sequence[str], compare: Sequence[str], valid_from: str
) -> DataFrame:
    """Rows to add to the history: new keys, and rows that changed and are newer.

    `current` has one row per key. A change to or from null counts as a change.
    """
    was = {c: f"__was_{c}" for c in [*compare, valid_from]}
    known = current.select(*keys, *[F.col(c).alias(n) for c, n in was.items()], F.lit(True).alias("__known"))
    changed = F.lit(False)
    for c in compare:
        changed = changed | ~F.col(c).eqNullSafe(F.col(was[c]))
    newer = F.col(valid_from) > F.col(was[valid_from])
    compared = join_unique(source, known, keys)
    return compared.filter(F.col("__known").isNull() | (changed & newer)).select(*source.columns)


def apply_scd(history: DataFrame, delta: DataFrame) -> DataFrame:
    return history.unionByName(delta)


def current_rows(history: DataFrame, keys: Sequence[str], valid_from: str, *ties: str) -> DataFrame:
    """The current projection of a history table."""
    return latest_per_key(history, keys, [valid_from, *ties])


def upsert_columns(df: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Replace `columns` in the rows whose key has an update; a null update keeps the old value.

    `updates` has one row per key.
    """
    new = updates.select(key, *[F.col(c).alias(f"__new_{c}") for c in columns])
    joined = join_unique(df, new, [key])
    merged = joined.withColumns({c: F.coalesce(F.col(f"__new_{c}"), F.col(c)) for c in columns})
    return merged.select(*df.columns)
