"""A table that is updated in place by key, without rewriting the rows that stay."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import join_unique
from .publish import SWAP, discard, finish, publish, stage_write
from .writers import replace_partitions, staged

BUCKET = "key_bucket"
_CHANGED = "__changed"


@dataclass(frozen=True)
class KeyedTable:
    """Rows in partitions by the hash of a key. The number of buckets is the table's for good: choose it so that
    one holds about as much as a few files. Rows of equal keys, and those without one, are in one bucket."""

    spark: SparkSession
    path: str
    key: str
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame) -> None:
        """Replace the buckets that `rows` has rows of; on a new table, all."""
        replace_partitions(rows.withColumn(BUCKET, self._bucket()), self.path, BUCKET)

    def read(self) -> DataFrame:
        finish(self.spark, self.path)
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def update(self, updates: DataFrame, columns: Sequence[str]) -> int:
        """Set `columns` in the rows whose key has an update; returns the number of rows that changed.

        `updates` has one row per key, and a null in it keeps the old value. Only buckets with updated
        keys are read, and only those with a changed row are replaced; the files of all others stay. Updates
        may be made from the table itself. They are worked out once, and kept in the work folder for the
        time of the update. Should the run die, the next use of the table ends it.
        """
        finish(self.spark, self.path)
        new = updates.select(self.key, *[F.col(c).alias(f"__new_{c}") for c in columns]).withColumn(BUCKET, self._bucket())
        with staged(new, "updates") as kept:
            return self._merge(kept, columns)

    def _merge(self, new: DataFrame, columns: Sequence[str]) -> int:
        touched = [r[BUCKET] for r in new.select(BUCKET).distinct().collect()]  # a row per bucket at most
        if not touched:
            return 0
        rows = self.spark.read.parquet(self.path)
        joined = join_unique(rows.filter(F.col(BUCKET).isin(touched)), new.drop(BUCKET), [self.key])
        changed = F.lit(False)
        for c in columns:
            changed = changed | (F.col(f"__new_{c}").isNotNull() & ~F.col(f"__new_{c}").eqNullSafe(F.col(c)))
        merged = joined.withColumn(_CHANGED, changed).withColumns({c: F.coalesce(F.col(f"__new_{c}"), F.col(c)) for c in columns})
        # AQE splits a large bucket and joins small ones.
        dealt = merged.select(*rows.columns, _CHANGED).hint("rebalance", BUCKET)
        seen = Observation()
        dealt = dealt.observe(seen, F.count_if(_CHANGED).alias("rows"), F.collect_set(F.when(F.col(_CHANGED), F.col(BUCKET))).alias("buckets"))
        written = stage_write(dealt.drop(_CHANGED), self.path, SWAP, BUCKET)
        if not seen.get["rows"]:
            discard(self.spark, written)
            return 0
        publish(self.spark, self.path, written, {f"{BUCKET}={b}" for b in seen.get["buckets"]})
        return seen.get["rows"]
