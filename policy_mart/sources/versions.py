"""Versions of a table's rows, appended by difference.

A load compares its rows with the newest version of each key by a digest, and appends the rows that are
new or changed and a tombstone for each key that is gone. An unchanged source appends nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scd import latest_per_key
from .publish import ADD, TABLE, discard, finish, publish, stage_write
from .readers import read_or_empty

VERSION, DIGEST, GONE = "version", "row_digest", "is_gone"
_OWN = T.StructType(
    [T.StructField(VERSION, T.LongType()), T.StructField(DIGEST, T.StringType()), T.StructField(GONE, T.BooleanType())]
)


def _schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*[f for f in schema.fields if f.name != VERSION], *_OWN.fields])


def row_digest(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """`df` with a digest of each row's values, nulls and types included, but without the columns in `ignore`."""
    values = F.struct(*[F.col(c) for c in df.columns if c not in ignore])
    return df.withColumn(DIGEST, F.md5(F.to_json(values, {"ignoreNullFields": "false"})))


def append_difference(
    rows: DataFrame, path: str, keys: Sequence[str], version: int, ignore: Sequence[str] = (), ties: Sequence[str] = ()
) -> int:
    """Append what differs from the newest versions; returns the number of rows appended, tombstones included.

    Of several source rows of a key the one of the highest `ties`, then digest, counts. Nulls in a key
    are a value like others. `ignore` names columns, such as the load's time, that make no new version.
    Of the table only keys, versions and digests are read. A load that is run again after it died
    appends nothing twice: its own rows are the newest then.
    """
    spark = rows.sparkSession
    finish(spark, path)
    source = latest_per_key(row_digest(rows, ignore), keys, [*ties, DIGEST])
    stored = read_or_empty(spark, path, _schema(rows.schema)).select(*keys, VERSION, DIGEST, GONE)
    # One aggregation finds the newest version, whatever the number of copies.
    state = F.max_by(F.struct(F.col(DIGEST), F.col(GONE)), VERSION)
    current = stored.groupBy(*keys).agg(state.alias("__now")).filter("NOT coalesce(__now.is_gone, false)")
    was = current.select(*[F.col(k).alias(f"__was_{k}") for k in keys], F.col("__now.row_digest").alias("__digest"), F.lit(True).alias("__known"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__was_{k}"))
    both = source.withColumn("__here", F.lit(True)).join(was, same, "full")
    differs = both.filter(F.col("__here").isNull() | F.col("__known").isNull() | ~F.col("__digest").eqNullSafe(F.col(DIGEST)))
    gone = F.col("__here").isNull()
    cells = [F.when(gone, F.col(f"__was_{c}")).otherwise(F.col(c)).alias(c) if c in keys else F.col(c) for c in rows.columns]
    delta = differs.select(*cells, F.lit(version).cast("long").alias(VERSION), DIGEST, gone.alias(GONE))
    staged = stage_write(delta, path, ADD)
    added = spark.read.schema(_schema(rows.schema)).parquet(staged).count()
    if added:
        publish(spark, path, staged)
    else:
        discard(spark, staged)
    return added


def versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All versions, tombstones included."""
    finish(spark, path)
    return read_or_empty(spark, path, _schema(schema))


def current(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest version of every key that is not gone, in the columns of `schema`."""
    return _newest(versions(spark, path, schema), keys).select(*[f.name for f in schema.fields])


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows from before the digests were kept have none, and are there."""
    return latest_per_key(rows, keys, [VERSION, DIGEST]).filter(~F.coalesce(F.col(GONE), F.lit(False)))


def compact_versions(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> None:
    """Keep only the newest version of every key that is not gone. The table is replaced when the new one is complete."""
    publish(spark, path, stage_write(_newest(versions(spark, path, schema), keys), path, TABLE))
