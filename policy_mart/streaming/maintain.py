"""Rollups, current projections and facts that follow a stream of inserted rows.

Each micro-batch writes what it adds to `<path>/batch=<id>` and readers combine the batches: sums
are added up, and of several versions the latest wins. No state grows with the keys, and a batch
that is run again after a failure overwrites its own folder, so nothing counts twice. Facts are
appended by key, and measures that cannot be added up are recomputed for the months of the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import MONTH, yyyymm
from ..functions.numbers import money_state
from ..operators.load import new_by_month
from ..operators.rollup import finished, merge_states, rollup_states
from ..operators.scd import latest_per_key
from ..sources.readers import read_or_empty
from ..sources.publish import finish
from ..sources.writers import append_by_month, replace_partitions

BATCH = "batch"
FOLDED = -1

# Path, month column, definition, and True where the definition deals its rows out by month (`fine`).
Rollup = tuple[str, str, Callable[[DataFrame], DataFrame]] | tuple[str, str, Callable[[DataFrame], DataFrame], bool]


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Work through everything that has arrived, in batches of the source's size, then stop."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _write_batch(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{BATCH}={batch}")


def stream_rollup(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    date_col: str,
    month_col: str,
    dims: Sequence[str],
    sums: Mapping[str, str],
    count: str,
    by: Column | None = None,
) -> StreamingQuery:
    """Aggregate each batch and keep the partial sums. `by` replaces the month as period.

    Sums are kept as states (`money_state`), so that the result does not depend on how the rows were
    split into batches. Only sums and counts can be kept this way: for distinct counts and extremes
    see `stream_append`.
    """

    def each(batch: DataFrame, number: int) -> None:
        if by is None:
            extra = {count: F.count(F.lit(1))}
            partial = rollup_states(batch, date_col, month_col, dims, sums, extra=extra)
        else:
            rows = batch.withColumn(month_col, by)
            partial = rows.groupBy(month_col, *dims).agg(
                *[money_state(c).alias(n) for n, c in sums.items()],
                F.count(F.lit(1)).alias(count),
            )
        _write_batch(partial, path, number)

    return _run(stream, checkpoint, each)


def rollup_so_far(
    spark: SparkSession, path: str, keys: Sequence[str], sums: Sequence[str], counts: Sequence[str]
) -> DataFrame:
    """The rollup of all rows that have arrived."""
    return finished(merge_states(spark.read.parquet(path), keys, sums, counts), sums)


def fold_rollup(
    spark: SparkSession, path: str, new_path: str, keys: Sequence[str], sums: Sequence[str], counts: Sequence[str]
) -> None:
    """`fold_batches` for a rollup, whose sums stay states."""
    fold_batches(spark, path, new_path, lambda parts: merge_states(parts, keys, sums, counts))


def stream_current(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order_cols: Sequence[str]
) -> StreamingQuery:
    """Keep each batch's latest row per key."""

    def each(batch: DataFrame, number: int) -> None:
        _write_batch(latest_per_key(batch, keys, order_cols), path, number)

    return _run(stream, checkpoint, each)


def current_so_far(
    spark: SparkSession, path: str, keys: Sequence[str], order_cols: Sequence[str]
) -> DataFrame:
    """Latest row per key over all batches; of equal rows the later batch's."""
    return latest_per_key(spark.read.parquet(path), keys, [*order_cols, BATCH]).drop(BATCH)


def stream_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    date_col: str,
    order_cols: Sequence[str],
    rollups: Sequence[Rollup] = (),
) -> StreamingQuery:
    """Append the rows whose key the fact does not have yet, however late they come.

    A batch is compared with the fact's partitions of its own months only. A key that repeats within
    a batch is loaded once. A row with a null key can not be told from another one when a batch runs
    again, so such rows go to a table by batch; `streamed_fact` returns both.

    `rollups` (see `Rollup`) are recomputed from the fact for the months of the
    batch, after they were appended. This keeps distinct counts right, which can not be added up. A
    batch that died in between is run again: it finds its rows loaded and renews the same months.
    """
    schema = stream.schema

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        finish(spark, path)
        months = months_of(batch, date_col)
        unkeyed = _unkeyed(keys)
        _write_months(batch.filter(unkeyed).withColumn(MONTH, yyyymm(date_col)), _unkeyed_path(path), number)
        append_by_month(unseen(batch.filter(~unkeyed), path, keys, date_col, order_cols, months), path, date_col, dealt=True)
        touched = streamed_fact(spark, path, schema).filter(F.col(MONTH).isin(months))
        for rollup_path, month_col, define, *fine in rollups if months else ():
            month = (F.year(month_col) * 100 + F.month(month_col)).cast("int")
            replace_partitions(define(touched).withColumn(MONTH, month), rollup_path, dealt=any(fine))

    return _run(stream, checkpoint, each)


def months_of(rows: DataFrame, date_col: str) -> list[int]:
    """The calendar months that rows belong to."""
    found = rows.select(yyyymm(date_col).alias(MONTH)).dropna().distinct().collect()
    return sorted(row[MONTH] for row in found)


def unseen(
    rows: DataFrame, path: str, keys: Sequence[str], date_col: str, order_cols: Sequence[str], months: Sequence[int]
) -> DataFrame:
    """One row for each key that the fact lacks, dealt out by month. `months` are those of the rows; others are not read."""
    fact = read_or_empty(rows.sparkSession, path, _with_month(rows.schema))
    return new_by_month(latest_per_key(rows, keys, order_cols), fact, keys, date_col, months=months)


def _unkeyed(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for k in keys:
        found = found | F.col(k).isNull()
    return found


def _with_month(schema: T.StructType, *more: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *more, T.StructField(MONTH, T.IntegerType())])


def _write_months(df: DataFrame, path: str, batch: int) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MONTH)
    writer.parquet(f"{path}/{BATCH}={batch}")


def _unkeyed_path(path: str) -> str:
    return f"{path.rstrip('/')}-unkeyed"


def streamed_fact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of `schema` that `stream_append` loaded, with their month, by which both tables are partitioned."""
    unkeyed = read_or_empty(spark, _unkeyed_path(path), _with_month(schema, T.StructField(BATCH, T.IntegerType())))
    return read_or_empty(spark, path, _with_month(schema)).unionByName(unkeyed.drop(BATCH))


def fold_batches(
    spark: SparkSession, path: str, new_path: str, combine: Callable[[DataFrame], DataFrame]
) -> None:
    """Combine all but the newest batch into one, in a new table for the stream to go on with.

    The newest batch is copied as it is, because it may be run again.
    """
    batches = spark.read.parquet(path)
    newest = batches.agg(F.max(BATCH)).first()[0]
    _write_batch(combine(batches.filter(F.col(BATCH) < newest)).drop(BATCH), new_path, FOLDED)
    _write_batch(batches.filter(F.col(BATCH) == newest).drop(BATCH), new_path, newest)
