"""Writes: monthly appends, full refreshes, versioned appends, month replacement, compaction."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import Files
from ..functions.dates import MONTH, yyyymm
from ..workdir import work_dir
from .publish import ADD, SWAP, TABLE, discard, finish, publish, stage_write


@dataclass(frozen=True)
class Written:
    """Rows written and months touched (at most one entry per calendar month)."""

    rows: int
    months: tuple[int, ...]


def _with_month(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(MONTH, yyyymm(date_col))


def _balanced(df: DataFrame, partition_col: str) -> DataFrame:
    """Rows of one partition value together, in files of about AQE's advisory size: small
    partitions share a task and large ones are split over several."""
    return df.hint("rebalance", partition_col)


def _sorted(df: DataFrame, partition_col: str, sort: Sequence[str]) -> DataFrame:
    return df.sortWithinPartitions(partition_col, *sort) if sort else df


def append_by_month(
    df: DataFrame | Sequence[DataFrame], path: str, date_col: str, sort: Sequence[str] = (), dealt: bool = False
) -> Written:
    """Append to a table partitioned by month. The touched months come out of the same pass.

    They are observed behind the shuffle: AQE drops a shuffle that turns out empty, and with it
    whatever was observed in front of it. The load's files are staged and then moved, under a name of
    the load's own, so a load that dies has either added nothing yet or is ended by `finish`. Who
    compares new rows with the table calls `finish` before reading it. `dealt` rows are dealt out by month
    already (`operators.dealing`) and are not shuffled again. A load in pieces is several frames, written one
    after the other and moved together.
    """
    pieces = [df] if isinstance(df, DataFrame) else list(df)
    spark = pieces[0].sparkSession
    finish(spark, path)
    seen = [Observation() for _ in pieces]
    rows = []
    for piece, counted in zip(pieces, seen, strict=True):
        monthly = _with_month(piece, date_col)
        observed = (monthly if dealt else _balanced(monthly, MONTH)).observe(
            counted, F.collect_set(MONTH).alias("months"), F.count(F.lit(1)).alias("rows")
        )
        rows.append(_sorted(observed, MONTH, sort))
    publish(spark, path, stage_write(rows, path, ADD, MONTH))
    months = {month for counted in seen for month in counted.get["months"]}
    return Written(sum(counted.get["rows"] for counted in seen), tuple(sorted(months)))


def replace_partitions(
    df: DataFrame, path: str, partition_col: str = MONTH, sort: Sequence[str] = (), dealt: bool = False
) -> None:
    """Replace the partitions that `df` has rows for; others stay. `df` may read `path`. `dealt` is as in
    `append_by_month`."""
    finish(df.sparkSession, path)
    rows = _sorted(df if dealt else _balanced(df, partition_col), partition_col, sort)
    publish(df.sparkSession, path, stage_write(rows, path, SWAP, partition_col))


def full_refresh(df: DataFrame, path: str, guard_empty: bool = False) -> bool:
    """Replace the whole table. With `guard_empty` an empty source leaves it untouched.

    The source is run once, and its rows are counted as they are written beside the table, which stays
    as it is until they are complete. `df` may read `path`.
    """
    spark = df.sparkSession
    finish(spark, path)
    seen = Observation()
    staged = stage_write(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, TABLE)
    if guard_empty and not seen.get["rows"]:
        discard(spark, staged)
        return False
    publish(spark, path, staged)
    return True


def stage(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared work folder and read from there.

    For results that several later steps read, where Spark would compute them every time. Whoever
    returns rows that read the copy leaves it there; others use `staged`.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`stage` for as long as the block runs; the copy is removed at its end."""
    path = work_dir(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.parquet(path)
    finally:
        Files(df.sparkSession, path).remove(path)


def versioned_append(df: DataFrame, path: str, version: dt.datetime | int, column: str = "version") -> None:
    """Append the rows with the load's version; readers take the latest row per key."""
    df.withColumn(column, F.lit(version)).write.mode("append").parquet(path)


def compact_months(spark: SparkSession, path: str, months: Sequence[int], sort: Sequence[str] = ()) -> None:
    """Rewrite months made of many small files into few sorted ones."""
    finish(spark, path)
    chosen = spark.read.parquet(path).filter(F.col(MONTH).isin(list(months)))
    replace_partitions(chosen, path, MONTH, sort)


def month_files(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per month. Spark lists the files, on its executors where there are many; none is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    month = F.regexp_extract("path", rf"/{MONTH}=(\d+)/", 1)
    return (
        listed.select(F.when(month != "", month).cast("int").alias(MONTH), "length")
        .dropna()
        .groupBy(MONTH)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def fragmented_months(spark: SparkSession, path: str, file_bytes: int) -> dict[int, int]:
    """Months with over twice the files that their bytes ask for, and how many they ask for."""
    wanted = F.ceil(F.col("bytes") / file_bytes).cast("long")
    found = month_files(spark, path).withColumn("wanted", wanted).filter(F.col("files") > 2 * F.col("wanted"))
    return {r[MONTH]: r["wanted"] for r in found.collect()}  # a row per calendar month


def compact_fragmented(spark: SparkSession, path: str, file_bytes: int = 128 << 20, sort: Sequence[str] = ()) -> dict[int, int]:
    """Rewrite the months made of too many files into files of about `file_bytes`; other months keep theirs.

    Each file gets the rows of one month with one hash, sorted, so a month has just as many files as it
    asks for and a second run finds nothing to do.
    """
    finish(spark, path)
    months = fragmented_months(spark, path, file_bytes)
    if months:
        chosen = spark.read.parquet(path).filter(F.col(MONTH).isin(list(months)))
        before = accumulate(months.values(), initial=0)
        slots = spark.createDataFrame([(m, n, at) for (m, n), at in zip(months.items(), before)], f"{MONTH} int, __files int, __at int")
        slot = F.col("__at") + F.pmod(F.xxhash64(*chosen.columns), F.col("__files")).cast("int")
        # A row per calendar month is sent to all tasks.
        dealt = chosen.join(F.broadcast(slots), MONTH).repartitionById(sum(months.values()), slot)
        rows = dealt.select(*chosen.columns).sortWithinPartitions(MONTH, *sort)
        publish(spark, path, stage_write(rows, path, SWAP, MONTH))
    return months


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str, partition_col: str | None = None
) -> None:
    """Register a typed parquet table if it does not exist yet."""
    fields = list(schema.fields)
    if partition_col and partition_col not in schema.names:
        fields.append(T.StructField(partition_col, T.IntegerType()))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    partitioned = f"PARTITIONED BY (`{partition_col}`)" if partition_col else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioned} LOCATION '{path}'")


def insert_select(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert a query's rows into a registered table, by column name."""
    target = df.sparkSession.table(table).columns
    df.select(*target).write.insertInto(table, overwrite=overwrite)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a report in parallel parts, in the frame's order; csv gets a header in every part."""
    df.write.mode("overwrite").option("header", True).format(fmt).save(path)
