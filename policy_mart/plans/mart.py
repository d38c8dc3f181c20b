"""Where the mart's tables are, and how its facts and dimensions are loaded."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import MONTH, month_number
from ..files import Files
from ..operators.dealing import pieces
from ..operators.load import bounded, new_by_month, snapshot_rows_to_load
from ..schemas import Table
from ..sources.readers import cast_to, read_or_empty
from ..sources.publish import finish
from ..sources.writers import Written, append_by_month, replace_partitions


@dataclass(frozen=True)
class Mart:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, table: Table) -> DataFrame:
        """Rows loaded so far; facts also have their month."""
        month = [T.StructField(MONTH, T.IntegerType())] if table.by_month else []
        return read_or_empty(self.spark, self.path(table.name), T.StructType([*table.schema.fields, *month]))


# Table name, month column, definition, and True where the definition cuts its rows into ranges by month (`fine`).
Rollup = tuple[str, str, Callable[[DataFrame], DataFrame]] | tuple[str, str, Callable[[DataFrame], DataFrame], bool]


def load_fact(
    mart: Mart,
    table: Table,
    rows: DataFrame,
    since: dt.date | None = None,
    stop_at_gap: bool = False,
    rollups: Sequence[Rollup] = (),
    whole: bool = False,
) -> Written:
    """Append the new rows of a fact, then renew its rollups for the months that got any.

    A run that dies in between leaves a note of where it began; the next one then renews all months
    from there on, since it finds no new rows by which to tell them. One that dies while it appends has
    added nothing, or is first brought to its end, so no part of a key's rows is taken for all of them.
    A large load from files is worked through in pieces by key, which are added together; its files are read
    for each piece, and their rows must not change between. `whole` is for sources that cost too much to read again.
    """
    source = cast_to(rows, table.schema)
    finish(mart.spark, mart.path(table.name))
    loaded = mart.table(table) if Files(mart.spark, mart.path(table.name)).exists(mart.path(table.name)) else None
    of = 1 if whole else pieces(bounded(source, table.date_col, since), table.together or table.keys)
    new = [
        new_by_month(source, loaded, table.keys, table.date_col, since, stop_at_gap, table.together, piece=(number, of))
        for number in range(of)
    ]
    return _append(mart, table, new, 0 if since is None else month_number(since), rollups, dealt=True)


def _append(
    mart: Mart, table: Table, new: DataFrame | Sequence[DataFrame], since: int, rollups: Sequence[Rollup], dealt: bool = False
) -> Written:
    if not rollups:
        return append_by_month(new, mart.path(table.name), table.date_col, table.sort, dealt)
    unfinished = _unfinished_since(mart, table)
    _note_start(mart, table, since)
    written = append_by_month(new, mart.path(table.name), table.date_col, table.sort, dealt)
    months = set(written.months)
    if unfinished is not None:
        loaded = mart.table(table).filter(F.col(MONTH) >= unfinished).select(MONTH).distinct()
        months |= {row[MONTH] for row in loaded.collect()}  # one row per calendar month
    for name, month_col, define, *fine in rollups:
        refresh_rollup(mart, table, name, month_col, define, sorted(months), *fine)
    _clear_notes(mart, table)
    return written


_NOTES = T.StructType([T.StructField("since", T.IntegerType())])


def _notes_path(mart: Mart, table: Table) -> str:
    return mart.path(f"{table.name}_loading")


def _unfinished_since(mart: Mart, table: Table) -> int | None:
    return read_or_empty(mart.spark, _notes_path(mart, table), _NOTES).agg(F.min("since").alias("m")).first()["m"]


def _note_start(mart: Mart, table: Table, since: int) -> None:
    mart.spark.createDataFrame([(since,)], _NOTES).coalesce(1).write.mode("append").parquet(_notes_path(mart, table))


def _clear_notes(mart: Mart, table: Table) -> None:
    mart.spark.createDataFrame([], _NOTES).write.mode("overwrite").parquet(_notes_path(mart, table))


def refresh_rollup(
    mart: Mart, table: Table, name: str, month_col: str, define: Callable[[DataFrame], DataFrame], months: Sequence[int],
    fine: bool = False,
) -> None:
    """Recompute a rollup for some months from the fact's month partitions.

    This also keeps measures right that can not be added up, such as distinct counts. Where the months are large
    it is done for some of them at a time, so that the disk holds the shuffle and the second copy of these only.
    """
    fact = mart.table(table)
    month = (F.year(month_col) * 100 + F.month(month_col)).cast("int")
    for some in _months_at_a_time(mart, table, months):
        rollup = define(fact.filter(F.col(MONTH).isin(some)))
        replace_partitions(rollup.withColumn(MONTH, month), mart.path(name), dealt=fine)


# Fixed value: bytes of the fact's files whose months are summed at a time.
_SUMMED = 2 << 30


def _months_at_a_time(mart: Mart, table: Table, months: Sequence[int]) -> list[list[int]]:
    path, runs, held = mart.path(table.name), [], 0
    files = Files(mart.spark, path)
    for month in months:
        size = files.size(f"{path}/{MONTH}={month}")
        if not runs or held + size > _SUMMED:
            runs.append([])
            held = 0
        runs[-1].append(month)
        held += size
    return runs


def load_snapshots(
    mart: Mart, table: Table, rows: DataFrame, first: dt.date, last: dt.date, rollups: Sequence[Rollup] = ()
) -> Written:
    """Append the days of a daily snapshot that are missing, out of those the source has.

    `rollups` are renewed for the months that got days, as in `load_fact`.
    """
    finish(mart.spark, mart.path(table.name))
    loaded = mart.table(table)
    new = snapshot_rows_to_load(cast_to(rows, table.schema), loaded, table.date_col, first, last)
    return _append(mart, table, new, month_number(first), rollups)
