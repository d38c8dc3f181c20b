"""Incremental loads: new rows of a fact, missing days of a snapshot, months without a gap."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import MONTH, month_index, month_number, yyyymm
from .dealing import TASK, deal, in_piece
from .keyed import not_in


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    return df if MONTH in df.columns else df.withColumn(MONTH, yyyymm(date_col))


def contiguous_months(months: DataFrame, start: int | None = None) -> DataFrame:
    """Months from `start` (default: the first one) up to the first month without rows.

    `months` has a `yyyymm` column. With a given `start` a gap right there leaves nothing.
    """
    present = months.select(MONTH).dropna().distinct()
    if start is not None:
        present = present.filter(F.col(MONTH) >= start)
    # One row per calendar month is left, so one task can number them however long the fact is.
    in_order = Window.orderBy(MONTH)
    position = F.row_number().over(in_order) - 1
    first = F.first(MONTH).over(in_order) if start is None else F.lit(start)
    return present.withColumn("__run", month_index(MONTH) - position == month_index(first)).filter("__run").select(MONTH)


def append_new(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    date_col: str,
    since: dt.date | None = None,
    stop_at_gap: bool = False,
    months: Sequence[int] | None = None,
) -> DataFrame:
    """Source rows whose key is not in the target's same month.

    Duplicates inside the batch are kept, and rows with a null key are always new. Rows without a
    date belong to no month and are left out. `since` bounds both scans: source rows by date,
    target keys by the month partition. The target's keys are read once and shuffled once: an anti
    join needs no distinct right side. `months` names the months that the source has rows of, where they
    are known: of the target only those are read. With `stop_at_gap` only the months before the first empty
    one are loaded.
    """
    rows, loaded = _compared(source, target, date_col, since, stop_at_gap, months)
    return not_in(rows, loaded, [MONTH, *keys], unique=False).select(*source.columns)


def new_by_month(
    source: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    date_col: str,
    since: dt.date | None = None,
    stop_at_gap: bool = False,
    together: Sequence[str] = (),
    months: Sequence[int] | None = None,
    piece: tuple[int, int] = (0, 1),
) -> DataFrame:
    """The rows of `append_new`, dealt out by month: they can be written by month as they are.

    The target's keys and the source's rows go through one shuffle together, and a row is new where its
    key and month have none of the target's. `together` names keys by which a month's rows are dealt out
    (default: all); rows that share them stay side by side, which makes them smaller. Without a target all
    rows are new. `piece` (number, pieces) leaves the rows of some of these keys only.
    """
    rows, loaded = _compared(source, source.limit(0) if target is None else target, date_col, since, stop_at_gap, months)
    by = list(together or keys)
    rows, loaded = in_piece(rows, by, piece), in_piece(loaded, by, piece)
    if target is None:
        return deal(rows, date_col, by, piece[1]).select(*source.columns)
    have = loaded.select(date_col, MONTH, *keys).dropna(subset=list(keys)).withColumn(_LOADED, F.lit(True))
    both = rows.withColumn(_LOADED, F.lit(False)).unionByName(have, allowMissingColumns=True)
    known = F.max(_LOADED).over(Window.partitionBy(TASK, MONTH, *keys))
    return deal(both, date_col, by, piece[1]).withColumn("__known", known).filter("NOT __known").select(*source.columns)


_LOADED = "__loaded"


def _compared(
    source: DataFrame, target: DataFrame, date_col: str, since: dt.date | None, stop_at_gap: bool,
    months: Sequence[int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The source's rows and the target's with their month, both bounded as `append_new` says."""
    rows = with_month(bounded(source, date_col, since), date_col)
    loaded = with_month(target, date_col)
    if since is not None:
        loaded = loaded.filter(F.col(MONTH) >= month_number(since))
    if months is not None:
        loaded = loaded.filter(F.col(MONTH).isin(list(months)))
    if stop_at_gap:
        start = None if since is None else month_number(since)
        run = contiguous_months(rows, start)
        rows = rows.join(run, MONTH, "left_semi")
    return rows, loaded


def bounded(source: DataFrame, date_col: str, since: dt.date | None) -> DataFrame:
    """The source's rows that have a date, not before `since`."""
    rows = source.filter(F.col(date_col).isNotNull())
    return rows if since is None else rows.filter(F.col(date_col) >= F.lit(since))


def first_date(source: DataFrame, date_col: str) -> dt.date | None:
    """The source's earliest date, where a load without a given start begins."""
    found = source.agg(F.min(date_col).alias("d")).first()["d"]
    return found.date() if isinstance(found, dt.datetime) else found


def calendar(source: DataFrame, first: dt.date, last: dt.date, name: str) -> DataFrame:
    """One row per day, both ends included."""
    days = F.explode(F.sequence(F.lit(first), F.lit(last)))
    return source.sparkSession.range(1).select(days.alias(name))


def missing_dates(
    source: DataFrame, loaded: DataFrame, date_col: str, first: dt.date, last: dt.date
) -> DataFrame:
    """Days of the calendar that are not loaded yet and that the source can supply."""
    days = calendar(source, first, last, date_col)
    have = loaded.select(date_col).distinct()
    offered = source.filter(F.col(date_col).between(F.lit(first), F.lit(last))).select(date_col).distinct()
    return days.join(have, date_col, "left_anti").join(offered, date_col, "left_semi")


def snapshot_rows_to_load(
    source: DataFrame, loaded: DataFrame, date_col: str, first: dt.date, last: dt.date
) -> DataFrame:
    """Whole days of the source, within the calendar, that the target lacks.

    A source row's own date proves that the source has the day, so only the loaded days are
    looked up.
    """
    span = F.col(date_col).between(F.lit(first), F.lit(last))
    have = loaded.filter(span).select(date_col).distinct()
    return source.filter(span).join(have, date_col, "left_anti").select(*source.columns)
