"""Rows dealt out by month, so that one shuffle serves the comparison and the files by month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..files import file_bytes

TASK = "__task"
# Fixed value: a month's rows go to one task in so many, which keeps a table's files few.
_SHARE = 50


# Fixed values. Sources below so many bytes of files are loaded in one piece.
_SMALL = 256 << 20
# Bytes of a piece's rows at 8 a column, before compression, and the pieces of the largest load.
_PIECE = 8 << 30
_MOST = 16
# One key in so many is counted to tell how many rows there are.
_COUNTED = 64


def pieces(rows: DataFrame, by: Sequence[str]) -> int:
    """In how many pieces by key to load rows, so that the disk holds the shuffles of one piece at a time.

    For each piece the files are read again, which Spark can do by a filter on the key in front of any
    join; hence no more than `_MOST`. Each piece has all rows of its keys. What is not in files is read once.
    The rows of one key in so many are counted; this decides on the number only.
    """
    if not file_bytes(rows, _SMALL) >= _SMALL:
        return 1
    found = in_piece(rows, by, (0, _COUNTED)).count() * _COUNTED
    return max(1, min(_MOST, -(-found * 8 * len(rows.columns) // _PIECE)))


def in_piece(df: DataFrame, by: Sequence[str], piece: tuple[int, int]) -> DataFrame:
    """The rows of piece (number, pieces)."""
    number, of = piece
    # The first value makes this another hash than those of joins and `deal`, which would leave tasks empty.
    return df if of == 1 else df.filter(F.pmod(F.xxhash64(F.lit("piece"), *by), F.lit(of)) == number)


def deal(df: DataFrame, date_col: str, by: Sequence[str], pieces: int = 1) -> DataFrame:
    """`df` shuffled by month and, within a month, by the hash of `by`; TASK has the number of the task.

    Months that follow one another go to tasks that do, so all tasks get about the same number of months'
    shares. A task holds few months whole or in shares: whoever groups by TASK, the month and columns that
    include `by`, or writes a partition per month, needs no further shuffle. `spark.sql.shuffle.partitions`
    is the number of tasks. Rows are sent as they are, so this is for groups about as many as the rows. A piece
    of a load takes its part of the tasks, so that the pieces together give about as many files.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min(tasks, _SHARE), -(-tasks // pieces))
    shares = -(-tasks // _SHARE)
    share = F.pmod(F.xxhash64(*by), F.lit(shares))
    return df.withColumn(TASK, F.pmod(_index(date_col) * shares + share, F.lit(tasks)).cast("int")).repartitionById(tasks, TASK)


def _index(date_col: str) -> Column:
    return F.coalesce(F.year(date_col) * 12 + F.month(date_col), F.lit(0))
