"""Writes in two steps, so that a run that dies leaves the old table or the new one.

Rows are first written to a folder beside the table, which Spark marks as complete at the end. Then its
files are moved into the table. A run that dies before the mark leaves a folder that is thrown away; one
that dies after it leaves a folder whose moves the next run goes on with. One run at a time may write
a table. Readers that started before a move do not see it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..files import Files
from ..session import shuffles_removed

#: The staged files are added to the table's partitions; its partitions replace the table's; it replaces the table.
ADD, SWAP, TABLE = "add", "swap", "table"
_OLD = "old"
_COMPLETE = "_SUCCESS"
# Files of a fact are a quarter smaller than with snappy, for a few hundredths more CPU time.
_OPTIONS = {"compression": "zstd"}


def _staging(path: str) -> str:
    return f"{path.rstrip('/')}__staged"


def stage_write(df: DataFrame | Sequence[DataFrame], path: str, kind: str, partition_by: str | None = None) -> str:
    """Write rows beside the table; `publish` moves them in.

    Several frames are written one after the other, and the last one marks them all as complete.
    """
    frames = [df] if isinstance(df, DataFrame) else list(df)
    staged = f"{_staging(path)}/{kind}-{uuid.uuid4().hex}"
    for left, frame in zip(range(len(frames) - 1, -1, -1), frames, strict=True):
        writer = frame.write.mode("append").options(**_OPTIONS).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(left == 0).lower())
        with shuffles_removed(frame.sparkSession):
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(staged)
    return staged


def discard(spark: SparkSession, staged: str) -> None:
    Files(spark, staged).remove(staged)


def publish(spark: SparkSession, path: str, staged: str, only: set[str] | None = None) -> None:
    """Move a complete staged folder into the table. Each move may have been made before.

    `only` names the partition folders to be swapped; without it all are.
    """
    files, table = Files(spark, path), path.rstrip("/")
    kind, _, load = staged.rsplit("/", 1)[1].partition("-")
    if kind == TABLE:
        if files.exists(table):
            files.move(table, f"{_staging(path)}/{_OLD}-{load}")
        files.move(staged, table)
        files.remove(f"{_staging(path)}/{_OLD}-{load}")
        return
    files.make(table)
    if only is not None:
        for name, is_folder in files.names(staged):
            if is_folder and name not in only:
                files.remove(f"{staged}/{name}")
    for name, is_folder in files.names(staged):
        if name.startswith("_"):
            continue
        if kind == SWAP:
            files.remove(f"{table}/{name}")
            files.move(f"{staged}/{name}", f"{table}/{name}")
        elif is_folder:
            files.make(f"{table}/{name}")
            for part, _ in files.names(f"{staged}/{name}"):
                files.move(f"{staged}/{name}/{part}", f"{table}/{name}/{load}-{part}")
        else:
            files.move(f"{staged}/{name}", f"{table}/{load}-{name}")
    files.remove(staged)


def finish(spark: SparkSession, path: str) -> int:
    """Bring earlier writes of a table to their end: complete ones are published, others thrown away.

    Call it before the table is read for the next write. Returns the number of writes published.
    """
    files, staging = Files(spark, path), _staging(path)
    published = 0
    for name, _ in files.names(staging):
        if name.startswith(f"{_OLD}-"):
            continue
        if files.exists(f"{staging}/{name}/{_COMPLETE}"):
            publish(spark, path, f"{staging}/{name}")
            published += 1
        else:
            files.remove(f"{staging}/{name}")
    for name, _ in files.names(staging):  # tables that were replaced
        files.remove(f"{staging}/{name}")
    return published
