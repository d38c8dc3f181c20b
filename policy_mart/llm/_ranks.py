"""Row numbers within groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nested_offsets(df: DataFrame, levels: Sequence[str], before: str, rows: str) -> DataFrame:
    """Rows per cell of `levels`, and how many rows of the same first level stand before the cell.

    The levels nest: the first is the group, each further one orders the cells inside the one
    above. Every window holds the cells of one level only, never rows.
    """
    cells = df.groupBy(*levels).agg(F.count(F.lit(1)).alias(rows))
    out = cells
    for depth in range(len(levels) - 1, 0, -1):
        upper, own = list(levels[:depth]), levels[depth]
        sums = cells.groupBy(*upper, own).agg(F.sum(rows).alias("_llm_n")) if depth < len(levels) - 1 else (
            cells.withColumnRenamed(rows, "_llm_n")
        )
        w = Window.partitionBy(*upper).orderBy(own).rowsBetween(Window.unboundedPreceding, -1)
        part = sums.select(*upper, own, F.coalesce(F.sum("_llm_n").over(w), F.lit(0)).alias(f"_llm_before{depth}"))
        out = out.join(part, [*upper, own])
    total = sum((F.col(f"_llm_before{d}") for d in range(1, len(levels))), F.lit(0).cast("long"))
    return out.select(*levels, rows, total.alias(before))


def ranked(df: DataFrame, levels: Sequence[str], order: Sequence[Column | str], rank: str) -> DataFrame:
    """`df` with the rank, from 0, of each row in its group (`levels[0]`), in the order of the
    further levels and then of `order`. The columns of `levels` must not be null."""
    own = Window.partitionBy(*levels).orderBy(*order)
    cells = nested_offsets(df, levels, "_llm_before", "_llm_rows")
    return (
        df.withColumn("_llm_rn", F.row_number().over(own))
        .join(cells, list(levels))
        .withColumn(rank, F.col("_llm_before") + F.col("_llm_rn") - 1)
        .drop("_llm_before", "_llm_rows", "_llm_rn")
    )
