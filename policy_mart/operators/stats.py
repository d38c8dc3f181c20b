"""Two-level statistics: daily counts summed up by month, and the best candidate of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import yyyymm
from ..functions.numbers import half_even, money_sum, or_zero_money


def daily_monthly_summary(df: DataFrame, date_col: str) -> DataFrame:
    """`monthly_summary` of the number of rows per day."""
    return monthly_summary(daily_counts(df, date_col, "__n"), date_col, "__n")


def daily_counts(df: DataFrame, date_col: str, count: str) -> DataFrame:
    return df.groupBy(date_col).agg(F.count(F.lit(1)).alias(count))


def monthly_summary(daily: DataFrame, date_col: str, count: str) -> DataFrame:
    """Per month: extremes of the daily counts with their days, mean, spread and quartiles.

    `daily` has a row per day. On equal counts the earliest day is named. A month has at most 31 daily
    counts, so the exact percentile is cheap. `Cola` compares the median with the rounded mean: D below,
    I above, N equal.
    """
    daily = daily.select(F.col(date_col).alias("__day"), F.col(count).alias("__n"))
    age = -F.datediff("__day", F.lit("1970-01-01").cast("date"))
    quartiles = F.percentile("__n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    monthly = daily.groupBy(yyyymm("__day").alias("Mes")).agg(
        F.max_by("__day", F.struct(F.col("__n"), age)).alias("maxFecha"),
        F.max("__n").alias("Maximo"),
        F.min_by("__day", F.struct(F.col("__n"), -age)).alias("minFecha"),
        F.min("__n").alias("Minimo"),
        F.count(F.lit(1)).alias("Dias"),
        half_even(F.avg("__n")).alias("Promedio"),
        half_even(F.stddev_pop("__n")).alias("Std"),
        quartiles.alias("__q"),
    )
    q2 = F.col("__q")[1]
    return monthly.select(
        "Mes", "maxFecha", "Maximo", "minFecha", "Minimo", "Dias", "Promedio",
        (F.col("Maximo") - F.col("Minimo")).alias("Gap"),
        "Std",
        F.col("__q")[0].alias("Q1"),
        q2.alias("Q2"),
        F.col("__q")[2].alias("Q3"),
        F.when(q2 < F.col("Promedio"), "D").when(q2 > F.col("Promedio"), "I").otherwise("N").alias("Cola"),
    )


def best_by_metric(df: DataFrame, groups: Sequence[str], candidate: str, metric: str) -> DataFrame:
    """For each group the candidate with the highest total; the lowest candidate wins a tie."""
    totals = df.groupBy(*groups, candidate).agg(or_zero_money(money_sum(metric)).alias("__total"))
    # min_by on the negated total: among equal totals the struct then orders by candidate.
    best = F.min_by(candidate, F.struct(-F.col("__total"), F.col(candidate)))
    return totals.groupBy(*groups).agg(best.alias(candidate))
