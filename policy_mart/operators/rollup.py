"""Monthly rollups: build, merge partial ones, and compare one with its fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start, yyyymm
from ..functions.numbers import merged_state, money_state, money_sum, or_zero_money, state_amount


def additive_rollup(
    df: DataFrame,
    date_col: str,
    month_col: str,
    dims: Sequence[str],
    sums: Mapping[str, str] | Sequence[str],
    buckets: Mapping[str, Column] | None = None,
    extra: Mapping[str, Column] | None = None,
    fine: Sequence[str] = (),
) -> DataFrame:
    """Sums per month, dimensions and value buckets.

    `sums` maps output names to columns (or lists columns that keep their names), `buckets` adds
    computed grouping columns, and `extra` adds further aggregates such as counts or extremes. The
    sum of nothing but nulls is 0. `fine` says that groups are about as many as rows: summing before the
    shuffle would then only hold all rows in memory and send wider ones. It names dimensions, no floating
    ones, by which a month's rows are cut into ranges. The result is ready to be written by month.
    """
    measures = {n: or_zero_money(money_sum(c)) for n, c in _named(sums).items()}
    return _rollup(df, date_col, month_col, dims, measures, buckets, extra, fine)


def _named(sums: Mapping[str, str] | Sequence[str]) -> dict[str, str]:
    return dict(sums) if isinstance(sums, Mapping) else {c: c for c in sums}


def _rollup(
    df: DataFrame, date_col: str, month_col: str, dims: Sequence[str], measures: Mapping[str, Column],
    buckets: Mapping[str, Column] | None, extra: Mapping[str, Column] | None, fine: Sequence[str] = (),
) -> DataFrame:
    month = month_start(date_col).alias(month_col)
    groups = [*[F.col(d) for d in dims], *[c.alias(n) for n, c in (buckets or {}).items()]]
    aggregates = [c.alias(n) for n, c in {**measures, **(extra or {})}.items()]
    if fine:
        # Ranges hold about as many rows each, however large a month is, and divide no group. Spark samples
        # the rows for their ends and joins small ones, so few rows give few files.
        ranges = df.withColumn(_MONTH, month).repartitionByRange(_MONTH, *fine)
        return ranges.groupBy(F.col(_MONTH).alias(month_col), *groups).agg(*aggregates)
    return df.groupBy(month, *groups).agg(*aggregates)


_MONTH = "__month"


def rollup_states(
    df: DataFrame,
    date_col: str,
    month_col: str,
    dims: Sequence[str],
    sums: Mapping[str, str] | Sequence[str],
    buckets: Mapping[str, Column] | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A rollup to be stored in parts: like `additive_rollup`, with states in place of amounts."""
    measures = {n: money_state(c) for n, c in _named(sums).items()}
    return _rollup(df, date_col, month_col, dims, measures, buckets, extra)


def claims_rollup(
    claims: DataFrame, date_col: str, month_col: str, dims: Sequence[str], amount: str, claim: str,
    paid: str = "siniestros_pagados", fine: Sequence[str] = (),
) -> DataFrame:
    """Amount and number of different claims per month and dimensions.

    The distinct count is not additive: recompute touched months from the fact, never add it up.
    Spark groups by (dims, claim) first, so one hot group is spread over its claims; `fine` is as in
    `additive_rollup`, for dimensions of few claims each.
    """
    return additive_rollup(
        claims, date_col, month_col, dims, [amount], extra={paid: F.count_distinct(F.col(claim))}, fine=fine
    )


def merge_states(parts: DataFrame, keys: Sequence[str], states: Sequence[str], counts: Sequence[str] = ()) -> DataFrame:
    """Add up the rows of stored rollups that share a key. The result is a stored rollup itself."""
    added = [merged_state(c).alias(c) for c in states] + [F.sum(c).cast("bigint").alias(c) for c in counts]
    return parts.groupBy(*keys).agg(*added)


def finished(stored: DataFrame, states: Sequence[str]) -> DataFrame:
    """A merged rollup with amounts in place of states: what `additive_rollup` gives for all rows at once."""
    return stored.withColumns({c: or_zero_money(state_amount(c)) for c in states})


def control_row(fact: DataFrame, fact_date: str, rollup: DataFrame, rollup_date: str) -> DataFrame:
    """One row: first month, last month and number of months of a fact and of its rollup."""

    def months(df: DataFrame, date_col: str, side: str) -> DataFrame:
        m = df.select(yyyymm(date_col).alias("m"))
        return m.agg(
            F.min("m").alias(f"min_{side}"),
            F.max("m").alias(f"max_{side}"),
            F.count_distinct("m").alias(f"months_{side}"),
        )

    both = months(fact, fact_date, "fact").unionByName(
        months(rollup, rollup_date, "rollup"), allowMissingColumns=True
    )
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
