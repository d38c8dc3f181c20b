"""Rollups and statistics over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.numbers import half_even
from ..operators.rollup import additive_rollup, claims_rollup, control_row, finished, merge_states, rollup_states
from ..operators.stats import best_by_metric, daily_monthly_summary
from ..plans import facts
from ..plans.mart import Mart
from ..plans.reports import monthly_vehicle_counts
from ..schemas import MOTOR_PREMIUMS, OTHER_PREMIUMS, SNAPSHOTS
from ..sources.readers import cast_to
from ..workdir import work_dir
from .registry import names, query, table, total, totals
from .standins import (
    OPERATIONS_SQL,
    OTHER_PREMIUMS_SQL,
    PREMIUM_LINES_SQL,
    day,
    operations,
    premium_lines,
    raw_other_premiums,
    with_missing,
)


@query(
    "monthly_premium_rollup",
    f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, s_nationkey, l_suppkey, l_returnflag,
  {total('l_extendedprice', 'gross')}, {total('l_extendedprice * (1 - l_discount)', 'net')}, {total('l_quantity', 'quantity')}, count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL
""",
)
def monthly_premium_rollup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    o = table(spark, sf_dir, "orders").select("o_orderkey", day("o_orderdate").alias("order_date"))
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    sums = {"gross": "l_extendedprice", "net": "net", "quantity": "l_quantity"}
    by_supplier = additive_rollup(
        rows, "order_date", "month", ["l_suppkey", "l_returnflag"], sums, extra={"lines": F.count(F.lit(1))}
    )
    # A supplier has one nation, so it is looked up on the sums and not on every line.
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return by_supplier.join(s, "l_suppkey")


_MOTOR_DIMS = names(facts.MOTOR_ROLLUP_DIMS)


@query(
    "motor_premium_rollup",
    f"""
WITH {PREMIUM_LINES_SQL}
SELECT CAST(date_trunc('month', FEmision) AS DATE) AS FEmisionMes, {_MOTOR_DIMS}, {totals(facts.MOTOR_ROLLUP_SUMS)}
FROM premium_lines GROUP BY ALL
""",
)
def motor_premium_rollup(spark, sf_dir):
    """Motor premiums by month and 18 more columns."""
    return facts.motor_premiums_rollup(cast_to(premium_lines(spark, sf_dir), MOTOR_PREMIUMS.schema))


@query(
    "value_bucket_rollup",
    f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag, round_even(l_extendedprice / 10000, 0) AS bucket,
  {total('l_extendedprice', 'amount')}, min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest
FROM lineitem GROUP BY ALL
""",
)
def value_bucket_rollup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("ship_date", day("l_shipdate"))
    price = F.col("l_extendedprice")
    return additive_rollup(
        li, "ship_date", "month", ["l_returnflag"], {"amount": "l_extendedprice"},
        buckets={"bucket": half_even(price / 10000)}, extra={"lowest": F.min(price), "highest": F.max(price)},
    )


_OTHER_DIMS = names(facts.OTHER_ROLLUP_DIMS)


@query(
    "reinsurance_rollup",
    f"""
WITH {OTHER_PREMIUMS_SQL}
SELECT CAST(date_trunc('month', FEmision) AS DATE) AS FEmisionMes, {_OTHER_DIMS}, round_even(SaCobertura / 1000000, 0) AS SaCoberturaMillones,
  {total('SaCobertura', 'SaCoberturaSuma')}, min(SaCobertura) AS SaCoberturaMin, max(SaCobertura) AS SaCoberturaMax,
  {totals(['PrimaTarifaCobertura', 'PrimaNetaCobertura'])}
FROM other_premiums GROUP BY ALL
""",
)
def reinsurance_rollup(spark, sf_dir):
    """Other-branch premiums by insured sum in millions, rounded half to even."""
    rows = facts.prepare_other_premiums(raw_other_premiums(spark, sf_dir))
    return facts.other_premiums_rollup(cast_to(rows, OTHER_PREMIUMS.schema))


_SUMS = ["PrimaNeta", "RecFin", "RecAdm", "BonifPrima", "RecCapital", "PrimaTarifa", "PremioBruto"]


def _operations_sql(dims: list[str]) -> str:
    return f"""
WITH {OPERATIONS_SQL}
SELECT CAST(date_trunc('month', FEmision) AS DATE) AS FEmisionMes, {names(dims)}, {totals(_SUMS)},
  CAST(trunc(SUM(CAST(SumaAsegurada AS DECIMAL(18,4))) / 1000000) AS INTEGER) AS SumaAseguradaMillones, CAST(count(*) AS INTEGER) AS Cantidad
FROM operations GROUP BY ALL"""


def _operations_out(rollup, dims):
    return rollup.select("FEmisionMes", *dims, *_SUMS, "SumaAseguradaMillones", "Cantidad")


@query("operations_rollup", _operations_sql(facts.OPERATION_DIMS))
def operations_rollup(spark, sf_dir):
    return _operations_out(facts.operations_rollup(operations(spark, sf_dir)), facts.OPERATION_DIMS)


@query("operations_profile_rollup", _operations_sql(facts.OPERATION_PROFILE_DIMS))
def operations_profile_rollup(spark, sf_dir):
    return _operations_out(facts.operations_profile_rollup(operations(spark, sf_dir)), facts.OPERATION_PROFILE_DIMS)


@query(
    "claims_distinct_rollup",
    f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, o_custkey, {total('l_extendedprice', 'l_extendedprice')}, count(DISTINCT l_orderkey) AS claims
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY ALL
""",
)
def claims_distinct_rollup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").withColumn("ship_date", day("l_shipdate"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return claims_rollup(rows, "ship_date", "month", ["o_custkey"], "l_extendedprice", "l_orderkey", "claims")


@query(
    "rollup_merge",
    f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_suppkey, {total('l_extendedprice', 'amount')}, count(*) AS lines
FROM lineitem GROUP BY ALL
""",
)
def rollup_merge(spark, sf_dir):
    """Stored rollups of returned and of other lines add up to the rollup of all."""
    li = table(spark, sf_dir, "lineitem").withColumn("ship_date", day("l_shipdate"))

    def partial(rows):
        extra = {"lines": F.count(F.lit(1))}
        return rollup_states(rows, "ship_date", "month", ["l_suppkey"], {"amount": "l_extendedprice"}, extra=extra)

    parts = partial(li.filter("l_returnflag = 'R'")).unionByName(partial(li.filter("l_returnflag <> 'R'")))
    return finished(merge_states(parts, ["month", "l_suppkey"], ["amount"], ["lines"]), ["amount"])


_SUMMARY_SQL = """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL),
r AS (SELECT *, year(day) * 100 + month(day) AS m,
  row_number() OVER (PARTITION BY year(day), month(day) ORDER BY n DESC, day) AS hi,
  row_number() OVER (PARTITION BY year(day), month(day) ORDER BY n, day) AS lo FROM d),
g AS (SELECT CAST(m AS INTEGER) AS Mes, max(CASE WHEN hi = 1 THEN day END) AS maxFecha, max(n) AS Maximo,
  max(CASE WHEN lo = 1 THEN day END) AS minFecha, min(n) AS Minimo, count(*) AS Dias, round_even(avg(n), 0) AS Promedio,
  max(n) - min(n) AS Gap, round_even(stddev_pop(n), 0) AS Std, CAST(quantile_cont(n, 0.25) AS DOUBLE) AS Q1,
  CAST(quantile_cont(n, 0.5) AS DOUBLE) AS Q2, CAST(quantile_cont(n, 0.75) AS DOUBLE) AS Q3 FROM r GROUP BY m)
SELECT *, CASE WHEN Q2 < Promedio THEN 'D' WHEN Q2 > Promedio THEN 'I' ELSE 'N' END AS Cola FROM g
"""


@query(
    "daily_monthly_summary",
    _SUMMARY_SQL,
)
def daily_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(day("o_orderdate").alias("order_date"))
    return daily_monthly_summary(o, "order_date")


@query(
    "best_segment_by_sales",
    """
WITH s AS (SELECT c_nationkey, c_mktsegment, SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS sales
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_nationkey, c_mktsegment FROM
  (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY sales DESC, c_mktsegment) AS rn FROM s) WHERE rn = 1
""",
)
def best_segment_by_sales(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"])
    return best_by_metric(rows, ["c_nationkey"], "c_mktsegment", "o_totalprice")


@query(
    "best_postal_suffix",
    f"""
WITH {OPERATIONS_SQL},
s AS (SELECT ProvinciaAsegurado, CpAsegurado, CpSufijoAsegurado, SUM(CAST(PrimaNeta AS DECIMAL(18,4))) AS prima
  FROM operations WHERE CodTipoOp <= 2 GROUP BY ALL)
SELECT ProvinciaAsegurado AS Provincia, CpAsegurado AS Cp, CAST(CpSufijoAsegurado AS BIGINT) AS CpSufijo FROM
  (SELECT *, row_number() OVER (PARTITION BY ProvinciaAsegurado, CpAsegurado ORDER BY prima DESC, CpSufijoAsegurado) AS rn FROM s) WHERE rn = 1
""",
)
def best_postal_suffix(spark, sf_dir):
    rows = operations(spark, sf_dir).filter("CodTipoOp <= 2")
    best = best_by_metric(rows, ["ProvinciaAsegurado", "CpAsegurado"], "CpSufijoAsegurado", "PrimaNeta")
    return best.select(
        F.col("ProvinciaAsegurado").alias("Provincia"),
        F.col("CpAsegurado").alias("Cp"),
        F.col("CpSufijoAsegurado").cast("bigint").alias("CpSufijo"),
    )


@query(
    "control_row",
    """
WITH m AS (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS m, o_orderstatus FROM orders)
SELECT min(m) AS min_fact, max(m) AS max_fact, count(DISTINCT m) AS months_fact,
  min(m) FILTER (o_orderstatus = 'F') AS min_rollup, max(m) FILTER (o_orderstatus = 'F') AS max_rollup,
  count(DISTINCT m) FILTER (o_orderstatus = 'F') AS months_rollup FROM m
""",
)
def control(spark, sf_dir):
    """All orders against a rollup that has only the finished ones."""
    o = table(spark, sf_dir, "orders").withColumn("order_date", day("o_orderdate"))
    done = o.filter("o_orderstatus = 'F'")
    rollup = additive_rollup(done, "order_date", "month", ["o_custkey"], ["o_totalprice"])
    return control_row(o, "order_date", rollup, "month")


@query("monthly_vehicle_counts", _SUMMARY_SQL)
def monthly_counts(spark, sf_dir):
    """Orders as daily snapshots in two loads; the report reads the counts per day that the loads keep."""
    mart = Mart(spark, work_dir(spark, "snapshots"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Poliza"), day("o_orderdate").alias("Fecha"))
    raw = with_missing(o, SNAPSHOTS.columns)
    span = o.agg(F.min("Fecha").alias("first"), F.max("Fecha").alias("last")).first()
    today = span["last"] + dt.timedelta(days=1)
    facts.load_vehicle_snapshots(mart, raw.filter(F.dayofmonth("Fecha") % 2 == 0), today, span["first"])
    facts.load_vehicle_snapshots(mart, raw, today, span["first"])
    return monthly_vehicle_counts(mart)
