"""The loaders end to end: two runs over growing sources, with the fact and the rollups they leave."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import facts
from ..plans.mart import Mart
from ..schemas import CLAIM_REPORTS, LIFE_PREMIUMS, MOTOR_PREMIUMS, OPERATIONS, OTHER_PREMIUMS
from ..workdir import work_dir
from .loads import _LIFE_OUT, _MOTOR_OUT, _OPERATION_OUT, _OTHER_OUT
from .registry import query, table, totals
from .standins import (
    OPERATIONS_SQL,
    OTHER_PREMIUMS_SQL,
    PREMIUM_LINES_SQL,
    day,
    premium_lines,
    raw_operations,
    raw_other_premiums,
    with_missing,
)

_SINCE = dt.date(1900, 1, 1)  # before all rows


def _twice(spark, name, load, raw, key):
    """A mart after a run over the rows of even keys and one over all rows."""
    mart = Mart(spark, work_dir(spark, name))
    load(mart, raw.filter(F.col(key) % 2 == 0), _SINCE)
    load(mart, raw, _SINCE)
    return mart


@query("operations_runs", f"WITH {OPERATIONS_SQL} SELECT {', '.join(_OPERATION_OUT)} FROM operations")
def operations_runs(spark, sf_dir):
    mart = _twice(spark, "operations", facts.load_operations, raw_operations(spark, sf_dir), "M1OPER")
    return mart.table(OPERATIONS).select(*_OPERATION_OUT)


_INCOME = ["PrimaNeta", "RecAdm", "RecFin", "RecCapital", "BonifPrima", "PrimaTarifa", "PremioBruto"]


@query(
    "operations_runs_rollup",
    f"""
WITH {OPERATIONS_SQL}
SELECT CAST(date_trunc('month', FEmision) AS DATE) AS FEmisionMes, {', '.join(facts.OPERATION_PROFILE_DIMS)}, {totals(_INCOME)}, CAST(count(*) AS INTEGER) AS Cantidad
FROM operations GROUP BY ALL
""",
)
def operations_runs_rollup(spark, sf_dir):
    mart = _twice(spark, "operations-rollup", facts.load_operations, raw_operations(spark, sf_dir), "M1OPER")
    rollup = spark.read.parquet(mart.path("sehpm151t_perfiles_agg"))
    return rollup.select("FEmisionMes", *facts.OPERATION_PROFILE_DIMS, *_INCOME, "Cantidad")


@query(
    "claim_reports_runs",
    """
SELECT l_orderkey AS Op, CAST(l_linenumber AS BIGINT) AS Comp, l_partkey AS Siniestro, CAST(l_shipdate AS DATE) AS FechaDenuncia, l_suppkey AS CodProductor
FROM lineitem
""",
)
def claim_reports_runs(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("DPOPER"),
        F.col("l_linenumber").alias("DPPOCO"),
        F.col("l_partkey").alias("DCSINI"),
        day("l_shipdate").alias("FEDENU"),
        F.col("l_suppkey").alias("POPRO1"),
    )
    raw = with_missing(raw, facts.CLAIM_REPORT_COLUMNS)
    mart = _twice(spark, "claim-reports", facts.load_claim_reports, raw, "DPOPER")
    return mart.table(CLAIM_REPORTS).select("Op", "Comp", "Siniestro", "FechaDenuncia", "CodProductor")


@query("motor_premiums_runs", f"WITH {PREMIUM_LINES_SQL} SELECT {', '.join(_MOTOR_OUT)} FROM premium_lines")
def motor_premiums_runs(spark, sf_dir):
    raw = with_missing(premium_lines(spark, sf_dir), facts.MOTOR_PREMIUM_UNUSED)
    mart = _twice(spark, "motor", facts.load_motor_premiums, raw, "Op")
    return mart.table(MOTOR_PREMIUMS).select(*_MOTOR_OUT)


@query("other_premiums_runs", f"WITH {OTHER_PREMIUMS_SQL} SELECT {', '.join(_OTHER_OUT)} FROM other_premiums")
def other_premiums_runs(spark, sf_dir):
    mart = _twice(spark, "other", facts.load_other_premiums, raw_other_premiums(spark, sf_dir), "Op")
    return mart.table(OTHER_PREMIUMS).select(*_OTHER_OUT)


@query(
    "life_premiums_runs",
    f"""
WITH {OTHER_PREMIUMS_SQL}
SELECT FEmision, Op, Supl, Comp, CodCobertura, CodProvincia, SaCobertura AS SaSupl, PrimaNetaCobertura FROM other_premiums
""",
)
def life_premiums_runs(spark, sf_dir):
    raw = raw_other_premiums(spark, sf_dir).withColumnsRenamed(
        {"SaCobertura": "SaSupl", "PrimaCoberturaEmitida": "PrimaTarifaCobertura", "PrimaCoberturaNeta": "PrimaNetaCobertura"}
    )
    raw = raw.withColumn("BonPrimaPctSupl", F.lit(0.0))
    mart = _twice(spark, "life", facts.load_life_premiums, raw, "Op")
    return mart.table(LIFE_PREMIUMS).select(*_LIFE_OUT)
