"""Rates, age bands and premiums by risk over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.dates import yyyymm
from ..functions.numbers import money_sum
from ..operators.controls import missing_matches, missing_summary
from ..operators.rates import BASE_COVERAGES, RISKS, decompose_rates, rate_band_join
from ..operators.scd import current_rows
from ..plans import reports
from ..plans.dims import RATE_VALUES, prepare_rates
from ..schemas import RATES
from .registry import query, table, total
from .standins import (
    day,
    COVERAGE_FLAGS_SQL,
    CURRENT_RATES_SQL,
    PREMIUM_LINES_SQL,
    VEHICLES_SQL,
    coverage_flags,
    premium_lines,
    raw_rates,
    vehicles,
)

_SNAPSHOT_DAY = dt.date(2002, 1, 1)
_DAYS = 3 * 366


def current_rates(spark, sf_dir):
    history = prepare_rates(raw_rates(spark, sf_dir))
    return current_rows(history, RATES.keys, "fecha_desde", *RATE_VALUES)


def rates_by_risk(spark, sf_dir):
    return decompose_rates(current_rates(spark, sf_dir), coverage_flags(spark, sf_dir))


def _pivot_sql(where: str = "") -> str:
    cells = [f"coalesce(max(TasaAnual) FILTER (CodCobertura = '{c}'), 0) AS x{c}" for c in BASE_COVERAGES]
    return f"{', '.join(cells)} FROM current_rates {where}"


# The two grains are pivoted separately here, as an independent check of the derived pivot.
_RISKS_SQL = f"""
{CURRENT_RATES_SQL}, {COVERAGE_FLAGS_SQL},
coarse AS (SELECT NumTarifa, Cap, Air, {_pivot_sql("WHERE CodCobertura NOT LIKE 'D%'")} GROUP BY ALL),
fine AS (SELECT NumTarifa, Cap, Air, segmento_ant, {_pivot_sql()} GROUP BY ALL),
base AS (SELECT r.*, {', '.join(f'greatest(coalesce(f.x{c}, 0), coalesce(k.x{c}, 0)) AS {c}' for c in BASE_COVERAGES)},
    {', '.join(f'coalesce(g.{r}, 0) AS f{r}' for r in ('Rt', 'It', 'Rp', 'Ip', 'At'))}
  FROM current_rates r LEFT JOIN fine f USING (NumTarifa, Cap, Air, segmento_ant) LEFT JOIN coarse k USING (NumTarifa, Cap, Air)
    LEFT JOIN coverage_flags g USING (CodCobertura) WHERE TasaAnual BETWEEN 0.01 AND 998),
s1 AS (SELECT *, B4 * fIt AS TasaIt FROM base),
s2 AS (SELECT *, greatest(least(TasaAnual - TasaIt, B5), 0) * fRt AS TasaRt FROM s1),
s3 AS (SELECT *, greatest(least(TasaAnual - TasaRt - TasaIt, C2 - C5 - C4), 0) * fAt AS TasaAt FROM s2),
s4 AS (SELECT *, greatest(least(TasaAnual - TasaRt - TasaIt - TasaAt, C4 - B4), 0) * fIp AS TasaIp FROM s3),
s5 AS (SELECT *, greatest(least(TasaAnual - TasaRt - TasaIt - TasaAt - TasaIp, C5 - B5), 0) * fRp AS TasaRp FROM s4),
risks AS (SELECT NumTarifa, Cap, Air, segmento_ant, AntMinima, AntMaxima, CodCobertura, TasaAnual,
    CASE WHEN least(C2, C4, C5, B4, B5) > 0 THEN 1 ELSE 0 END AS Habilitado, TasaIt, TasaRt, TasaAt, TasaIp, TasaRp,
    greatest(TasaAnual - TasaRt - TasaIt - TasaAt - TasaIp - TasaRp, 0) AS TasaAp FROM s5)"""

@query(
    "rate_decomposition",
    f"""
WITH {_RISKS_SQL}
SELECT * FROM risks
""",
)
def rate_decomposition(spark, sf_dir):
    return rates_by_risk(spark, sf_dir)


@query(
    "rate_band_join",
    f"""
WITH {PREMIUM_LINES_SQL}, {CURRENT_RATES_SQL}
SELECT l.Op, l.Comp, l.Supl, l.Ant, r.NumTarifa, r.Cap, r.CodCobertura, r.segmento_ant, r.TasaAnual
FROM premium_lines l JOIN current_rates r ON r.NumTarifa = l.TarifaHija AND r.Cap = l.Cap AND r.CodCobertura = l.CodCoberturaAut
  AND l.Ant BETWEEN r.AntMinima AND r.AntMaxima
""",
)
def band_join(spark, sf_dir):
    """Every order line with the rate of its tariff, chapter, coverage and age (its quantity)."""
    lines = premium_lines(spark, sf_dir).select(
        "Op", "Comp", "Supl", "Ant", F.col("TarifaHija").alias("NumTarifa"), "Cap",
        F.col("CodCoberturaAut").alias("CodCobertura"),
    )
    bands = current_rates(spark, sf_dir).drop("Air", "fecha_desde")
    joined = rate_band_join(lines, bands, ["NumTarifa", "Cap", "CodCobertura"], "Ant", "AntMinima", "AntMaxima")
    return joined.select("Op", "Comp", "Supl", "Ant", "NumTarifa", "Cap", "CodCobertura", "segmento_ant", "TasaAnual")


def _vehicle_premiums(spark, sf_dir):
    insured = reports.vehicles_in_force(vehicles(spark, sf_dir), _SNAPSHOT_DAY)
    premiums = reports.component_premiums(premium_lines(spark, sf_dir), _SNAPSHOT_DAY, _DAYS)
    return insured, premiums


_VEHICLE_PREMIUMS_SQL = f"""
{VEHICLES_SQL},
recent AS (SELECT * FROM premium_lines WHERE FEmision BETWEEN DATE '2002-01-01' - {_DAYS} AND DATE '2002-01-01'),
premiums AS (
  SELECT CodRama, Poliza, Comp, Cap, Var, Air, SaComponente AS Sa, PrimaNeta FROM (
    SELECT *, row_number() OVER w AS rn, CAST(SUM(CAST(PrimaCascoNetaComp AS DECIMAL(18,4))) OVER (PARTITION BY CodRama, Poliza, Comp) AS DOUBLE) AS PrimaNeta
    FROM recent WINDOW w AS (PARTITION BY CodRama, Poliza, Comp ORDER BY Supl DESC, FEmision DESC, Op DESC, Cap DESC, Var DESC, Air DESC, SaComponente DESC))
  WHERE rn = 1),
vehicle_premiums AS (
  SELECT CASE WHEN NumTarifa = 0 THEN 11 ELSE NumTarifa END AS NumTarifa, CodRama, Poliza, Comp, CodCobertura, Ant, CvaCapitulo, CvaVariante,
    Cap, Var, Air, Sa, PrimaNeta FROM vehicles JOIN premiums USING (CodRama, Poliza, Comp))"""

@query(
    "risk_proration",
    f"""
WITH {_VEHICLE_PREMIUMS_SQL}, {_RISKS_SQL},
split AS (
  SELECT v.NumTarifa, v.CodRama, v.Poliza, v.Comp, v.CodCobertura, v.Ant, v.Sa, v.PrimaNeta, r.TasaAnual,
    {', '.join(f'r.Tasa{x} * v.PrimaNeta / nullif(r.TasaAnual, 0) AS "{x}"' for x in RISKS)}
  FROM vehicle_premiums v JOIN risks r USING (NumTarifa, Cap, Air, CodCobertura)
  WHERE v.Ant BETWEEN r.AntMinima AND r.AntMaxima AND r.TasaAnual BETWEEN 0.5 AND 998.9),
sums AS (SELECT *, Rt + It + "At" AS Total, Rp + Ip + Ap AS Parcial, Rt + Rp AS Robo, It + Ip AS Incendio, "At" + Ap AS Accidente FROM split)
SELECT * FROM sums
""",
)
def risk_proration(spark, sf_dir):
    """The premium of the vehicles in force, split by risk."""
    insured, premiums = _vehicle_premiums(spark, sf_dir)
    rates = reports.usable_rates(rates_by_risk(spark, sf_dir))
    return reports.risk_premiums(reports.vehicles_with_premiums(insured, premiums), rates)


@query(
    "vehicles_without_premium",
    f"""
WITH {_VEHICLE_PREMIUMS_SQL}
SELECT NumTarifa, CodRama, Poliza, Comp, CodCobertura, Ant, CvaCapitulo, CvaVariante FROM vehicles v
WHERE NOT EXISTS (SELECT 1 FROM premiums p WHERE p.CodRama = v.CodRama AND p.Poliza = v.Poliza AND p.Comp = v.Comp)
""",
)
def vehicles_without_premium(spark, sf_dir):
    return reports.vehicles_without_premium(*_vehicle_premiums(spark, sf_dir))


@query(
    "premiums_without_rate",
    f"""
WITH {_VEHICLE_PREMIUMS_SQL}, {_RISKS_SQL}
SELECT * FROM vehicle_premiums v WHERE NOT EXISTS (SELECT 1 FROM risks r WHERE r.TasaAnual BETWEEN 0.5 AND 998.9
  AND r.NumTarifa = v.NumTarifa AND r.Cap = v.Cap AND r.Air = v.Air AND r.CodCobertura = v.CodCobertura)
""",
)
def premiums_without_rate(spark, sf_dir):
    rows = reports.vehicles_with_premiums(*_vehicle_premiums(spark, sf_dir))
    return reports.premiums_without_rate(rows, reports.usable_rates(rates_by_risk(spark, sf_dir)))


@query(
    "missing_matches",
    """
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS mes FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND date_trunc('month', o_orderdate) = date_trunc('month', l_shipdate))
""",
)
def missing(spark, sf_dir):
    """Lines without an order of theirs in the month they were shipped."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", yyyymm(day("l_shipdate")).alias("mes"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), yyyymm(day("o_orderdate")).alias("mes"))
    return missing_matches(lines, orders, ["l_orderkey", "mes"])


@query(
    "missing_summary",
    """
SELECT count(*) AS Faltantes, CAST(1 AS BIGINT) AS mostrados, CAST(1 AS BIGINT) AS mostrados_que_faltan FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND date_trunc('month', o_orderdate) = date_trunc('month', l_shipdate))
""",
)
def summary(spark, sf_dir):
    """How many are missing, and one of them at random, which is looked up among the missing again."""
    found = missing(spark, sf_dir)
    keys = ["l_orderkey", "l_linenumber", "mes"]
    shown = missing_summary(found, seed=7)
    known = shown.join(found.select(*keys).distinct().withColumn("falta", F.lit(1)), keys, "left")
    return known.agg(
        F.max("Faltantes").alias("Faltantes"), F.count(F.lit(1)).alias("mostrados"), F.count("falta").alias("mostrados_que_faltan")
    )


@query(
    "bands_of_any_width",
    f"""
WITH bands AS (SELECT n_nationkey AS band, n_regionkey AS k, CASE WHEN n_nationkey % 5 = 3 THEN NULL ELSE n_nationkey * 1000 END AS lo,
  CASE n_nationkey % 5 WHEN 0 THEN n_nationkey * 1000 + 50 WHEN 1 THEN 9999999 WHEN 2 THEN NULL WHEN 3 THEN n_nationkey * 4000 ELSE n_nationkey * 1000 + 20000 END AS hi
  FROM nation)
SELECT band, count(*) AS lines, {total('l_extendedprice', 'amount')} FROM lineitem JOIN bands
  ON l_suppkey % 5 = k AND (lo IS NULL OR l_extendedprice >= lo) AND (hi IS NULL OR l_extendedprice <= hi) GROUP BY ALL
""",
)
def bands_of_any_width(spark, sf_dir):
    """Lines and amounts per band: narrow, wide, up to ten million, and open at either end."""
    key = F.col("n_nationkey")
    kind = key % 5
    bands = table(spark, sf_dir, "nation").select(
        key.alias("band"),
        F.col("n_regionkey").cast("bigint").alias("k"),
        F.when(kind != 3, key * 1000).alias("lo"),
        F.when(kind == 0, key * 1000 + 50).when(kind == 1, 9999999).when(kind == 3, key * 4000).when(kind == 4, key * 1000 + 20000).alias("hi"),
    )
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 5).cast("bigint").alias("k"), "l_extendedprice")
    found = rate_band_join(lines, bands, ["k"], "l_extendedprice", "lo", "hi", bin_width=100, open_ends=True)
    return found.groupBy("band").agg(F.count(F.lit(1)).alias("lines"), money_sum("l_extendedprice").alias("amount"))
