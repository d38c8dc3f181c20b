"""Profiles over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..functions.numbers import UNITS_TYPE, units
from ..operators.profiles import agent_profile, outer_totals, result_profile
from ..operators.rollup import additive_rollup, claims_rollup
from ..plans.facts import prepare_claim_payments
from ..plans.reports import INCOME
from .registry import query, table
from .standins import CLAIMS_SQL, OPERATIONS_SQL, day, operations, organizers, producers, raw_claim_payments


def profile_rows(spark, sf_dir):
    """Premium and claim contributions of the order lines.

    A line counts as premium in its order's month, and when returned as claim in the month it was
    shipped. Both come out of one join of lines and orders.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("NroAsegurado"), "o_orderdate")
    s = table(spark, sf_dir, "supplier")
    s = s.select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("CodOrganizador"))
    lines = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(s, li["l_suppkey"] == s["s_suppkey"])
    price = F.col("l_extendedprice")
    none = F.lit(None).cast(UNITS_TYPE)

    def contribution(date_col, premium, claim):
        return F.struct(
            month_start(day(date_col)).alias("FechaMes"), premium.alias("PrimaNeta"), claim.alias("ImporteSiniestro")
        )

    premium = contribution("o_orderdate", units(price * (1 - F.col("l_discount"))), none)
    claim = contribution("l_shipdate", none, units(price))
    returned = F.col("l_returnflag") == "R"
    each = F.when(returned, F.array(premium, claim)).otherwise(F.array(premium))
    return lines.select("NroAsegurado", "CodOrganizador", F.col("l_suppkey").alias("CodProductor"), F.inline(each))


def profile_persons(spark, sf_dir):
    """A hundred persons per thousand customers, so that several insured numbers are one person."""
    c = table(spark, sf_dir, "customer")
    key = F.expr("c_custkey DIV 10")
    return c.select(F.col("c_custkey").alias("NroPersona"), key.alias("persona_key"), F.col("c_name").alias("Nombre"))


@query(
    "result_profile",
    """
WITH premium AS (
  SELECT o_custkey, s_nationkey, l_suppkey, date_trunc('month', o_orderdate) AS m, SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS p
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
claims AS (
  SELECT o_custkey, s_nationkey, l_suppkey, date_trunc('month', l_shipdate) AS m, SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS c
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R' GROUP BY ALL),
both_sides AS (
  SELECT o_custkey, s_nationkey, l_suppkey, m, coalesce(p, 0) AS p, coalesce(c, 0) AS c
  FROM premium FULL OUTER JOIN claims USING (o_custkey, s_nationkey, l_suppkey, m)),
person AS (
  SELECT o_custkey // 10 AS persona_key, s_nationkey, l_suppkey, m, SUM(p) AS p, SUM(c) AS c
  FROM both_sides JOIN customer ON o_custkey = c_custkey GROUP BY ALL HAVING SUM(p) <> 0 OR SUM(c) <> 0),
named AS (SELECT c_custkey // 10 AS persona_key, max(c_name) AS Nombre FROM customer GROUP BY ALL)
SELECT persona_key, Nombre, CAST(person.s_nationkey AS BIGINT) AS CodOrganizador, n_name AS NomOrganizador, r_name AS GrupoOrganizador,
  l_suppkey AS CodProductor, s_name AS NomProductor, CAST(m AS DATE) AS FechaMes, CAST(year(m) AS INTEGER) AS "Año", CAST(month(m) AS INTEGER) AS Mes,
  CAST(p AS DOUBLE) AS PrimaNeta, CAST(p AS DOUBLE) AS PremioNeto, CAST(c AS DOUBLE) AS ImporteSiniestro, CAST(p - c AS DOUBLE) AS Resultado
FROM person JOIN named USING (persona_key) JOIN nation ON person.s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN supplier ON l_suppkey = s_suppkey
""",
)
def profile(spark, sf_dir):
    """Premium against claims per person, organizer, producer and month."""
    return result_profile(
        profile_rows(spark, sf_dir), profile_persons(spark, sf_dir), producers(spark, sf_dir),
        organizers(spark, sf_dir), [], ["PrimaNeta"], "ImporteSiniestro",
    )


@query(
    "outer_premium_claims",
    """
WITH p AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS premium
  FROM orders GROUP BY ALL),
c AS (SELECT o_custkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS claims
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT o_custkey, month, coalesce(premium, 0) AS premium, coalesce(claims, 0) AS claims FROM p FULL OUTER JOIN c USING (o_custkey, month)
""",
)
def outer_premium_claims(spark, sf_dir):
    """Two monthly rollups joined in full, with 0 for the missing side."""
    o = table(spark, sf_dir, "orders").withColumn("order_date", day("o_orderdate"))
    li = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").withColumn("ship_date", day("l_shipdate"))
    owner = o.select("o_orderkey", "o_custkey")
    paid = li.join(owner, li["l_orderkey"] == owner["o_orderkey"])
    premium = additive_rollup(o, "order_date", "month", ["o_custkey"], {"premium": "o_totalprice"})
    claims = additive_rollup(paid, "ship_date", "month", ["o_custkey"], {"claims": "l_extendedprice"})
    return outer_totals(premium, claims, ["o_custkey", "month"], ["premium", "claims"])


_INCOME = ["PrimaNeta", "RecAdm", "RecFin", "RecCapital"]


@query(
    "agent_profile",
    f"""
WITH {OPERATIONS_SQL}, {CLAIMS_SQL},
o AS (SELECT date_trunc('month', FEmision) AS m, CodRama, CodOrganizador, CodProductor, {', '.join(f'SUM(CAST({c} AS DECIMAL(18,4))) AS {c}' for c in _INCOME)}
  FROM operations GROUP BY ALL),
c AS (SELECT date_trunc('month', FechaPago) AS m, CodRama, CodOrganizador, CodProductor,
  SUM(CAST(Importe AS DECIMAL(18,4))) AS ImporteSiniestro, count(DISTINCT Siniestro) AS SiniestrosPagados
  FROM claims GROUP BY ALL),
d AS (SELECT date_trunc('month', l_shipdate) AS m, 4 AS CodRama, l_suppkey % 25 AS CodOrganizador, l_suppkey AS CodProductor, count(*) AS Denuncias
  FROM lineitem GROUP BY ALL),
j AS (SELECT * FROM o FULL OUTER JOIN c USING (m, CodRama, CodOrganizador, CodProductor) FULL OUTER JOIN d USING (m, CodRama, CodOrganizador, CodProductor))
SELECT CAST(year(m) AS INTEGER) AS "Año", CAST(month(m) AS INTEGER) AS Mes, CodRama, '' AS Rama, '' AS FullRama, r_name AS GrupoOrganizador,
  CodOrganizador, n_name AS NomOrganizador, CAST(CodOrganizador AS VARCHAR) || ' - ' || n_name AS FullOrganizador,
  CodProductor, s_name AS NomProductor, CAST(CodProductor AS VARCHAR) || ' - ' || s_name AS FullProductor,
  {', '.join(f'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}' for c in [*_INCOME, 'ImporteSiniestro'])},
  CAST({' + '.join(f'coalesce({c}, 0)' for c in _INCOME)} - coalesce(ImporteSiniestro, 0) AS DOUBLE) AS Resultado,
  CAST(coalesce(SiniestrosPagados, 0) AS BIGINT) AS SiniestrosPagados, CAST(coalesce(Denuncias, 0) AS BIGINT) AS Denuncias
FROM j LEFT JOIN nation ON CodOrganizador = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON CodProductor = s_suppkey
""",
)
def agents(spark, sf_dir):
    """Operations, claims paid and claim reports per month, branch, organizer and producer."""
    ops = operations(spark, sf_dir).withColumn("FechaMes", month_start("FEmision"))
    claims = prepare_claim_payments(raw_claim_payments(spark, sf_dir)).withColumnRenamed("Importe", "ImporteSiniestro")
    dims = ["CodRama", "CodOrganizador", "CodProductor"]  # a claim of two insured counts once
    paid = claims_rollup(claims, "FechaPago", "FechaMes", dims, "ImporteSiniestro", "Siniestro", "SiniestrosPagados")
    li = table(spark, sf_dir, "lineitem")
    reports = li.select(
        month_start(day("l_shipdate")).alias("FechaMes"),
        F.lit(4).cast("bigint").alias("CodRama"),
        (F.col("l_suppkey") % 25).alias("CodOrganizador"),
        F.col("l_suppkey").alias("CodProductor"),
        F.lit(1).alias("Denuncias"),
    )
    return agent_profile(
        ops, paid, reports, organizers(spark, sf_dir), producers(spark, sf_dir), INCOME, "ImporteSiniestro"
    )
