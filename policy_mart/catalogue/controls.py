"""Controls and case enrichment over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.controls import (
    INTERMEDIARIES,
    client_updates,
    compare_commissions,
    enrich_case_producers,
    enrich_cases,
    producer_updates,
)
from ..plans.reports import operations_without_commission
from ..sources.keyed_table import KeyedTable
from ..sources.writers import stage
from ..workdir import work_dir
from .registry import query, table
from .standins import OPERATIONS_SQL, day, operations, organizers, producers


@query(
    "commission_control",
    f"""
WITH {OPERATIONS_SQL}
SELECT FEmision, Op, CAST(CodRama AS BIGINT) AS CodRama, Poliza, Suplemento, CodProductor, PrimaNeta, round("%Bonif.", 6) AS pct FROM (
  SELECT *, BonifPrima * 100 / nullif(PrimaTarifa, 0) AS "%Bonif." FROM operations) o
WHERE CodRama = 4 AND CodProductor <> 9999 AND PrimaNeta <> 0 AND "%Bonif." < 10
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.Op AND l_linenumber = 4)
""",
)
def commission_control(spark, sf_dir):
    """Motor operations whose order has no line 4, which stands for the commission row."""
    ops = operations(spark, sf_dir).withColumn("CodProductorCom", F.col("CodProductor"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ICOPER"), F.lit(0).cast("bigint").alias("ICSUOP"), F.col("l_linenumber").alias("ICTINT")
    )
    found = operations_without_commission(ops, rows)
    return found.select(
        "FEmision", "Op", F.col("CodRama").cast("bigint").alias("CodRama"), "Poliza", "Suplemento", "CodProductor",
        "PrimaNeta", F.round(F.col("`%Bonif.`"), 6).alias("pct"),
    )


@query(
    "commission_comparison",
    """
WITH listed AS (SELECT CASE WHEN o_orderpriority < '3' THEN 1030 ELSE 1040 END AS cod_ramo_ssn, CASE WHEN o_orderpriority < '3' THEN 4 ELSE 44 END AS cod_rama,
    o_orderkey AS nro_poliza FROM orders),
ops AS (SELECT CASE WHEN l_returnflag = 'A' THEN 4 ELSE 44 END AS cod_rama, l_orderkey AS nro_poliza, l_suppkey % 25 AS cod_org, l_suppkey AS cod_prod,
    l_extendedprice AS prima_tarifa, l_extendedprice * l_discount AS bon_prima, CASE WHEN l_tax = 0 THEN 0 ELSE l_extendedprice END AS prima_neta,
    l_extendedprice * l_discount AS com_org, l_extendedprice * l_tax AS com_prod FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-06-01')
SELECT cod_ramo_ssn, cod_rama, nro_poliza, prima_tarifa, bon_prima, prima_neta, cod_org, n_name AS nom_org, cod_prod, s_name AS nom_prod,
  com_org, round(com_org * 100 / nullif(prima_neta, 0), 6) AS "%com_org", com_prod, round(com_prod * 100 / nullif(prima_neta, 0), 6) AS "%com_prod",
  com_org + com_prod AS com_total, round((com_org + com_prod) * 100 / nullif(prima_neta, 0), 6) AS "%com_total"
FROM listed LEFT JOIN (SELECT * FROM ops LEFT JOIN nation ON cod_org = n_nationkey LEFT JOIN supplier ON cod_prod = s_suppkey) x USING (cod_rama, nro_poliza)
""",
)
def commission_comparison(spark, sf_dir):
    """All orders as the regulator's list against the lines shipped since June 1996."""
    o = table(spark, sf_dir, "orders")
    listed = o.select(
        F.when(F.col("o_orderpriority") < "3", 1030).otherwise(1040).alias("codigo_ramo"), F.col("o_orderkey").alias("nro_poliza")
    )
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") >= F.expr("TIMESTAMP_NTZ '1996-06-01'"))
    price = F.col("l_extendedprice")
    ops = li.select(
        F.when(F.col("l_returnflag") == "A", 4).otherwise(44).alias("cod_rama"),
        F.col("l_orderkey").alias("nro_poliza"),
        (F.col("l_suppkey") % 25).alias("cod_org"),
        F.col("l_suppkey").alias("cod_prod"),
        price.alias("prima_tarifa"),
        (price * F.col("l_discount")).alias("bon_prima"),
        F.when(F.col("l_tax") == 0, 0.0).otherwise(price).alias("prima_neta"),
        (price * F.col("l_discount")).alias("com_org"),
        (price * F.col("l_tax")).alias("com_prod"),
    )
    report = compare_commissions(listed, ops, producers(spark, sf_dir), organizers(spark, sf_dir))
    return report.withColumns({c: F.round(c, 6) for c in ("%com_org", "%com_prod", "%com_total")})


def _policy_text():
    """Seven digits with more behind them, or no number at all."""
    digits = F.concat(F.lpad(F.col("o_custkey").cast("string"), 7, "0"), F.lit("99"))
    return F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("s/n "), F.col("o_custkey"))).otherwise(digits)


def _cases(spark, sf_dir):
    """Orders as cases: finished ones lack a client, open ones a producer."""
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("D"), F.col("o_orderkey")).alias("dominio"),
        _policy_text().alias("poliza"),
        F.when(status == "F", "").otherwise("known").alias("cliente"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 0).otherwise(1).alias("activa"),
        F.when(status == "O", F.lit(None)).otherwise(F.lit(1)).cast("bigint").alias("cod_productor"),
        F.lit("old").alias("nom_productor"),
        F.lit(1).cast("bigint").alias("cod_organizador"),
        F.lit("old").alias("nom_organizador"),
    )


_CASES_SQL = """
cases AS (SELECT o_orderkey AS id, 'D' || o_orderkey AS dominio,
  CASE WHEN o_orderpriority = '5-LOW' THEN 's/n ' || o_custkey ELSE lpad(CAST(o_custkey AS VARCHAR), 7, '0') || '99' END AS poliza,
  CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'known' END AS cliente, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0 ELSE 1 END AS activa,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(1 AS BIGINT) END AS cod_productor, 'old' AS nom_productor, CAST(1 AS BIGINT) AS cod_organizador,
  'old' AS nom_organizador FROM orders)"""


def _policy_rows(spark, sf_dir):
    """Lines as daily policy rows; a policy is a customer. Pending orders are of another branch."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = table(spark, sf_dir, "lineitem")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        F.when(F.col("o_orderstatus") == "P", 7).otherwise(44).alias("CodRama"),
        F.col("o_custkey").alias("Poliza"),
        day("l_shipdate").alias("Fecha"),
        F.col("o_custkey").alias("NroAsegurado"),
        F.col("l_suppkey").alias("CodProductor"),
        (F.col("l_suppkey") % 30).alias("CodOrganizador"),
    )


_POLICY_ROWS_SQL = """
policy_rows AS (SELECT o_custkey AS Poliza, CAST(l_shipdate AS DATE) AS Fecha, o_custkey AS NroAsegurado, l_suppkey AS CodProductor, l_suppkey % 30 AS CodOrganizador
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P')"""


def _enriched_sql(pending: str, order: str, client: str, cases: str = "cases", before: str = "") -> str:
    return f"""
WITH {_CASES_SQL}, {_POLICY_ROWS_SQL}, {before}
pending AS (SELECT DISTINCT poliza, TRY_CAST(substr(poliza, 1, 7) AS BIGINT) AS n FROM {cases} WHERE {pending} AND activa = 1),
last_row AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Poliza ORDER BY {order}) AS rn FROM policy_rows) WHERE rn = 1),
found AS (SELECT p.poliza, r.CodProductor, s_name, r.CodOrganizador, n_name, c_name FROM pending p JOIN last_row r ON r.Poliza = p.n
  LEFT JOIN supplier ON r.CodProductor = s_suppkey LEFT JOIN nation ON r.CodOrganizador = n_nationkey LEFT JOIN customer ON r.NroAsegurado = c_custkey)
SELECT id, dominio, c.poliza, {client} AS cliente, activa, coalesce(f.CodProductor, cod_productor) AS cod_productor, coalesce(f.s_name, nom_productor) AS nom_productor,
  coalesce(f.CodOrganizador, cod_organizador) AS cod_organizador, coalesce(f.n_name, nom_organizador) AS nom_organizador
FROM {cases} c LEFT JOIN found f ON c.poliza = f.poliza"""


@query("case_enrichment", _enriched_sql("cliente = ''", "Fecha DESC, CodProductor DESC, CodOrganizador DESC", "coalesce(f.c_name, cliente)"))
def case_enrichment(spark, sf_dir):
    """Client, producer and organizer of the newest row of the case's policy."""
    clients = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("NroPersona"), F.col("c_name").alias("Nombre"))
    return enrich_cases(
        _cases(spark, sf_dir), _policy_rows(spark, sf_dir), clients, producers(spark, sf_dir),
        organizers(spark, sf_dir), ties=["CodProductor"],
    )


@query("case_producer", _enriched_sql("cod_productor IS NULL", "CodProductor DESC, CodOrganizador DESC", "cliente"))
def case_producer(spark, sf_dir):
    """Producer and organizer for the cases without one; the highest producer code decides."""
    return enrich_case_producers(
        _cases(spark, sf_dir), _policy_rows(spark, sf_dir), producers(spark, sf_dir), organizers(spark, sf_dir),
        ["CodProductor", "CodOrganizador"],
    )


_CLIENTS_SQL = _enriched_sql("cliente = ''", "Fecha DESC, CodProductor DESC, CodOrganizador DESC", "coalesce(f.c_name, cliente)")


@query(
    "case_write_back",
    _enriched_sql(
        "cod_productor IS NULL", "CodProductor DESC, CodOrganizador DESC", "cliente", "enriched", f"enriched AS ({_CLIENTS_SQL}),"
    ),
)
def case_write_back(spark, sf_dir):
    """Cases kept in a table, given clients and then producers; a second run of both changes nothing."""
    cases = KeyedTable(spark, work_dir(spark, "cases"), "poliza", 16)
    cases.write(_cases(spark, sf_dir))
    clients = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("NroPersona"), F.col("c_name").alias("Nombre"))
    # Four updates read the policy rows, which a mart keeps in a table.
    rows, by = stage(_policy_rows(spark, sf_dir), "policy-rows"), (producers(spark, sf_dir), organizers(spark, sf_dir))

    def run():
        found = client_updates(cases.read(), rows, clients, *by, ties=["CodProductor"])
        changed = cases.update(found, [*INTERMEDIARIES, "cliente"])
        return changed + cases.update(producer_updates(cases.read(), rows, *by, ["CodProductor", "CodOrganizador"]), INTERMEDIARIES)

    assert run() and not run()
    return cases.read()
