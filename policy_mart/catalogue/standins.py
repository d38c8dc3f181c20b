"""The mart's inputs derived from the driver's tables, each with the SQL of the same rows.

Operations come from orders, premiums and claims from lineitem, persons from customer,
intermediaries from supplier and nation, rates from part, snapshots from events and lineitem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.facts import CLAIM_PAYMENT_COLUMNS, OPERATION_COLUMNS, OPERATION_DATES, prepare_operations
from .registry import table


def with_missing(df: DataFrame, columns, kind: str = "string") -> DataFrame:
    """Add the columns a stand-in has no values for."""
    known = set(df.columns)
    return df.select("*", *[F.lit(None).cast(kind).alias(c) for c in columns if c not in known])


def day(c: str) -> Column:
    return F.col(c).cast("date")


def _by_status(f, o, p) -> Column:
    return F.when(F.col("o_orderstatus") == "F", f).when(F.col("o_orderstatus") == "O", o).otherwise(p)


def raw_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the operational source's column names."""
    o = table(spark, sf_dir, "orders").withColumn("d", day("o_orderdate"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    branch = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 4)
    branch = branch.when(F.col("o_orderpriority") == "3-MEDIUM", 44).otherwise(7)
    price = F.col("o_totalprice")
    values = {
        "M1OPER": F.col("o_orderkey"),
        "M1SUOP": F.lit(0).cast("bigint"),
        "M1TIOU": _by_status(1, 2, 3),
        "M1STOU": F.lit(1),
        "M1PVNR": F.lit(0),
        "M1RAMA": branch.cast("bigint"),
        "M1POLI": F.col("o_custkey"),
        "M1ASEN": F.col("o_custkey"),
        "M1COPOA": F.col("o_custkey") % 1000,
        "M1COPSA": _by_status(1, 2, 3),
        "M1NOMBA": F.lit("-"),
        "M1NOLOA": F.lit("-"),
        "M1PRLOA": F.col("o_orderpriority"),
        "M1ORG1": F.when(urgent, 3873).otherwise(F.col("o_custkey") % 25),
        "M1PRO1": F.when(urgent, 9105).otherwise(F.col("o_custkey") % 100),
        "MASAOP": price * 10,
        "MAPRIM": price,
        "MABPRI": price * 0.05,
        "MAREAD": price * 0.1,
        "MAREFI": price * 0.02,
        "MAIPR5": price * 0.01,
        "MAPREM": price * 1.25,
        "M1FEMA": F.year("d"),
        "M1FEMM": F.month("d"),
        "M1FEMD": F.day("d"),
        "M1FIOA": F.year("d"),
        "M1FIOM": F.month("d"),
        "M1FIOD": F.day("d"),
        "M1FVOA": _by_status(F.year("d") + 1, F.year("d") + 1, 0),
        "M1FVOM": _by_status(F.month("d"), F.month("d"), 0),
        "M1FVOD": _by_status(F.day("d"), F.day("d"), 0),
    }
    raw = o.select(*[v.alias(n) for n, v in values.items()])
    parts = [p for ps in OPERATION_DATES.values() for p in ps]
    return with_missing(raw, [*OPERATION_COLUMNS, *parts], "double")


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_operations(raw_operations(spark, sf_dir))


OPERATIONS_SQL = """
operations AS (
  SELECT o_orderkey AS Op, CAST(0 AS BIGINT) AS Suplemento,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS CodTipoOp, 1 AS CodSubTipoOp,
    CAST(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 4 WHEN o_orderpriority = '3-MEDIUM' THEN 44 ELSE 7 END AS BIGINT) AS CodRama,
    o_custkey AS Poliza, o_custkey AS NroAsegurado, o_custkey % 1000 AS CpAsegurado,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS CpSufijoAsegurado,
    o_orderpriority AS ProvinciaAsegurado,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 9105 ELSE o_custkey % 25 END AS CodOrganizador,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 3873 ELSE o_custkey % 100 END AS CodProductor,
    o_totalprice * 10 AS SumaAsegurada, o_totalprice AS PrimaNeta, o_totalprice * 0.05::DOUBLE AS BonifPrima,
    o_totalprice * 0.1::DOUBLE AS RecAdm, o_totalprice * 0.02::DOUBLE AS RecFin, o_totalprice * 0.01::DOUBLE AS RecCapital,
    o_totalprice + o_totalprice * 0.05::DOUBLE AS PrimaTarifa,
    o_totalprice * 0.01::DOUBLE + o_totalprice * 1.25::DOUBLE AS PremioBruto,
    CAST(o_orderdate AS DATE) AS FEmision, CAST(o_orderdate AS DATE) AS FVigDesde,
    CASE WHEN o_orderstatus <> 'P' AND NOT (month(o_orderdate) = 2 AND day(o_orderdate) = 29)
         THEN make_date(CAST(year(o_orderdate) + 1 AS INTEGER), CAST(month(o_orderdate) AS INTEGER), CAST(day(o_orderdate) AS INTEGER)) END AS FVigHasta
  FROM orders
)"""

# Coverage codes of the part types; medium parts that are not returned have the
# excluded 'D' coverage or, when the line was never returned, liability only.
COVERAGE_OF_TYPE = {
    "PROMO": "C2",
    "ECONOMY": "C5",
    "STANDARD": "B5",
    "LARGE": "C4",
    "SMALL": "B4",
    "MEDIUM": "D1",
}
# How far each coverage's rate is from the part's price.
WEIGHT_OF_COVERAGE = {"C2": 12.0, "C4": 3.0, "C5": 4.0, "B4": 1.0, "B5": 2.0, "D1": 120.0}


def _lookup(column: Column, values: dict) -> Column:
    first, *rest = values.items()
    chosen = F.when(column == first[0], F.lit(first[1]))
    for key, value in rest:
        chosen = chosen.when(column == key, F.lit(value))
    return chosen


def _lookup_sql(column: str, values: dict) -> str:
    cases = " ".join(f"WHEN '{k}' THEN " + (f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE") for k, v in values.items())
    return f"CASE {column} {cases} END"


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate history from part: tariff by brand, chapter by block of parts, five age segments."""
    p = table(spark, sf_dir, "part")
    code = _lookup(F.col("p_type"), COVERAGE_OF_TYPE)
    segment = F.ceil(F.col("p_size") / 10).cast("bigint")
    return p.select(
        F.substring("p_brand", 7, 9).cast("bigint").alias("NumTarifa"),
        F.expr("p_partkey DIV 2000").alias("Cap"),
        F.lit(1).cast("bigint").alias("Air"),
        code.alias("CodCobertura"),
        segment.alias("Ant_"),
        ((segment - 1) * 10 + 1).alias("Min"),
        (segment * 10).alias("Max"),
        (F.col("p_retailprice") / 100 * _lookup(code, WEIGHT_OF_COVERAGE)).alias("Tasa"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("p_partkey") % 1000).cast("int")).alias("Fecha"),
        "p_size",
    )


def rate_history_sql(parts: str = "part", name: str = "rate_history") -> str:
    """SQL of the widened rates of some parts."""
    return f"""
raw_{name} AS (
  SELECT CAST(substr(p_brand, 7) AS BIGINT) AS NumTarifa, p_partkey // 2000 AS Cap, CAST(1 AS BIGINT) AS Air,
    {_lookup_sql('p_type', COVERAGE_OF_TYPE)} AS CodCobertura,
    CAST(ceil(p_size / 10.0) AS BIGINT) AS segmento_ant,
    p_retailprice / 100 * ({_lookup_sql(_lookup_sql('p_type', COVERAGE_OF_TYPE), WEIGHT_OF_COVERAGE)}) AS TasaAnual,
    DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS fecha_desde
  FROM {parts}
),
{name} AS (
  SELECT NumTarifa, Cap, Air, CodCobertura, segmento_ant, (segmento_ant - 1) * 10 + 1 AS AntMinima,
    CASE WHEN segmento_ant = max(segmento_ant) OVER (PARTITION BY NumTarifa, Cap, Air, CodCobertura)
         THEN 200 ELSE segmento_ant * 10 END AS AntMaxima,
    TasaAnual, fecha_desde
  FROM raw_{name}
)"""


RATE_HISTORY_SQL = rate_history_sql()
CURRENT_RATES_SQL = (
    RATE_HISTORY_SQL
    + """,
current_rates AS (
  SELECT * EXCLUDE rn FROM (
    SELECT *, row_number() OVER (PARTITION BY NumTarifa, Cap, Air, CodCobertura, segmento_ant
      ORDER BY fecha_desde DESC, AntMinima DESC, AntMaxima DESC, TasaAnual DESC) AS rn FROM rate_history) WHERE rn = 1
)"""
)


def coverage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which risks each coverage code includes, for the codes that part has."""
    codes = table(spark, sf_dir, "part").select(_lookup(F.col("p_type"), COVERAGE_OF_TYPE).alias("CodCobertura")).distinct()
    c = F.col("CodCobertura")
    full = c.startswith("C").cast("int")
    return codes.filter(c != "D1").select(
        c,
        F.lit(1).alias("Rt"),
        c.isin("C4", "C5", "B5").cast("int").alias("Rp"),
        (c != "B5").cast("int").alias("It"),
        full.alias("Ip"),
        (c == "C2").cast("int").alias("At"),
        full.alias("Ap"),
    )


COVERAGE_FLAGS_SQL = f"""
coverage_flags AS (
  SELECT CodCobertura, 1 AS Rt, CASE WHEN CodCobertura IN ('C4','C5','B5') THEN 1 ELSE 0 END AS Rp,
    CASE WHEN CodCobertura <> 'B5' THEN 1 ELSE 0 END AS It, CASE WHEN CodCobertura LIKE 'C%' THEN 1 ELSE 0 END AS Ip,
    CASE WHEN CodCobertura = 'C2' THEN 1 ELSE 0 END AS At, CASE WHEN CodCobertura LIKE 'C%' THEN 1 ELSE 0 END AS Ap
  FROM (SELECT DISTINCT {_lookup_sql('p_type', COVERAGE_OF_TYPE)} AS CodCobertura FROM part)
  WHERE CodCobertura <> 'D1'
)"""


def premium_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order and part, under the motor premium's column names."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", day("o_orderdate").alias("FEmision"), "o_custkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_brand")
    # The orders come last, so that a large join leaves the lines of an order side by side.
    joined = li.join(p, li["l_partkey"] == p["p_partkey"]).join(o, li["l_orderkey"] == o["o_orderkey"])
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return joined.select(
        "FEmision",
        F.col("FEmision").alias("FVigDesde"),
        day("l_shipdate").alias("FVigHasta"),
        F.col("l_orderkey").alias("Op"),
        F.col("l_linenumber").cast("bigint").alias("Comp"),
        F.col("l_partkey").alias("Supl"),
        F.lit(4).cast("bigint").alias("CodRama"),
        F.col("l_orderkey").alias("Poliza"),
        price.alias("SaComponente"),
        F.expr("l_partkey DIV 2000").alias("Cap"),
        F.col("p_size").cast("bigint").alias("Var"),
        F.lit(1).cast("bigint").alias("Air"),
        F.col("l_linestatus").alias("Origen"),
        (F.col("p_size") + 1980).cast("bigint").alias("AnioComponente"),
        _lookup(F.col("p_type"), COVERAGE_OF_TYPE).alias("CodCoberturaAut"),
        F.col("l_linenumber").cast("bigint").alias("CodTipoVeh"),
        F.lit(1).cast("bigint").alias("CodUsoVeh"),
        price.alias("PrimaTarifaSupl"),
        (price * discount).alias("BonPrimaSupl"),
        (price * (1 + tax)).alias("PremioSupl"),
        (price * tax).alias("PremioCobradoSupl"),
        (F.col("l_suppkey") % 25).alias("CodOrganizador"),
        F.col("l_suppkey").alias("CodProductor"),
        price.alias("PrimaTarifaComp"),
        (price * 0.25).alias("PrimaRcTarifaComp"),
        (price * 0.75).alias("PrimaCascoTarifaComp"),
        (price * (1 - discount)).alias("PrimaNetaComp"),
        (price * 0.25).alias("PrimaRcNetaComp"),
        (price * 0.5).alias("PrimaCascoNetaComp"),
        "l_returnflag",
        F.col("l_quantity").cast("int").alias("Ant"),
        (F.substring("p_brand", 7, 9).cast("bigint") % 25).alias("TarifaHija"),
    )


PREMIUM_LINES_SQL = f"""
premium_lines AS (
  SELECT CAST(o_orderdate AS DATE) AS FEmision, CAST(o_orderdate AS DATE) AS FVigDesde, CAST(l_shipdate AS DATE) AS FVigHasta,
    l_orderkey AS Op, CAST(l_linenumber AS BIGINT) AS Comp, l_partkey AS Supl, CAST(4 AS BIGINT) AS CodRama, l_orderkey AS Poliza,
    l_extendedprice AS SaComponente, l_partkey // 2000 AS Cap, CAST(p_size AS BIGINT) AS Var, CAST(1 AS BIGINT) AS Air,
    l_linestatus AS Origen, CAST(p_size + 1980 AS BIGINT) AS AnioComponente, {_lookup_sql('p_type', COVERAGE_OF_TYPE)} AS CodCoberturaAut,
    CAST(l_linenumber AS BIGINT) AS CodTipoVeh, CAST(1 AS BIGINT) AS CodUsoVeh,
    l_extendedprice AS PrimaTarifaSupl, l_extendedprice * l_discount AS BonPrimaSupl, l_extendedprice * (1 + l_tax) AS PremioSupl,
    l_extendedprice * l_tax AS PremioCobradoSupl, l_suppkey % 25 AS CodOrganizador, l_suppkey AS CodProductor,
    l_extendedprice AS PrimaTarifaComp, l_extendedprice * 0.25::DOUBLE AS PrimaRcTarifaComp,
    l_extendedprice * 0.75::DOUBLE AS PrimaCascoTarifaComp, l_extendedprice * (1 - l_discount) AS PrimaNetaComp,
    l_extendedprice * 0.25::DOUBLE AS PrimaRcNetaComp, l_extendedprice * 0.5::DOUBLE AS PrimaCascoNetaComp,
    l_returnflag, CAST(l_quantity AS INTEGER) AS Ant, CAST(substr(p_brand, 7) AS BIGINT) % 25 AS TarifaHija
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as one day's vehicles, under the snapshot's column names. Medium parts on lines
    that were not returned have liability cover only."""
    liability = (F.col("CodCoberturaAut") == "D1") & (F.col("l_returnflag") == "N")
    return premium_lines(spark, sf_dir).select(
        "TarifaHija",
        "CodRama",
        "Poliza",
        F.col("Comp").alias("Componente"),
        F.when(liability, "A2").otherwise(F.col("CodCoberturaAut")).alias("CodCoberturaAut"),
        "Ant",
        F.col("Cap").alias("CvaCapitulo"),
        F.col("Var").alias("CvaVariante"),
        F.lit("2002-01-01").cast("date").alias("Fecha"),
    )


VEHICLES_SQL = (
    PREMIUM_LINES_SQL
    + """,
vehicles AS (
  SELECT TarifaHija AS NumTarifa, CodRama, Poliza, Comp, CodCoberturaAut AS CodCobertura, Ant, Cap AS CvaCapitulo, Var AS CvaVariante
  FROM premium_lines WHERE NOT (CodCoberturaAut = 'D1' AND l_returnflag = 'N')
)"""
)


def organizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    named = n.join(r, n["n_regionkey"] == r["r_regionkey"], "left")
    return named.select(
        F.col("n_nationkey").cast("bigint").alias("CodOrganizador"),
        F.col("n_name").alias("Nombre"),
        F.col("r_name").alias("Grupo"),
    )


def producers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("CodProductor"), F.col("s_name").alias("Nombre"))


def raw_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as persons. Three neighbours share a tax id, four a document, some have unusable
    ones, some are blocked, and some belong to the group of a person with a lower number; every second
    of these heads belongs to the group before its own."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    third, fourth = [F.expr(f"c_custkey DIV {n}") for n in (3, 4)]
    tax_id = F.concat(F.lit("2"), F.lpad(((third * 7919 + 1000000) % 10000000000).cast("string"), 10, "0"))
    born = F.date_add(F.lit("1960-01-01").cast("date"), (k % 15000).cast("int")).cast("string")
    return c.select(
        (k + 1).alias("NroPersona"),
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("Nombre"),
        F.col("c_mktsegment").alias("Domicilio"),
        F.col("c_nationkey").cast("bigint").alias("Cp"),
        F.lit(0).cast("bigint").alias("CpSufijo"),
        F.when(k % 13 == 0, 0).otherwise(fourth + 5000000).alias("NroDocumento"),
        F.when(k % 11 == 0, "999").otherwise(tax_id).alias("Cuit"),
        F.when(k % 7 == 0, "0001-01-01").when(k % 9 == 0, "unknown").otherwise(born).alias("FechaNac"),
        (k % 3).cast("int").alias("Sexo"),
        F.when(k % 5 == 0, "S").otherwise("_").alias("Bloqueado"),
        F.when(k % 204 == 102, k - 101).when(k % 17 == 0, F.expr("c_custkey DIV 102 * 102 + 1")).when(k % 19 == 0, F.lit(None)).otherwise(F.lit(0)).alias("Grupo"),
    )


PERSONS_SQL = """
raw_persons AS (
  SELECT c_custkey + 1 AS NroPersona, c_custkey AS k, c_name, c_mktsegment, CAST(c_nationkey AS BIGINT) AS Cp, CAST(0 AS BIGINT) AS CpSufijo,
    CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE c_custkey // 4 + 5000000 END AS NroDocumento,
    CASE WHEN c_custkey % 11 = 0 THEN '999'
         ELSE '2' || lpad(CAST(((c_custkey // 3) * 7919 + 1000000) % 10000000000 AS VARCHAR), 10, '0') END AS Cuit,
    CASE WHEN c_custkey % 7 = 0 OR c_custkey % 9 = 0 THEN NULL ELSE DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER) END AS FechaNac,
    CASE c_custkey % 3 WHEN 1 THEN 'M' WHEN 2 THEN 'F' END AS Sexo,
    CASE WHEN c_custkey % 5 = 0 THEN 'S' ELSE '_' END AS Bloqueado,
    CASE WHEN c_custkey % 204 = 102 THEN c_custkey - 101 WHEN c_custkey % 17 = 0 THEN c_custkey // 102 * 102 + 1 WHEN c_custkey % 19 = 0 THEN NULL ELSE 0 END AS Grupo0
  FROM customer
),
persons AS (
  SELECT NroPersona, upper(substr(c_name, 1, 1)) || lower(substr(c_name, 2)) AS Nombre,
    upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS Domicilio,
    Cp, CpSufijo, NroDocumento, Cuit, FechaNac, Sexo, Bloqueado,
    CASE WHEN Grupo0 <> 0 THEN Grupo0 WHEN NroPersona IN (SELECT Grupo0 FROM raw_persons WHERE Grupo0 > 0) THEN NroPersona ELSE 0 END AS Grupo,
    length(Cuit) <> 11 OR Cuit = '20000999998' OR substr(Cuit, 1, 1) NOT IN ('2', '3')
      OR (length(Cuit) >= 10 AND substr(Cuit, 5, 6) = repeat(substr(Cuit, 5, 1), 6)) AS mal_cuit,
    NroDocumento IN (0, 99999999) OR NroDocumento < 1000000
      OR (length(CAST(NroDocumento AS VARCHAR)) >= 8
          AND substr(CAST(NroDocumento AS VARCHAR), 3, 6) = repeat(substr(CAST(NroDocumento AS VARCHAR), 3, 1), 6)) AS mal_doc
  FROM raw_persons
)"""


def raw_claim_payments(spark, sf_dir):
    """Returned order lines with the claim payments' source column names."""
    li = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    values = {
        "LC_RAMA": F.lit(4).cast("bigint"),
        "LD_SINI": F.col("l_orderkey"),
        "LC_LIQN": F.col("l_linenumber"),
        "LD_ITEC": F.concat(F.lit("  "), F.col("l_linestatus"), F.lit(" ")),
        "LC_FPAG": day("l_shipdate"),
        "PO_ASEN": F.col("l_partkey"),
        "PO_ORG1": F.col("l_suppkey") % 25,
        "PO_PRO1": F.col("l_suppkey"),
        "LD_IIAU": F.col("l_extendedprice"),
    }
    return with_missing(li.select(*[v.alias(n) for n, v in values.items()]), CLAIM_PAYMENT_COLUMNS)


CLAIMS_SQL = """
claims AS (
  SELECT CAST(4 AS BIGINT) AS CodRama, l_orderkey AS Siniestro, CAST(l_linenumber AS BIGINT) AS NroLiquidacion, l_linestatus AS CodItemPago,
    CAST(l_shipdate AS DATE) AS FechaPago, l_partkey AS NroAsegurado, l_suppkey % 25 AS CodOrganizador, l_suppkey AS CodProductor,
    l_extendedprice AS Importe
  FROM lineitem WHERE l_returnflag = 'R'
)"""


def raw_other_premiums(spark, sf_dir):
    """Premium lines with the other-branch table's names; the end date is text, sometimes none."""
    lines = premium_lines(spark, sf_dir)
    end = F.when(F.col("Origen") == "O", F.date_format("FVigHasta", "dd/MM/yyyy")).otherwise("31/02/2001")
    return lines.select(
        "FEmision", "FVigDesde", end.alias("FVigHasta"), "Op", "CodRama", "Poliza", "Supl", "Comp",
        "CodOrganizador", "CodProductor", F.col("CodTipoVeh").alias("CodRiesgo"), F.col("Origen").alias("Riesgo"),
        F.col("Var").alias("CodCobertura"), F.col("CodCoberturaAut").alias("Cobertura"),
        F.col("l_returnflag").alias("CodProvincia"), (F.col("SaComponente") * 100).alias("SaCobertura"),
        F.col("PremioSupl").alias("PremioBrutoSupl"), F.lit(1.5).alias("Pormilaje"),
        "PrimaTarifaSupl", F.col("PrimaTarifaComp").alias("PrimaCoberturaEmitida"),
        F.col("PrimaNetaComp").alias("PrimaNetaSupl"), F.col("PrimaCascoNetaComp").alias("PrimaCoberturaNeta"),
    )


OTHER_PREMIUMS_SQL = (
    PREMIUM_LINES_SQL
    + """,
other_premiums AS (
  SELECT FEmision, CASE WHEN Origen = 'O' THEN FVigHasta END AS FVigHasta, Op, Supl, Comp, Var AS CodCobertura, CodRama, CodOrganizador, CodProductor,
    CodTipoVeh AS CodRiesgo, Origen AS Riesgo, CodCoberturaAut AS Cobertura,
    l_returnflag AS CodProvincia, SaComponente * 100 AS SaCobertura, CAST(0 AS DOUBLE) AS BonPrimaPorc,
    PrimaTarifaComp AS PrimaTarifaCobertura, PrimaCascoNetaComp AS PrimaNetaCobertura
  FROM premium_lines
)"""
)
