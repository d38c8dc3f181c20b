"""Incremental loads over the driver's tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import MONTH, in_month, yyyymm
from ..functions.text import strip
from ..operators.load import append_new, contiguous_months, first_date, missing_dates, snapshot_rows_to_load
from ..plans.facts import (
    CLAIM_REPORT_COLUMNS,
    FILE_COLUMNS,
    LIFE_PREMIUM_COLUMNS,
    MOTOR_PREMIUM_UNUSED,
    load_claim_payments,
    prepare_claim_payments,
    prepare_operations,
    prepare_other_premiums,
    read_premium_file,
)
from ..plans.mart import Mart
from ..plans.reports import claim_payments_control
from ..schemas import CLAIM_PAYMENTS, CLAIM_REPORTS, LIFE_PREMIUMS, MOTOR_PREMIUMS, OTHER_PREMIUMS
from ..sources.readers import cast_to, malformed_lines, read_delimited
from ..sources.readers import query as sql_query
from ..sources.writers import (
    append_by_month,
    compact_fragmented,
    compact_months,
    create_table,
    insert_select,
    write_report,
)
from ..workdir import work_dir
from .registry import query, table
from .standins import (
    CLAIMS_SQL,
    OPERATIONS_SQL,
    OTHER_PREMIUMS_SQL,
    PREMIUM_LINES_SQL,
    day,
    premium_lines,
    raw_claim_payments,
    raw_operations,
    raw_other_premiums,
    with_missing,
)


def _orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", day("o_orderdate").alias("order_date"))


@query(
    "append_new_orders",
    """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date FROM orders s
WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderstatus = 'F' AND t.o_orderkey = s.o_orderkey
  AND date_trunc('month', t.o_orderdate) = date_trunc('month', s.o_orderdate))
""",
)
def append_new_orders(spark, sf_dir):
    """All orders against a fact that already holds the finished ones."""
    source = _orders(spark, sf_dir)
    loaded = source.filter("o_orderstatus = 'F'")
    return append_new(source, loaded, ["o_orderkey"], "order_date").drop("o_orderstatus")


@query(
    "contiguous_months",
    """
WITH m AS (SELECT DISTINCT year(o_orderdate) * 12 + month(o_orderdate) AS i, year(o_orderdate) * 100 + month(o_orderdate) AS yyyymm
  FROM orders WHERE NOT (year(o_orderdate) = 1998 AND month(o_orderdate) = 6)),
n AS (SELECT *, i - row_number() OVER (ORDER BY i) AS island FROM m)
SELECT CAST(yyyymm AS INTEGER) AS yyyymm, (SELECT count(*) FROM orders WHERE year(o_orderdate) * 100 + month(o_orderdate) = yyyymm) AS orders
FROM n WHERE island = (SELECT min(island) FROM n)
""",
)
def contiguous(spark, sf_dir):
    """Orders per month up to the first empty month, with June 1998 taken out to make one."""
    orders = _orders(spark, sf_dir).filter(~in_month("order_date", 1998, 6)).withColumn(MONTH, yyyymm("order_date"))
    run = contiguous_months(orders)
    return orders.join(run, MONTH, "left_semi").groupBy(MONTH).agg(F.count(F.lit(1)).alias("orders"))


_LOADED_BEFORE = dt.date(2024, 1, 11)


def _events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "value", day("ts").alias("Fecha"))


def _span(source):
    """The source's first and last day."""
    found = source.agg(F.min("Fecha").alias("first"), F.max("Fecha").alias("last")).first()
    return found["first"], found["last"]


@query(
    "missing_snapshot_dates",
    """
SELECT d AS Fecha FROM (SELECT CAST(unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS DATE) AS d)
WHERE d NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE ts < TIMESTAMP '2024-01-11')
  AND d IN (SELECT CAST(ts AS DATE) FROM events)
""",
)
def missing_snapshot_dates(spark, sf_dir):
    """Days the source has and the target, loaded up to 10 January, lacks."""
    source = _events(spark, sf_dir)
    loaded = source.filter(F.col("Fecha") < F.lit(_LOADED_BEFORE))
    return missing_dates(source, loaded, "Fecha", *_span(source))


@query(
    "snapshot_load",
    """
SELECT event_id, user_id, event_type AS Dominio, CAST(ts AS DATE) AS Fecha FROM events
WHERE ts >= TIMESTAMP '2024-01-11'
""",
)
def snapshot_load(spark, sf_dir):
    """Rows of the missing days, with padding taken off a text column."""
    padded = F.concat(F.lit(" \t"), F.col("event_type"), F.lit("  "))
    source = _events(spark, sf_dir).withColumn("Dominio", padded)
    loaded = source.filter(F.col("Fecha") < F.lit(_LOADED_BEFORE))
    new = snapshot_rows_to_load(source, loaded, "Fecha", *_span(source))
    return new.select("event_id", "user_id", strip("Dominio").alias("Dominio"), "Fecha")


_OPERATION_OUT = [
    "Op", "Suplemento", "CodTipoOp", "CodRama", "Poliza", "NroAsegurado", "CodOrganizador", "CodProductor",
    "SumaAsegurada", "PrimaNeta", "BonifPrima", "RecAdm", "RecFin", "RecCapital", "PrimaTarifa", "PremioBruto",
    "FEmision", "FVigDesde", "FVigHasta",
]


@query("operations_load", f"WITH {OPERATIONS_SQL} SELECT {', '.join(_OPERATION_OUT)} FROM operations")
def operations_load(spark, sf_dir):
    """Rename, dates from parts, derived amounts and exchanged codes."""
    return prepare_operations(raw_operations(spark, sf_dir)).select(*_OPERATION_OUT)


_CLAIM_OUT = [
    "CodRama", "Siniestro", "NroLiquidacion", "CodItemPago", "FechaPago", "NroAsegurado", "CodOrganizador",
    "CodProductor", "Importe",
]
@query(
    "claims_load",
    f"""
WITH {CLAIMS_SQL}
SELECT {', '.join(_CLAIM_OUT)} FROM claims s WHERE NOT EXISTS (
  SELECT 1 FROM claims t WHERE t.CodItemPago = 'F' AND t.CodRama = s.CodRama AND t.Siniestro = s.Siniestro
    AND t.NroLiquidacion = s.NroLiquidacion AND t.CodItemPago = s.CodItemPago
    AND date_trunc('month', t.FechaPago) = date_trunc('month', s.FechaPago))
""",
)
def claims_load(spark, sf_dir):
    """Claim payments from the source's first month on, against the loaded items of kind F."""
    source = cast_to(prepare_claim_payments(raw_claim_payments(spark, sf_dir)), CLAIM_PAYMENTS.schema)
    since = first_date(source, "FechaPago").replace(day=1)
    loaded = source.filter("CodItemPago = 'F'")
    return append_new(source, loaded, CLAIM_PAYMENTS.keys, "FechaPago", since).select(*_CLAIM_OUT)


@query(
    "claim_reports_load",
    """
WITH r AS (SELECT l_orderkey AS Op, CAST(l_linenumber AS BIGINT) AS Comp, l_partkey AS Siniestro, CAST(l_shipdate AS DATE) AS FechaDenuncia,
    l_suppkey AS CodProductor, l_returnflag FROM lineitem)
SELECT Op, Comp, Siniestro, FechaDenuncia, CodProductor FROM r s WHERE NOT EXISTS (
  SELECT 1 FROM r t WHERE t.l_returnflag = 'A' AND t.Op = s.Op AND t.Comp = s.Comp AND t.Siniestro = s.Siniestro
    AND date_trunc('month', t.FechaDenuncia) = date_trunc('month', s.FechaDenuncia))
""",
)
def claim_reports_load(spark, sf_dir):
    """Claim reports, from all order lines, against the lines flagged A."""
    li = table(spark, sf_dir, "lineitem")
    values = {
        "DPOPER": F.col("l_orderkey"),
        "DPPOCO": F.col("l_linenumber"),
        "DCSINI": F.col("l_partkey"),
        "FEDENU": day("l_shipdate"),
        "POPRO1": F.col("l_suppkey"),
    }
    raw = with_missing(li.select("l_returnflag", *[v.alias(n) for n, v in values.items()]), CLAIM_REPORT_COLUMNS)
    rows = raw.select("l_returnflag", *[F.col(s).alias(n) for s, n in CLAIM_REPORT_COLUMNS.items()])
    loaded = cast_to(rows.filter("l_returnflag = 'A'"), CLAIM_REPORTS.schema)
    source = cast_to(rows, CLAIM_REPORTS.schema)
    new = append_new(source, loaded, CLAIM_REPORTS.keys, "FechaDenuncia")
    return new.select("Op", "Comp", "Siniestro", "FechaDenuncia", "CodProductor")


_MOTOR_OUT = ["FEmision", "Op", "Comp", "Supl", "Poliza", "SaComponente", "CodCoberturaAut", "PrimaNetaComp"]


@query(
    "premium_loads",
    f"""
WITH {PREMIUM_LINES_SQL}
SELECT {', '.join(_MOTOR_OUT)} FROM premium_lines s WHERE NOT EXISTS (
  SELECT 1 FROM premium_lines t WHERE t.l_returnflag = 'A' AND t.Op = s.Op AND t.Supl = s.Supl AND t.Comp = s.Comp
    AND date_trunc('month', t.FEmision) = date_trunc('month', s.FEmision))
""",
)
def premium_loads(spark, sf_dir):
    """Motor premiums without the unused columns, against the lines flagged A."""
    lines = with_missing(premium_lines(spark, sf_dir), MOTOR_PREMIUM_UNUSED)
    source = cast_to(lines.drop(*MOTOR_PREMIUM_UNUSED), MOTOR_PREMIUMS.schema)
    loaded = cast_to(lines.filter("l_returnflag = 'A'"), MOTOR_PREMIUMS.schema)
    return append_new(source, loaded, MOTOR_PREMIUMS.keys, "FEmision").select(*_MOTOR_OUT)


_OTHER_OUT = [
    "FEmision", "FVigHasta", "Op", "Supl", "Comp", "CodCobertura", "CodProvincia", "SaCobertura", "BonPrimaPorc",
    "PrimaTarifaCobertura", "PrimaNetaCobertura",
]
def _not_loaded(rows: str) -> str:
    return f"""NOT EXISTS (SELECT 1 FROM {rows} t WHERE t.CodProvincia = 'A' AND t.Op = s.Op AND t.Supl = s.Supl AND t.Comp = s.Comp
    AND t.CodCobertura = s.CodCobertura AND date_trunc('month', t.FEmision) = date_trunc('month', s.FEmision))"""


@query("other_premiums_load", f"WITH {OTHER_PREMIUMS_SQL} SELECT {', '.join(_OTHER_OUT)} FROM other_premiums s WHERE {_not_loaded('other_premiums')}")
def other_premiums_load(spark, sf_dir):
    """Other-branch premiums with lenient end dates, against the rows of province A."""
    source = cast_to(prepare_other_premiums(raw_other_premiums(spark, sf_dir)), OTHER_PREMIUMS.schema)
    loaded = source.filter("CodProvincia = 'A'")
    return append_new(source, loaded, OTHER_PREMIUMS.keys, "FEmision").select(*_OTHER_OUT)


_LIFE_OUT = ["FEmision", "Op", "Supl", "Comp", "CodCobertura", "CodProvincia", "SaSupl", "PrimaNetaCobertura"]


@query(
    "life_premiums_load",
    f"""
WITH {OTHER_PREMIUMS_SQL}
SELECT FEmision, Op, Supl, Comp, CodCobertura, CodProvincia, SaCobertura AS SaSupl, PrimaNetaCobertura
FROM other_premiums s WHERE {_not_loaded('other_premiums')}
""",
)
def life_premiums_load(spark, sf_dir):
    """Life premiums, against the rows of province A."""
    raw = raw_other_premiums(spark, sf_dir).withColumnsRenamed(
        {"SaCobertura": "SaSupl", "PrimaCoberturaEmitida": "PrimaTarifaCobertura", "PrimaCoberturaNeta": "PrimaNetaCobertura"}
    )
    raw = raw.withColumn("BonPrimaPctSupl", F.lit(0.0)).withColumnsRenamed(LIFE_PREMIUM_COLUMNS)
    source = cast_to(raw, LIFE_PREMIUMS.schema)
    loaded = source.filter("CodProvincia = 'A'")
    return append_new(source, loaded, LIFE_PREMIUMS.keys, "FEmision").select(*_LIFE_OUT)


@query(
    "csv_premiums",
    f"""
WITH {PREMIUM_LINES_SQL}
SELECT FEmision, CASE WHEN Origen = 'O' THEN FVigHasta END AS FVigHasta, Op, CodRama, Poliza, Supl, Comp, CodOrganizador, CodProductor,
  'a' || chr(241) || 'o ' || Origen AS Riesgo, Var AS CodCobertura, CodCoberturaAut AS Cobertura, l_returnflag AS CodProvincia, round(SaComponente * 100, 2) AS SaCobertura,
  CAST(10 AS DOUBLE) AS BonPrimaPorc, PrimaTarifaSupl AS PrimaTarifaSuplemento, PrimaTarifaSupl * (1 - 10 / 100::DOUBLE) AS PrimaNetaSuplemento
FROM premium_lines
""",
)
def csv_premiums(spark, sf_dir):
    """Premium lines written as the export file (`;`, decimal comma, ISO-8859-1) and read back."""
    raw = raw_other_premiums(spark, sf_dir).withColumnsRenamed(
        {"PremioBrutoSupl": "PremioBrutoSuplemento", "PrimaTarifaSupl": "PrimaTarifaSuplemento",
         "PrimaCoberturaEmitida": "PrimaTarifaCobertura"}
    )
    raw = raw.withColumns({"BonPrimaPorc": F.lit(10.0), "Riesgo": F.concat(F.lit("año "), F.col("Riesgo"))})

    def as_text(name):
        kind = raw.schema[name].dataType.simpleString()
        if kind == "double":
            return F.replace(F.format_number(name, 2), F.lit(","), F.lit("")).alias(name)
        return F.date_format(name, "d/M/yyyy") if kind == "date" else F.col(name).cast("string")

    def comma(name):
        text = as_text(name)
        return F.replace(text, F.lit("."), F.lit(",")) if raw.schema[name].dataType.simpleString() == "double" else text

    path = work_dir(spark, "export")
    file_rows = raw.select(*[comma(name).alias(header) for header, name in FILE_COLUMNS.items()])
    file_rows.write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return read_premium_file(spark, path).select(
        "FEmision", "FVigHasta", "Op", "CodRama", "Poliza", "Supl", "Comp", "CodOrganizador", "CodProductor", "Riesgo",
        "CodCobertura", "Cobertura", "CodProvincia", "SaCobertura", "BonPrimaPorc", "PrimaTarifaSuplemento",
        "PrimaNetaSuplemento",
    )


def _claims_mart(spark, sf_dir) -> Mart:
    """A mart that gets the claim payments in two loads; the second brings the first again."""
    mart = Mart(spark, work_dir(spark, "mart"))
    raw = raw_claim_payments(spark, sf_dir)
    load_claim_payments(mart, raw.filter(F.trim("LD_ITEC") == "F"))
    load_claim_payments(mart, raw)
    return mart


@query(
    "incremental_claims_rollup",
    f"""
WITH {CLAIMS_SQL}
SELECT CAST(date_trunc('month', FechaPago) AS DATE) AS FechaPagoMes, CodRama, CodOrganizador, CodProductor, NroAsegurado,
  CAST(SUM(CAST(Importe AS DECIMAL(18,4))) AS DOUBLE) AS Importe, count(DISTINCT Siniestro) AS siniestros_pagados
FROM claims GROUP BY ALL
""",
)
def incremental_claims_rollup(spark, sf_dir):
    """The rollup kept by two incremental loads equals the one of the whole fact."""
    mart = _claims_mart(spark, sf_dir)
    kept = spark.read.parquet(mart.path("sinpagt_perfiles_agg"))
    return kept.select(
        "FechaPagoMes", "CodRama", "CodOrganizador", "CodProductor", "NroAsegurado", "Importe", "siniestros_pagados"
    )


@query(
    "claims_control",
    f"""
WITH {CLAIMS_SQL}, m AS (SELECT CAST(year(FechaPago) * 100 + month(FechaPago) AS INTEGER) AS m FROM claims)
SELECT min(m) AS min_fact, max(m) AS max_fact, count(DISTINCT m) AS months_fact,
  min(m) AS min_rollup, max(m) AS max_rollup, count(DISTINCT m) AS months_rollup FROM m
""",
)
def claims_control(spark, sf_dir):
    return claim_payments_control(_claims_mart(spark, sf_dir))


@query(
    "compact_month",
    """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date,
  CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm FROM orders
""",
)
def compact_month(spark, sf_dir):
    """Months appended in three loads, two of them then rewritten: the same rows in fewer files."""
    path = work_dir(spark, "orders")
    orders = _orders(spark, sf_dir)
    for status in ("F", "O", "P"):
        written = append_by_month(orders.filter(F.col("o_orderstatus") == status), path, "order_date")
    compact_months(spark, path, written.months[:2], ["o_orderkey"])
    return spark.read.parquet(path)


@query(
    "compact_fragmented",
    """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date,
  CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm FROM orders
""",
)
def compact_by_size(spark, sf_dir):
    """Months in three files each, chosen and rewritten by the files' sizes; a second run finds nothing to do."""
    path = work_dir(spark, "fragmented")
    orders = _orders(spark, sf_dir)
    for part in range(3):
        append_by_month(orders.filter(F.col("o_orderkey") % 3 == part), path, "order_date")
    assert compact_fragmented(spark, path, sort=["o_orderkey"]) and not compact_fragmented(spark, path, sort=["o_orderkey"])
    return spark.read.parquet(path)


@query(
    "ansi_file",
    """
WITH s AS (SELECT s_suppkey % 10 AS d, s_suppkey AS code, s_name || ' ' || chr(8364) || ' ' || chr(8220) || 'n' || chr(241) || chr(8221) AS named, s_suppkey / 4 AS amount FROM supplier)
SELECT CASE WHEN d NOT IN (3, 7) THEN code END AS code, CASE WHEN d NOT IN (3, 7) THEN named END AS named, CASE WHEN d NOT IN (3, 7) THEN amount END AS amount,
  CASE d WHEN 3 THEN code || ';' || named WHEN 7 THEN code || ';' || named || ';1,5;more' END AS malformed FROM s
""",
)
def ansi_file(spark, sf_dir):
    """Suppliers written as an ANSI file with short and long lines among them: the sound lines, and the others as they stand."""
    path = work_dir(spark, "ansi")
    code, kind = F.col("s_suppkey"), F.col("s_suppkey") % 10
    # The bytes 0x80, 0x93 and 0x94 of the file are the euro sign and quotation marks.
    named = F.concat(F.col("s_name"), F.lit(" \x80 \x93n\xf1\x94"))
    amount = F.replace(F.format_string("%.2f", code / 4), F.lit("."), F.lit(","))
    line = F.concat_ws(";", code, named, F.when(kind == 7, F.lit("1,5;more")).when(kind != 3, amount))
    rows = table(spark, sf_dir, "supplier").select(line.alias("Code;Name;Amount"))
    # One column, so that nothing is quoted; every part has the header.
    rows.write.option("header", True).option("encoding", "ISO-8859-1").option("quote", "").option("sep", "\t").csv(path)
    columns = {"Code": "code", "Name": "named", "Amount": "amount"}
    sound = read_delimited(spark, path, columns, T.StructType.fromDDL("code bigint, named string, amount double"))
    return sound.unionByName(malformed_lines(spark, path).withColumnRenamed("line", "malformed"), allowMissingColumns=True)


@query(
    "bound_parameters",
    """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-03-01' AND o_orderstatus = 'F'
""",
)
def bound_parameters(spark, sf_dir):
    """SQL over a registered table with a date and a text bound as values."""
    view = f"orders_{uuid.uuid4().hex}"
    _orders(spark, sf_dir).createTempView(view)
    sql = f"SELECT o_orderkey, o_custkey, o_totalprice FROM {view} WHERE order_date >= :desde AND o_orderstatus = :estado"
    return sql_query(spark, sql, desde=dt.date(1997, 3, 1), estado="F")


@query(
    "insert_select_table",
    """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date,
  CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm FROM orders
""",
)
def insert_select_table(spark, sf_dir):
    """A table created by its schema, twice, and filled by two inserts whose columns come in another order."""
    name, path = f"orders_{uuid.uuid4().hex}", work_dir(spark, "registered")
    orders = _orders(spark, sf_dir)
    for _ in range(2):
        create_table(spark, name, orders.schema, path, MONTH)
    dated = orders.withColumn(MONTH, yyyymm("order_date"))
    turned = dated.select(*reversed(dated.columns))
    for part in (turned.filter("o_orderstatus = 'F'"), turned.filter("o_orderstatus <> 'F'")):
        # By month, so that a task does not write a file for each.
        insert_select(part.repartition(MONTH), name)
    rows = spark.read.schema(spark.table(name).schema).parquet(path)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return rows


@query(
    "report_export",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def report_export(spark, sf_dir):
    """A report written as csv, in several parts with a header each, and read back."""
    path = work_dir(spark, "report")
    report = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    write_report(report.repartition(3, "s_suppkey"), path)
    return spark.read.option("header", True).schema(report.schema).csv(path)
