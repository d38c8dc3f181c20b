"""Dimensions and their history over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.rates import widen_last_band
from ..operators.scd import apply_scd, current_rows, latest_per_key, scd_delta
from ..plans import dims
from ..plans.mart import Mart
from ..schemas import LIABILITY_RATES, MOTOR_COVERAGES, RATES
from ..sources.writers import full_refresh, versioned_append
from ..workdir import work_dir
from .registry import query, table
from .standins import RATE_HISTORY_SQL, coverage_flags, day, rate_history_sql, raw_rates, with_missing


def raw_intermediaries(spark, sf_dir):
    """Suppliers as intermediaries: organizers (3) and producers (4), some of them unused."""
    s = table(spark, sf_dir, "supplier")
    rows = s.select(
        F.col("s_suppkey").alias("ININNA"),
        F.when(F.col("s_nationkey") < 12, 3).otherwise(4).alias("ININTA"),
        (F.col("s_suppkey") + 1).alias("INNRDF"),
        F.when(F.col("s_acctbal") < 0, "LIBRE").otherwise(F.concat(F.lit(" "), F.upper("s_name"))).alias("DFNOMB"),
        F.col("s_nationkey").cast("bigint").alias("DFCOPO"),
    )
    return with_missing(rows, dims.INTERMEDIARY_COLUMNS)


@query(
    "dim_producers",
    """
SELECT s_suppkey AS CodProductor, s_suppkey + 1 AS NroPersonaProductor, ' ' || upper(s_name) AS Nombre, CAST(s_nationkey AS BIGINT) AS Cp
FROM supplier WHERE s_nationkey >= 12 AND s_acctbal >= 0
""",
)
def dim_producers(spark, sf_dir):
    """Every intermediary comes twice; the distinct ones remain."""
    raw = raw_intermediaries(spark, sf_dir)
    return dims.producers(raw.unionByName(raw)).select("CodProductor", "NroPersonaProductor", "Nombre", "Cp")


@query(
    "dim_organizers",
    """
SELECT s_suppkey AS CodOrganizador, s_suppkey + 1 AS NroPersona, upper(substr(s_name, 1, 1)) || lower(substr(s_name, 2)) AS Nombre,
  CAST(CASE WHEN n_regionkey <> 4 THEN n_nationkey END AS BIGINT) AS CodGrupo,
  CASE WHEN n_regionkey <> 4 THEN upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) END AS Grupo
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND s_acctbal > 1000
WHERE s_nationkey < 12 AND s_acctbal >= 0
""",
)
def dim_organizers(spark, sf_dir):
    """Suppliers above a balance belong to a group, their nation; one region has no groups."""
    s = table(spark, sf_dir, "supplier").filter("s_acctbal > 1000")
    members = s.select(F.col("s_suppkey").alias("GJINTE"), F.col("s_nationkey").alias("GJGRUP"))
    n = table(spark, sf_dir, "nation").filter("n_regionkey <> 4")
    groups = n.select(
        F.col("n_nationkey").cast("bigint").alias("GPGRUP"), F.concat(F.lower("n_name"), F.lit("  ")).alias("GPNOGR")
    )
    rows = dims.organizers(raw_intermediaries(spark, sf_dir), members, groups)
    return rows.select("CodOrganizador", "NroPersona", "Nombre", "CodGrupo", "Grupo")


@query(
    "dim_localities",
    """
SELECT c_custkey AS Cp, CAST(c_nationkey AS BIGINT) AS CpSufijo, upper(substr(c_name, 1, 1)) || lower(substr(c_name, 2)) AS Localidad,
  CAST(c_nationkey AS VARCHAR) AS CodProvinciaStr, CAST(n_regionkey AS BIGINT) AS CodProvInder,
  upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS Provincia
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 4
""",
)
def dim_localities(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    places = c.select(
        F.col("c_custkey").alias("LOCOPO"),
        F.col("c_nationkey").cast("bigint").alias("LOCOPS"),
        F.concat(F.lit("\t"), F.lower("c_name")).alias("LOLOCA"),
        F.col("c_nationkey").cast("string").alias("LOPROC"),
    )
    n = table(spark, sf_dir, "nation").filter("n_regionkey <> 4")
    provinces = n.select(
        F.col("n_nationkey").cast("string").alias("PRPROC"),
        F.col("n_regionkey").cast("bigint").alias("PRRPRO"),
        F.col("n_name").alias("PRPROD"),
    )
    return dims.localities(places, provinces)


@query(
    "dim_coverages_latest",
    """
SELECT p_partkey AS CodCobertura, p_type AS CatCobertura, p_retailprice + CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS Pormilaje,
  CAST(CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS INTEGER) AS version FROM part
""",
)
def dim_coverages_latest(spark, sf_dir):
    """Two versioned appends, the second of a part of the rows; the latest version counts."""
    path = work_dir(spark, "coverages")
    p = table(spark, sf_dir, "part")
    first = p.select(F.col("p_partkey").alias("CodCobertura"), F.col("p_type").alias("CatCobertura"), F.col("p_retailprice").alias("Pormilaje"), "p_size")
    versioned_append(first.drop("p_size"), path, 1)
    second = first.filter("p_size > 25").withColumn("Pormilaje", F.col("Pormilaje") + 1).drop("p_size")
    versioned_append(second, path, 2)
    return latest_per_key(spark.read.parquet(path), ["CodCobertura"], ["version", "Pormilaje"])


@query("guarded_refresh", "SELECT p_partkey, p_type, p_retailprice + 1 AS p_retailprice FROM part")
def guarded_refresh(spark, sf_dir):
    """A refresh, one from an empty source that changes nothing, and one that replaces every row."""
    path = work_dir(spark, "refresh")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    full_refresh(p, path, guard_empty=True)
    assert not full_refresh(p.limit(0), path, guard_empty=True)
    full_refresh(p.withColumn("p_retailprice", F.col("p_retailprice") + 1), path, guard_empty=True)
    return spark.read.parquet(path)


@query(
    "latest_event_per_user",
    """
SELECT user_id, event_id, event_type, value, CAST(ts AS DATE) AS day FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""",
)
def latest_event_per_user(spark, sf_dir):
    newest = latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", "value", day("ts").alias("day"))


def _part_versions(spark, sf_dir):
    """Current rates per part, and a source that changes some, dates others earlier and adds new ones."""
    p = table(spark, sf_dir, "part")
    current = p.select(
        F.col("p_partkey").alias("NumTarifa"),
        F.col("p_size").cast("bigint").alias("AntMinima"),
        F.col("p_retailprice").alias("TasaAnual"),
        F.lit("2024-06-01").cast("date").alias("fecha_desde"),
    )
    changed = p.select(
        F.when(F.col("p_type") == "SMALL", -F.col("p_partkey") - 1).otherwise(F.col("p_partkey")).alias("NumTarifa"),
        F.col("p_size").cast("bigint").alias("AntMinima"),
        F.when(F.col("p_type").isin("PROMO", "LARGE"), F.col("p_retailprice") + 10).otherwise(F.col("p_retailprice")).alias("TasaAnual"),
        F.when(F.col("p_type") == "LARGE", F.lit("2024-05-01")).otherwise(F.lit("2024-07-01")).cast("date").alias("fecha_desde"),
    )
    return current, changed


_DELTA_SQL = """
SELECT CASE WHEN p_type = 'SMALL' THEN -p_partkey - 1 ELSE p_partkey END AS NumTarifa, CAST(p_size AS BIGINT) AS AntMinima,
  CASE WHEN p_type = 'PROMO' THEN p_retailprice + 10 ELSE p_retailprice END AS TasaAnual, DATE '2024-07-01' AS fecha_desde
FROM part WHERE p_type IN ('PROMO', 'SMALL')"""


@query("scd_delta", _DELTA_SQL)
def delta(spark, sf_dir):
    """New keys and newer changes; unchanged rows and older changes are left out."""
    current, changed = _part_versions(spark, sf_dir)
    return scd_delta(changed, current, ["NumTarifa"], ["AntMinima", "TasaAnual"], "fecha_desde")


@query(
    "scd_current",
    f"""
WITH delta AS ({_DELTA_SQL})
SELECT * FROM delta UNION ALL
SELECT p_partkey, CAST(p_size AS BIGINT), p_retailprice, DATE '2024-06-01' FROM part WHERE p_type <> 'PROMO'
""",
)
def scd_current(spark, sf_dir):
    """One current row per key after the delta joined the history."""
    current, changed = _part_versions(spark, sf_dir)
    found = scd_delta(changed, current, ["NumTarifa"], ["AntMinima", "TasaAnual"], "fecha_desde")
    return current_rows(apply_scd(current, found), ["NumTarifa"], "fecha_desde", "TasaAnual")


@query("widen_last_band", f"WITH {RATE_HISTORY_SQL} SELECT * FROM rate_history")
def widen(spark, sf_dir):
    """The last age segment of each tariff, chapter and coverage reaches 200 years."""
    named = raw_rates(spark, sf_dir).select(*[F.col(s).alias(n) for s, n in dims.RATE_COLUMNS.items()])
    return widen_last_band(named, ["NumTarifa", "Cap", "Air", "CodCobertura"], "segmento_ant", "AntMaxima")


def _two_loads_sql(first: str, second: str, keys, values) -> str:
    """Current rows after a history took in `first` and then the new and changed rows of `second`."""
    same_key = " AND ".join(f"c.{k} = s.{k}" for k in keys)
    changed = " OR ".join(f"c.{v} <> s.{v}" for v in values)

    def latest(rows: str) -> str:
        order = ", ".join(f"{v} DESC" for v in ["fecha_desde", *values])
        return f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn FROM {rows}) WHERE rn = 1"""

    return f"""
c1 AS ({latest(first)}),
delta AS (SELECT s.* FROM {second} s LEFT JOIN c1 c ON {same_key} WHERE c.{keys[0]} IS NULL OR (({changed}) AND s.fecha_desde > c.fecha_desde)),
history AS (SELECT * FROM {first} UNION ALL SELECT * FROM delta)
{latest('history')}"""


@query(
    "rates_load",
    f"""
WITH {rate_history_sql("(SELECT * FROM part WHERE p_size <= 25)", "first_load")}, {rate_history_sql("part", "second_load")},
{_two_loads_sql("first_load", "second_load", RATES.keys, dims.RATE_VALUES)}
""",
)
def rates_load(spark, sf_dir):
    """Current rates after a load of the smaller parts and one of all; the first widens other bands."""
    mart = Mart(spark, work_dir(spark, "rates"))
    flags = coverage_flags(spark, sf_dir)
    dims.load_motor_coverages(mart, with_missing(flags, MOTOR_COVERAGES.columns[:-1]), dt.datetime(2024, 1, 1))
    raw = raw_rates(spark, sf_dir)
    dims.load_rates(mart, raw.filter("p_size <= 25"))
    return dims.load_rates(mart, raw)


def _raw_liability(spark, sf_dir):
    price = F.col("p_retailprice")
    return table(spark, sf_dir, "part").select(
        F.substring("p_brand", 7, 9).cast("bigint").alias("NumTarifa"),
        F.expr("p_partkey DIV 200").alias("Cap"),
        (F.col("p_partkey") % 7).alias("Var"),
        *[(price * n).alias(c) for n, c in enumerate(dims.LIABILITY_VALUES, 1)],
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("p_partkey") % 1000).cast("int")).alias("Fecha"),
        "p_type",
    )


_LIABILITY_SQL = f"""
loads AS (SELECT CAST(substr(p_brand, 7) AS BIGINT) AS NumTarifa, p_partkey // 200 AS Cap, p_partkey % 7 AS Var,
  {', '.join(f'p_retailprice * {n} AS {c}' for n, c in enumerate(dims.LIABILITY_VALUES, 1))},
  DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS fecha_desde, p_type FROM part),
first_load AS (SELECT * EXCLUDE p_type FROM loads WHERE p_type IN ('PROMO', 'LARGE')),
second_load AS (SELECT * EXCLUDE p_type FROM loads)"""


@query(
    "liability_rates_load",
    f"WITH {_LIABILITY_SQL}, {_two_loads_sql('first_load', 'second_load', LIABILITY_RATES.keys, dims.LIABILITY_VALUES)}",
)
def liability_rates_load(spark, sf_dir):
    """Current liability rates after a load of some part types and one of all."""
    mart = Mart(spark, work_dir(spark, "liability"))
    raw = _raw_liability(spark, sf_dir)
    dims.load_liability_rates(mart, raw.filter("p_type IN ('PROMO', 'LARGE')").drop("p_type"))
    return dims.load_liability_rates(mart, raw.drop("p_type"))
