"""Reports over the mart's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_back, from_month, month_start
from ..operators.controls import MOTOR_BRANCHES, commission_control, compare_commissions, missing_matches
from ..operators.keyed import join_unique
from ..operators.profiles import agent_profile, movements, result_profile
from ..operators.rates import (
    REPORT_LIMITS,
    portfolio_premiums,
    prorate_risks,
    rate_band_join,
)
from ..operators.rollup import control_row
from ..operators.scd import latest_per_key
from ..operators.stats import best_by_metric, monthly_summary
from ..schemas import (
    DAILY_VEHICLES,
    CLAIM_PAYMENTS,
    CLAIM_REPORTS,
    MOTOR_PREMIUMS,
    OPERATIONS,
    ORGANIZERS,
    PRODUCERS,
    RATES_BY_RISK,
    SNAPSHOTS,
)
from ..sources.writers import full_refresh
from .dims import current_persons
from .mart import Mart

# The coverage without own damage, the tariff that stands for none, the report's
# keys, the first month of the commission comparison, and the settings of the commission control.
LIABILITY_ONLY = "A2"
DEFAULT_TARIFF = 11
COMPONENT = ["CodRama", "Poliza", "Comp"]
RATE_KEY = ["NumTarifa", "Cap", "Air", "CodCobertura"]
INCOME = ["PrimaNeta", "RecAdm", "RecFin", "RecCapital"]
COMPARED_FROM = 202506
CONTROL_BRANCH, OWN_PRODUCER, COMMISSION_TYPE, LOWEST_DISCOUNT = 4, 9999, 4, 10.0


def vehicles_in_force(snapshots: DataFrame, day: dt.date) -> DataFrame:
    """One day's vehicles with own-damage cover."""
    chosen = snapshots.filter((F.col("Fecha") == F.lit(day)) & (F.col("CodCoberturaAut") != LIABILITY_ONLY))
    return chosen.select(
        F.col("TarifaHija").alias("NumTarifa"),
        "CodRama",
        "Poliza",
        F.col("Componente").alias("Comp"),
        F.col("CodCoberturaAut").alias("CodCobertura"),
        "Ant",
        "CvaCapitulo",
        "CvaVariante",
    )


def component_premiums(premiums: DataFrame, day: dt.date, days: int) -> DataFrame:
    """Last attributes and own-damage premium of each component in the days up to `day`."""
    recent = premiums.filter(days_back("FEmision", day, days))
    latest = {"Cap": "Cap", "Var": "Var", "Air": "Air", "Sa": "SaComponente"}
    return portfolio_premiums(recent, COMPONENT, ["Supl", "FEmision", "Op"], latest, ("PrimaNeta", "PrimaCascoNetaComp"))


def usable_rates(rates: DataFrame) -> DataFrame:
    return rates.filter(F.col("TasaAnual").between(*REPORT_LIMITS))


def vehicles_with_premiums(vehicles: DataFrame, premiums: DataFrame) -> DataFrame:
    """Vehicles with the premium of their component; tariff 0 stands for the default one."""
    joined = join_unique(vehicles, premiums, COMPONENT, "inner")
    tariff = F.when(F.col("NumTarifa") == 0, F.lit(DEFAULT_TARIFF)).otherwise(F.col("NumTarifa"))
    return joined.withColumn("NumTarifa", tariff)


def risk_premiums(vehicle_premiums: DataFrame, rates: DataFrame) -> DataFrame:
    """Each vehicle's premium split by risk, with the rate of its tariff, cover and age."""
    banded = rate_band_join(vehicle_premiums, rates, RATE_KEY, "Ant", "AntMinima", "AntMaxima")
    kept = ["NumTarifa", "CodRama", "Poliza", "Comp", "CodCobertura", "Ant", "Sa", "PrimaNeta", "TasaAnual"]
    split = prorate_risks(banded, "PrimaNeta", "TasaAnual")
    return split.select(
        *kept, "Rt", "It", "Rp", "Ip", "At", "Ap", "Total", "Parcial", "Robo", "Incendio", "Accidente"
    )


def risk_premium_report(mart: Mart, day: dt.date, days: int) -> DataFrame:
    vehicles = vehicles_in_force(mart.table(SNAPSHOTS), day)
    premiums = component_premiums(mart.table(MOTOR_PREMIUMS), day, days)
    return risk_premiums(vehicles_with_premiums(vehicles, premiums), usable_rates(mart.table(RATES_BY_RISK)))


def vehicles_without_premium(vehicles: DataFrame, premiums: DataFrame) -> DataFrame:
    return missing_matches(vehicles, premiums, COMPONENT)


def premiums_without_rate(vehicle_premiums: DataFrame, rates: DataFrame) -> DataFrame:
    return missing_matches(vehicle_premiums, rates, RATE_KEY)


def current_organizers(mart: Mart) -> DataFrame:
    """One row per code: an organizer in several groups is reported under the highest one."""
    return latest_per_key(mart.table(ORGANIZERS), ORGANIZERS.keys, ["CodGrupo", "NroPersona", "Nombre"])


def current_producers(mart: Mart) -> DataFrame:
    return latest_per_key(mart.table(PRODUCERS), PRODUCERS.keys, ["NroPersonaProductor", "Nombre"])


def _rollup(mart: Mart, name: str) -> DataFrame:
    return mart.spark.read.parquet(mart.path(name))


def person_profile(mart: Mart) -> DataFrame:
    """Premium against claims per person, branch, organizer, producer and month, from the rollups
    that the loads keep at just this grain."""
    keys = ["CodRama", "CodOrganizador", "CodProductor", "NroAsegurado"]
    income = movements(_rollup(mart, "sehpm151t_perfiles_agg"), "FEmisionMes", keys, {m: m for m in INCOME})
    paid = movements(_rollup(mart, "sinpagt_perfiles_agg"), "FechaPagoMes", keys, {"ImporteSiniestro": "Importe"})
    rows = income.unionByName(paid, allowMissingColumns=True)
    return result_profile(
        rows, current_persons(mart), current_producers(mart), current_organizers(mart), ["CodRama"], INCOME, "ImporteSiniestro"
    )


def agents_profile(mart: Mart) -> DataFrame:
    """Premium, claims and claim reports per month, branch, organizer and producer."""
    operations = _rollup(mart, "sehpm151t_perfiles_agg").withColumnRenamed("FEmisionMes", "FechaMes")
    paid = _rollup(mart, "sinpagt_agentes_agg").withColumnsRenamed(
        {"FechaPagoMes": "FechaMes", "Importe": "ImporteSiniestro", "siniestros_pagados": "SiniestrosPagados"}
    )
    reports = mart.table(CLAIM_REPORTS).select(
        month_start("FechaDenuncia").alias("FechaMes"), "CodRama", "CodOrganizador", "CodProductor",
        F.lit(1).alias("Denuncias"),
    )
    return agent_profile(
        operations, paid, reports, current_organizers(mart), current_producers(mart), INCOME, "ImporteSiniestro"
    )


def load_agents_profile(mart: Mart) -> None:
    """Replace the agents' profile table."""
    full_refresh(agents_profile(mart), mart.path("ss_perfil_agentes"))


def monthly_vehicle_counts(mart: Mart) -> DataFrame:
    """Reads the counts per day that the snapshot load keeps, not the snapshots."""
    return monthly_summary(mart.table(DAILY_VEHICLES), "Fecha", "cantidad").orderBy(F.desc("Mes"))


def best_postal_suffix(mart: Mart) -> DataFrame:
    """The suffix with the highest premium of each province and postcode."""
    new_business = mart.table(OPERATIONS).filter(F.col("CodTipoOp") <= 2)
    best = best_by_metric(new_business, ["ProvinciaAsegurado", "CpAsegurado"], "CpSufijoAsegurado", "PrimaNeta")
    return best.select(
        F.col("ProvinciaAsegurado").alias("Provincia"),
        F.col("CpAsegurado").alias("Cp"),
        F.col("CpSufijoAsegurado").alias("CpSufijo"),
    ).orderBy("Cp")


def claim_payments_control(mart: Mart) -> DataFrame:
    rollup = mart.spark.read.parquet(mart.path("sinpagt_perfiles_agg"))
    return control_row(mart.table(CLAIM_PAYMENTS), "FechaPago", rollup, "FechaPagoMes")


def operations_without_commission(operations: DataFrame, commissions: DataFrame) -> DataFrame:
    """Motor operations without commission row whose discount is low, highest policy first.

    `operations` has CodProductorCom, BonifPrima and PrimaTarifa; `commissions` ICOPER, ICSUOP, ICTINT.
    """
    eligible = (
        (F.col("CodRama") == CONTROL_BRANCH)
        & (F.col("CodProductor") != OWN_PRODUCER)
        & (F.col("CodProductor") == F.col("CodProductorCom"))
        & (F.col("PrimaNeta") != 0)
    )
    paid = commissions.withColumnsRenamed({"ICOPER": "Op", "ICSUOP": "Suplemento"})
    found = commission_control(
        operations, paid, ["Op", "Suplemento"], ("ICTINT", COMMISSION_TYPE), eligible, "BonifPrima",
        "PrimaTarifa", LOWEST_DISCOUNT,
    )
    wanted = ["FEmision", "Op", "CodRama", "Poliza", "Suplemento", "CodProductor", "PrimaNeta", "%Bonif."]
    return found.select(*[F.col(f"`{c}`") for c in wanted]).orderBy(F.desc("Poliza"))


def compared_operations(raw: DataFrame, since: int = COMPARED_FROM) -> DataFrame:
    """New motor policies since a month that have a producer's commission, for the comparison with
    the regulator's list. `raw` has the operational source's column names."""
    chosen = raw.filter(
        F.col("M1RAMA").isin(*MOTOR_BRANCHES)
        & F.col("ComProd").isNotNull()
        & from_month("M1FEMA", "M1FEMM", dt.date(since // 100, since % 100, 1))
        & (F.col("M1SUOP") == 0)
    )
    return chosen.select(
        F.col("M1RAMA").alias("cod_rama"),
        F.col("M1POLI").alias("nro_poliza"),
        F.col("M1ORG1").alias("cod_org"),
        F.col("M1PRO1").alias("cod_prod"),
        (F.col("MABPRE") + F.col("MAPRIM")).alias("prima_tarifa"),
        F.col("MABPRE").alias("bon_prima"),
        F.col("MAPRIM").alias("prima_neta"),
        F.col("ComOrg").alias("com_org"),
        F.col("ComProd").alias("com_prod"),
    )


def commission_comparison(mart: Mart, listed: DataFrame, raw: DataFrame) -> DataFrame:
    return compare_commissions(listed, compared_operations(raw), current_producers(mart), current_organizers(mart))
