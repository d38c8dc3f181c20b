"""Dimension loads: organizers, producers, localities, coverages, persons, liability rates, rates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_name
from ..operators import identity
from ..operators.rates import decompose_rates, widen_last_band
from ..operators.scd import current_rows, scd_delta
from ..schemas import (
    LIABILITY_RATES,
    LOCALITIES,
    MOTOR_COVERAGES,
    ORGANIZERS,
    OTHER_COVERAGES,
    PERSONS,
    PRODUCERS,
    RATES,
    RATES_BY_RISK,
    Table,
)
from ..sources import versions
from ..sources.readers import cast_to
from ..sources.versions import append_difference
from ..sources.writers import full_refresh, stage, staged, write_report
from .mart import Mart

# Source column -> mart column, intermediary types and the unused name.
INTERMEDIARY_COLUMNS = {
    "DFNOMB": "Nombre",
    "DFDOMI": "Domicilio",
    "DFCOPO": "Cp",
    "DFCOPS": "CpSufijo",
    "LOLOCA": "Localidad",
    "LOPROC": "CodProvincia",
    "DFTIDO": "TipoDoc",
    "DFNRDO": "NroDoc",
    "DFCUIT": "Cuit",
    "PRPROD": "Provincia",
    "PRRPRO": "CodInderProvincia",
    "INMATR": "Matricula",
}
PERSON_COLUMNS = {
    "DFNRDF": "NroPersona",
    "DFNOMB": "Nombre",
    "DFDOMI": "Domicilio",
    "DFCOPO": "Cp",
    "DFCOPS": "CpSufijo",
    "DFNRDO": "NroDocumento",
    "DFCUIT": "Cuit",
    "DFFNAC": "FechaNac",
    "DFSEXO": "Sexo",
    "DFBLOQ": "Bloqueado",
    "DFNRD1": "Grupo",
}
RATE_COLUMNS = {
    "NumTarifa": "NumTarifa",
    "Cap": "Cap",
    "Air": "Air",
    "CodCobertura": "CodCobertura",
    "Ant_": "segmento_ant",
    "Min": "AntMinima",
    "Max": "AntMaxima",
    "Tasa": "TasaAnual",
    "Fecha": "fecha_desde",
}
ORGANIZER_TYPE, PRODUCER_TYPE = 3, 4
FREE_NAME = "LIBRE"
RATE_KEYS = list(RATES.keys)
RATE_VALUES = ["AntMinima", "AntMaxima", "TasaAnual"]
LIABILITY_VALUES = ["RcSl", "RcCl", "RcExt", "RcAp", "RcObl"]


def _named(columns: dict[str, str]) -> list[Column]:
    return [F.col(source).alias(name) for source, name in columns.items()]


def _in_use(intermediaries: DataFrame, kind: int) -> DataFrame:
    return intermediaries.filter((F.col("ININTA") == kind) & (F.col("DFNOMB") != FREE_NAME))


def organizers(intermediaries: DataFrame, memberships: DataFrame, groups: DataFrame) -> DataFrame:
    """Organizers in use with their group. An organizer in two groups has two rows."""
    rows = _in_use(intermediaries, ORGANIZER_TYPE)
    member = memberships.select(F.col("GJINTE").alias("ININNA"), "GJGRUP")
    group = groups.select(F.col("GPGRUP").alias("GJGRUP"), F.col("GPGRUP").alias("CodGrupo"), F.col("GPNOGR").alias("Grupo"))
    joined = rows.join(member, "ININNA", "left").join(group, "GJGRUP", "left")
    named = joined.select(
        F.col("ININNA").alias("CodOrganizador"),
        F.col("INNRDF").alias("NroPersona"),
        *_named(INTERMEDIARY_COLUMNS),
        "CodGrupo",
        "Grupo",
    )
    return named.withColumns({"Nombre": clean_name("Nombre"), "Grupo": clean_name("Grupo")}).distinct()


def producers(intermediaries: DataFrame) -> DataFrame:
    return (
        _in_use(intermediaries, PRODUCER_TYPE)
        .select(
            F.col("ININNA").alias("CodProductor"),
            F.col("INNRDF").alias("NroPersonaProductor"),
            *_named(INTERMEDIARY_COLUMNS),
        )
        .distinct()
    )


def localities(places: DataFrame, provinces: DataFrame) -> DataFrame:
    """Places with the name of their province, where it is known."""
    province = provinces.select(
        F.col("PRPROC").alias("LOPROC"), F.col("PRRPRO").alias("CodProvInder"), F.col("PRPROD").alias("Provincia")
    )
    return places.join(province, "LOPROC", "left").select(
        F.col("LOCOPO").alias("Cp"),
        F.col("LOCOPS").alias("CpSufijo"),
        clean_name("LOLOCA").alias("Localidad"),
        F.col("LOPROC").alias("CodProvinciaStr"),
        "CodProvInder",
        clean_name("Provincia").alias("Provincia"),
    )


def load_organizers(mart: Mart, intermediaries: DataFrame, memberships: DataFrame, groups: DataFrame) -> None:
    rows = cast_to(organizers(intermediaries, memberships, groups), ORGANIZERS.schema)
    full_refresh(rows, mart.path(ORGANIZERS.name))


def load_producers(mart: Mart, intermediaries: DataFrame) -> None:
    full_refresh(cast_to(producers(intermediaries), PRODUCERS.schema), mart.path(PRODUCERS.name))


def load_localities(mart: Mart, places: DataFrame, provinces: DataFrame) -> None:
    full_refresh(cast_to(localities(places, provinces), LOCALITIES.schema), mart.path(LOCALITIES.name))


def _microseconds(at: dt.datetime) -> int:
    return int(at.timestamp() * 1_000_000)


def _unversioned(table: Table) -> T.StructType:
    return T.StructType([f for f in table.schema.fields if f.name != versions.VERSION])


def _cast_unversioned(rows: DataFrame, table: Table) -> DataFrame:
    return cast_to(rows, _unversioned(table))


def load_motor_coverages(mart: Mart, rows: DataFrame, version: dt.datetime) -> None:
    """Append the coverages that are new, changed or gone."""
    append_difference(
        _cast_unversioned(rows, MOTOR_COVERAGES), mart.path(MOTOR_COVERAGES.name), MOTOR_COVERAGES.keys,
        _microseconds(version), ties=["OrCobertura"],
    )


def motor_coverages(mart: Mart) -> DataFrame:
    """Latest version of each coverage."""
    return versions.current(mart.spark, mart.path(MOTOR_COVERAGES.name), _unversioned(MOTOR_COVERAGES), MOTOR_COVERAGES.keys)


def load_other_coverages(mart: Mart, rows: DataFrame) -> bool:
    """An empty source leaves the loaded coverages as they are."""
    return full_refresh(cast_to(rows, OTHER_COVERAGES.schema), mart.path(OTHER_COVERAGES.name), guard_empty=True)


def load_persons(mart: Mart, raw: DataFrame, loaded_at: dt.datetime, strict_reference: bool = False) -> int:
    """Append a version of every person that is new, changed or gone; returns how many there are.

    The version is the load's time in microseconds. A person that did not change keeps the time of the
    load that last changed it.
    """
    persons = identity.resolve_persons(raw.select(*_named(PERSON_COLUMNS)), strict_reference)
    version = _microseconds(loaded_at)
    rows = _cast_unversioned(persons.withColumn("last_update", F.lit(loaded_at)), PERSONS)
    return append_difference(rows, mart.path(PERSONS.name), PERSONS.keys, version, ["last_update"], ["persona_key"])


PERSON_REPORTS = {
    "several_unblocked": identity.groups_with_several_unblocked,
    "heads_in_another_group": identity.heads_in_another_group,
    "blocked_heads": identity.blocked_heads,
    "group_members": identity.group_member_lists,
    "duplicates_without_group": identity.duplicates_without_group,
    "incoherent_groups": identity.incoherent_groups,
}


def write_person_reports(mart: Mart, raw: DataFrame) -> None:
    """The data-quality reports on persons. The source is read once for all of them."""
    with staged(identity.normalise_persons(raw.select(*_named(PERSON_COLUMNS))), "persons") as persons:
        for name, report in PERSON_REPORTS.items():
            write_report(report(persons), mart.path(f"person_reports/{name}"), "parquet")


def current_persons(mart: Mart) -> DataFrame:
    """Every person as last loaded."""
    return versions.current(mart.spark, mart.path(PERSONS.name), _unversioned(PERSONS), PERSONS.keys)


def compact_persons(mart: Mart) -> None:
    """Drop the persons' versions that no reader of the current ones needs."""
    versions.compact_versions(mart.spark, mart.path(PERSONS.name), _unversioned(PERSONS), PERSONS.keys)


def _load_history(mart: Mart, table: Table, rows: DataFrame, compare: list[str], ties: list[str]) -> DataFrame:
    source = cast_to(rows, table.schema)
    history = mart.table(table)
    current = current_rows(history, table.keys, table.date_col, *ties)
    delta = scd_delta(source, current, table.keys, compare, table.date_col)
    delta.write.mode("append").parquet(mart.path(table.name))
    return current_rows(mart.table(table), table.keys, table.date_col, *ties)


def load_liability_rates(mart: Mart, raw: DataFrame) -> DataFrame:
    """Append new and changed rates to the history; returns the current ones."""
    rows = raw.withColumnRenamed("Fecha", "fecha_desde")
    return _load_history(mart, LIABILITY_RATES, rows, LIABILITY_VALUES, LIABILITY_VALUES)


def prepare_rates(raw: DataFrame) -> DataFrame:
    named = raw.select(*_named(RATE_COLUMNS))
    return widen_last_band(named, ["NumTarifa", "Cap", "Air", "CodCobertura"], "segmento_ant", "AntMaxima")


def load_rates(mart: Mart, raw: DataFrame) -> DataFrame:
    """Append new and changed rates to the history, then renew their split by risk."""
    # Read by the pivot, by the split and by the caller.
    current = stage(_load_history(mart, RATES, prepare_rates(raw), RATE_VALUES, RATE_VALUES), "rates")
    split = cast_to(decompose_rates(current, motor_coverages(mart)), RATES_BY_RISK.schema)
    full_refresh(split, mart.path(RATES_BY_RISK.name))
    return current
