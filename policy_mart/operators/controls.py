"""Controls: missing matches, commissions, and filling in cases from the portfolio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent
from ..functions.text import leading_number
from .keyed import join_unique, not_in, present_in, unique_keys
from .scd import latest_per_key, upsert_columns

# The motor branches, the digits of a policy number, columns of a case, the regulator's motor code.
MOTOR_BRANCHES = (4, 44)
POLICY_DIGITS = 7
INTERMEDIARIES = ("cod_productor", "nom_productor", "cod_organizador", "nom_organizador")
REGULATOR_MOTOR_CODE, MOTOR_BRANCH, OTHER_MOTOR_BRANCH = 1030, 4, 44


def missing_matches(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of `left` without a match in `right`."""
    return not_in(left, right, keys)


def missing_summary(missing: DataFrame, all_up_to: int = 5, seed: int | None = None) -> DataFrame:
    """The report on missing rows: their number, with all of them when there are few (at most
    `all_up_to`) and one at random otherwise. Without missing rows the result is empty."""
    total = missing.agg(F.count(F.lit(1))).scalar()
    few = missing.orderBy(F.rand() if seed is None else F.rand(seed)).limit(all_up_to)
    rows = few.agg(F.collect_list(F.struct("*")).alias("rows")).withColumn("Faltantes", total)
    shown = F.when(F.col("Faltantes") <= all_up_to, F.col("rows")).otherwise(F.slice("rows", 1, 1))
    return rows.select("Faltantes", F.inline(shown))


def commission_control(
    operations: DataFrame,
    commissions: DataFrame,
    keys: Sequence[str],
    commission_type: tuple[str, int],
    eligible: Column,
    discount: str,
    tariff: str,
    below: float,
    ratio: str = "%Bonif.",
) -> DataFrame:
    """Eligible operations without a commission row of the given type and with a discount, as a
    percentage of the tariff premium, below a limit. `commissions` names its keys like `operations`.

    A tariff premium of zero gives no percentage and drops the row.
    """
    column, wanted = commission_type
    paid = commissions.filter(F.col(column) == wanted)
    chosen = operations.filter(eligible).withColumn(ratio, percent(discount, tariff))
    return not_in(chosen.filter(F.col(f"`{ratio}`") < below), paid, keys)


def regulator_branch(code: Column) -> Column:
    return F.when(code == REGULATOR_MOTOR_CODE, F.lit(MOTOR_BRANCH)).otherwise(F.lit(OTHER_MOTOR_BRANCH))


def compare_commissions(
    listed: DataFrame, operations: DataFrame, producers: DataFrame, organizers: DataFrame
) -> DataFrame:
    """The regulator's policy list with our premiums and commissions, absolute and in percent.

    Every listed policy stays, with nulls where we have no operation for it; a policy with several
    operations gives several rows. Percentages of a zero premium are null.
    """
    wanted = listed.select(
        F.col("codigo_ramo").alias("cod_ramo_ssn"),
        regulator_branch(F.col("codigo_ramo")).alias("cod_rama"),
        F.col("nro_poliza").cast("bigint").alias("nro_poliza"),
    )
    by_org = organizers.select(F.col("CodOrganizador").alias("cod_org"), F.col("Nombre").alias("nom_org"))
    by_prod = producers.select(F.col("CodProductor").alias("cod_prod"), F.col("Nombre").alias("nom_prod"))
    named = join_unique(join_unique(operations, by_org, ["cod_org"]), by_prod, ["cod_prod"])
    both = F.col("com_org") + F.col("com_prod")
    return wanted.join(named, ["cod_rama", "nro_poliza"], "left").select(
        "cod_ramo_ssn", "cod_rama", "nro_poliza", "prima_tarifa", "bon_prima", "prima_neta",
        "cod_org", "nom_org", "cod_prod", "nom_prod",
        "com_org", percent("com_org", "prima_neta").alias("%com_org"),
        "com_prod", percent("com_prod", "prima_neta").alias("%com_prod"),
        both.alias("com_total"), percent(both, "prima_neta").alias("%com_total"),
    ).orderBy("cod_rama", "nro_poliza")


def _one_row_per_policy(rows: DataFrame, wanted: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    motor = rows.filter(F.col("CodRama").isin(*MOTOR_BRANCHES))
    return latest_per_key(present_in(motor, wanted, ["NroPoliza"]), ["NroPoliza"], order_cols)


def enrich_cases(
    cases: DataFrame, snapshots: DataFrame, persons: DataFrame, producers: DataFrame, organizers: DataFrame,
    ties: Sequence[str] = (),
) -> DataFrame:
    """The cases with `client_updates`. All cases of such a policy are updated."""
    updates = client_updates(cases, snapshots, persons, producers, organizers, ties)
    return upsert_columns(cases, updates, "poliza", [*INTERMEDIARIES, "cliente"])


def client_updates(
    cases: DataFrame, snapshots: DataFrame, persons: DataFrame, producers: DataFrame, organizers: DataFrame,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Client, producer and organizer for the policies of active cases that lack a client, one row per policy.

    They come from the newest snapshot row (CodRama, Poliza, Fecha, NroAsegurado, CodProductor,
    CodOrganizador) of the policy in the motor branches.
    """
    pending = _numbered(cases.filter((F.col("cliente") == "") & (F.col("activa") == 1)))
    rows = snapshots.withColumnRenamed("Poliza", "NroPoliza")
    newest = _one_row_per_policy(rows, pending, ["Fecha", *ties])
    clients = persons.select(F.col("NroPersona").alias("NroAsegurado"), F.col("Nombre").alias("cliente"))
    found = join_unique(newest.select("NroPoliza", "NroAsegurado", "CodProductor", "CodOrganizador"), clients, ["NroAsegurado"])
    return _updates(pending, found, producers, organizers, ["cliente"])


def enrich_case_producers(
    cases: DataFrame, operations: DataFrame, producers: DataFrame, organizers: DataFrame,
    order_cols: Sequence[str],
) -> DataFrame:
    """The cases with `producer_updates`."""
    updates = producer_updates(cases, operations, producers, organizers, order_cols)
    return upsert_columns(cases, updates, "poliza", INTERMEDIARIES)


def producer_updates(
    cases: DataFrame, operations: DataFrame, producers: DataFrame, organizers: DataFrame,
    order_cols: Sequence[str],
) -> DataFrame:
    """Producer and organizer for the policies of active cases without a producer, from an operation (CodRama,
    Poliza, CodProductor, CodOrganizador) of the policy; `order_cols` decides which one."""
    pending = _numbered(cases.filter(F.col("cod_productor").isNull() & (F.col("activa") == 1)))
    rows = operations.withColumnRenamed("Poliza", "NroPoliza")
    chosen = _one_row_per_policy(rows, pending, order_cols)
    found = chosen.select("NroPoliza", "CodProductor", "CodOrganizador")
    return _updates(pending, found, producers, organizers, [])


def _numbered(pending: DataFrame) -> DataFrame:
    """Different policies of the pending cases with their number; other text is skipped."""
    number = leading_number("poliza", POLICY_DIGITS)
    return unique_keys(pending, ["poliza"]).withColumn("NroPoliza", number).dropna(subset=["NroPoliza"])


def _updates(
    pending: DataFrame, found: DataFrame, producers: DataFrame, organizers: DataFrame, more: Sequence[str]
) -> DataFrame:
    by_prod = producers.select("CodProductor", F.col("Nombre").alias("nom_productor"))
    by_org = organizers.select("CodOrganizador", F.col("Nombre").alias("nom_organizador"))
    named = join_unique(join_unique(found, by_prod, ["CodProductor"]), by_org, ["CodOrganizador"])
    return join_unique(pending, named, ["NroPoliza"], "inner").select(
        "poliza",
        F.col("CodProductor").alias("cod_productor"),
        "nom_productor",
        F.col("CodOrganizador").alias("cod_organizador"),
        "nom_organizador",
        *more,
    )
