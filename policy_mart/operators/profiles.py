"""Profiles: premium against claims per person, and yearly figures per agent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..functions.numbers import UnitSums, or_zero, or_zero_money, units
from ..functions.text import labelled
from .keyed import join_unique
from .scd import latest_per_key


def movements(
    df: DataFrame, date_col: str, keys: Sequence[str], measures: Mapping[str, str], month_col: str = "FechaMes"
) -> DataFrame:
    """Rows of one source as dated contributions to `measures` (output name -> column), in units."""
    return df.select(
        *keys, month_start(date_col).alias(month_col), *[units(c).alias(n) for n, c in measures.items()]
    )


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of the parts; a measure that a part does not have is null there."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked


def combine_measures(
    parts: Sequence[DataFrame],
    keys: Sequence[str],
    amounts: Sequence[str],
    counts: Sequence[str] = (),
    differences: Mapping[str, tuple[Sequence[str], Sequence[str]]] | None = None,
) -> DataFrame:
    """Total of every measure per key over all parts, 0 where a part has no rows for the key.

    This is the full outer join of the parts' totals with missing measures set to 0, written as
    one aggregation: the parts are stacked and summed, which takes one shuffle (summed per map
    task before it) in place of one shuffle per part and a join. Null keys meet each other.
    `amounts` are in units; `differences` adds sums of some amounts less sums of others.
    """
    sums = UnitSums(amounts)
    totals = stack(parts).groupBy(*keys).agg(*sums.aggregates(), *[F.sum(c).alias(c) for c in counts])
    return totals.select(
        *keys,
        *[sums.total([a]).alias(a) for a in amounts],
        *[sums.total(plus, minus).alias(n) for n, (plus, minus) in (differences or {}).items()],
        *[or_zero(c).cast("bigint").alias(c) for c in counts],
    )


def outer_totals(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Full outer join of two tables that have one row per key; missing measures become 0.

    For two rollups that already exist. Both come partitioned by the keys when they were just
    aggregated by them, and are then joined without another shuffle.
    """
    joined = left.join(right, list(keys), "full_outer")
    return joined.withColumns({m: or_zero_money(m) for m in measures})


def result_profile(
    rows: DataFrame,
    persons: DataFrame,
    producers: DataFrame,
    organizers: DataFrame,
    dims: Sequence[str],
    income: Sequence[str],
    claims: str,
    month_col: str = "FechaMes",
) -> DataFrame:
    """Result (income less claims) per person, dimensions and month.

    `rows` are premium and claim contributions in units (see `movements`), stacked, each with
    NroAsegurado, dims, CodProductor, CodOrganizador and month. Several insured numbers may be one
    person (`persons`: NroPersona, persona_key, Nombre). Only numbers are summed, per insured first
    and then per person, so that both sums are hash aggregates and the join to the persons is of
    sums, not of rows. Labels (`producers`, `organizers`: one row per code; a person's highest
    name) are looked up afterwards. Rows with neither premium nor claims are dropped.
    """
    others = [*dims, "CodOrganizador", "CodProductor", month_col]
    sums = UnitSums([*income, claims])
    insured = persons.select(F.col("NroPersona").alias("NroAsegurado"), "persona_key")
    names = latest_per_key(persons.select("persona_key", "Nombre"), ["persona_key"], ["Nombre"])
    person = (
        join_unique(rows.groupBy("NroAsegurado", *others).agg(*sums.aggregates()), insured, ["NroAsegurado"])
        .groupBy("persona_key", *others)
        .agg(*sums.merged())
        .filter((sums.total([income[0]]) != 0) | (sums.total([claims]) != 0))
    )
    person = join_unique(person, names, ["persona_key"])

    by_organizer = organizers.select(
        "CodOrganizador", F.col("Nombre").alias("NomOrganizador"), F.col("Grupo").alias("GrupoOrganizador")
    )
    by_producer = producers.select("CodProductor", F.col("Nombre").alias("NomProductor"))
    labelled_rows = join_unique(join_unique(person, by_organizer, ["CodOrganizador"]), by_producer, ["CodProductor"])
    return labelled_rows.select(
        "persona_key", "Nombre", *dims, "CodOrganizador", "NomOrganizador", "GrupoOrganizador",
        "CodProductor", "NomProductor", month_col,
        F.year(month_col).alias("Año"),
        F.month(month_col).alias("Mes"),
        *[sums.total([m]).alias(m) for m in income],
        sums.total(income).alias("PremioNeto"),
        sums.total([claims]).alias(claims),
        sums.total(income, minus=[claims]).alias("Resultado"),
    )


def agent_profile(
    operations: DataFrame,
    claims: DataFrame,
    reports: DataFrame,
    organizers: DataFrame,
    producers: DataFrame,
    income: Sequence[str],
    claim_amount: str,
    month_col: str = "FechaMes",
) -> DataFrame:
    """Yearly and monthly figures per branch, organizer and producer, with composed labels.

    `operations` and `claims` are rollups, `reports` has the number of claim reports (Denuncias) per
    month and agent. `claims` has one row per month, branch, organizer and producer: its
    SiniestrosPagados are numbers of different claims, which cannot be added up.
    """
    keys = [month_col, "CodRama", "CodOrganizador", "CodProductor"]
    counts = ["SiniestrosPagados", "Denuncias"]
    parts = [
        operations.select(*keys, *[units(m).alias(m) for m in income]),
        claims.select(*keys, units(claim_amount).alias(claim_amount), "SiniestrosPagados"),
        reports.select(*keys, "Denuncias"),
    ]
    amounts = [*income, claim_amount]
    rows = combine_measures(parts, keys, amounts, counts, {"Resultado": (income, [claim_amount])})
    by_organizer = organizers.select(
        "CodOrganizador", F.col("Nombre").alias("NomOrganizador"), F.col("Grupo").alias("GrupoOrganizador")
    )
    by_producer = producers.select("CodProductor", F.col("Nombre").alias("NomProductor"))
    rows = join_unique(join_unique(rows, by_organizer, ["CodOrganizador"]), by_producer, ["CodProductor"])
    return rows.select(
        F.year(month_col).alias("Año"),
        F.month(month_col).alias("Mes"),
        "CodRama",
        F.lit("").alias("Rama"),
        F.lit("").alias("FullRama"),
        "GrupoOrganizador",
        "CodOrganizador",
        "NomOrganizador",
        labelled("CodOrganizador", "NomOrganizador").alias("FullOrganizador"),
        "CodProductor",
        "NomProductor",
        labelled("CodProductor", "NomProductor").alias("FullProductor"),
        *amounts,
        "Resultado",
        *counts,
    )
