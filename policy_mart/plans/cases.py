"""Cases, kept in the mart and filled in from the portfolio."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.controls import INTERMEDIARIES, client_updates, producer_updates
from ..schemas import OPERATIONS, SNAPSHOTS
from ..sources.keyed_table import KeyedTable
from .dims import current_persons
from .mart import Mart
from .reports import current_organizers, current_producers

# The table of cases and the column that names a case's policy.
CASES, CASE_POLICY = "gestiones", "poliza"


def cases_table(mart: Mart) -> KeyedTable:
    return KeyedTable(mart.spark, mart.path(CASES), CASE_POLICY)


def load_cases(mart: Mart, cases: DataFrame) -> None:
    cases_table(mart).write(cases)


def fill_clients(mart: Mart) -> int:
    """Give the active cases without a client the one of their policy's newest snapshot row, with its
    producer and organizer. Returns the number of cases that changed."""
    table = cases_table(mart)
    updates = client_updates(
        table.read(), mart.table(SNAPSHOTS), current_persons(mart), current_producers(mart), current_organizers(mart),
        ties=["NroAsegurado", "CodProductor", "CodOrganizador"],
    )
    return table.update(updates, [*INTERMEDIARIES, "cliente"])


def fill_producers(mart: Mart) -> int:
    """Give the active cases without a producer those of the policy's newest operation. Returns the number of
    cases that changed."""
    table = cases_table(mart)
    updates = producer_updates(
        table.read(), mart.table(OPERATIONS), current_producers(mart), current_organizers(mart),
        ["FEmision", "Op", "Suplemento", "CodProductor", "CodOrganizador"],
    )
    return table.update(updates, INTERMEDIARIES)
