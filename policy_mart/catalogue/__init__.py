"""Every operator as a query over the driver's tables, with the SQL that gives the same rows."""

from . import controls, dims, loads, persons, profiles, rates, rollups, runs, streams  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
