"""What the driver's entry takes from this subpackage."""

from . import oracles, queries

QUERIES = queries.QUERIES
ORACLES = oracles.ORACLES
