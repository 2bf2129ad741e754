"""Queries over the driver's test tables, each next to the SQL that checks it."""

from driver_queries import datasets, families, keyed, relational, release, scalars, spatial  # noqa: F401
from driver_queries.registry import ORACLES, QUERIES  # noqa: F401
