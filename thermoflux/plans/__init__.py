"""Registered queries: the Spark plans over the fixture tables and their SQL oracles."""

from thermoflux.plans.catalog import FLAGSHIP, QUERIES
from thermoflux.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL", "FLAGSHIP"]
