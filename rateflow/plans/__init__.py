"""Named query plans over the driver's tables and their SQL oracles."""

from rateflow.plans.catalog import QUERIES
from rateflow.plans.oracle import oracle_sql

__all__ = ["QUERIES", "oracle_sql"]
