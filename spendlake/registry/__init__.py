"""Registered queries over the test tables, and the SQL that checks them."""

from spendlake.registry import etl, exports, inventory, quality, savings  # noqa: F401
from spendlake.registry.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
