"""Registered queries over the test tables."""

from tallyroom.entry import checks, cleaning, marts, modelling, monitoring, movement  # noqa: F401  (register on import)
from tallyroom.entry.book import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
