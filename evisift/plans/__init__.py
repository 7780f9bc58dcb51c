"""All registered queries: importing the modules registers them."""

from . import assembly, coverage
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "assembly", "coverage"]
