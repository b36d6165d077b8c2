"""Query plans binding the operators to concrete tables."""

from .registered import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
