"""Queries by name, and the SQL that must give the same rows."""

from lawloom.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
