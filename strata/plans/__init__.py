"""Queries that apply the operators to the standard tables."""

from strata.plans import clustering, intake, scoring, streams, texts, vectors  # noqa: F401
from strata.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
