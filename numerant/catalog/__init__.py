"""Registered queries and the SQL that gives the same rows."""

from . import chains, jobs, modeling, stages, statistics, streams  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
