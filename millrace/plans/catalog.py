"""All named queries."""

from millrace.plans import aggregates, cuts, jobs, live, matching, rows, windows  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
