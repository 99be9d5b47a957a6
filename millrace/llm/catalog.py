"""All named corpus queries."""

from millrace.llm import plans  # noqa: F401
from millrace.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
