"""Queries over the driver tables, each with its plain-SQL counterpart where one exists."""

from foldcast.queries.registry import ORACLES, QUERIES
from foldcast.queries import tables, sequences, actors, forecasts, models  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
