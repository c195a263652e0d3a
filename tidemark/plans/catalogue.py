"""Imports every query module so that the registry is complete."""
from tidemark.plans import (  # noqa: F401
    queries_bars,
    queries_calendar,
    queries_checks,
    queries_gate,
    queries_joins,
    queries_model,
    queries_monitor,
    queries_roll,
    queries_tables,
)
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
