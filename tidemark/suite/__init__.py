"""Every job as a named query over the given tables, with a SQL text that must agree with it."""

from tidemark.suite import bookings, fraud, profiles, relational, reports, storage, trips  # noqa: F401
from tidemark.suite.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
