"""Registered queries: every operator over the driver tables, with the SQL that checks it."""

from tablewright.queries import cleaning, features, modelling, profiling, tables  # noqa: F401
from tablewright.queries.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
