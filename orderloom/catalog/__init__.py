"""The registered queries, by area."""

from orderloom.catalog import changes, checks, relational, reports, scalars, structure, warehouse  # noqa: F401
from orderloom.catalog.core import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
