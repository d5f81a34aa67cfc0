"""Named end-to-end queries over the test tables and their SQL twins."""

from cartwise.plans.oracle import oracle_sql
from cartwise.plans.queries import QUERIES

__all__ = ["QUERIES", "oracle_sql"]
