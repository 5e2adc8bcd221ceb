"""Registered queries of the library."""

from gridframe.plans import audit_queries, checks_queries, more_queries, report_queries, run_queries, scoring_queries, split_queries  # noqa: F401
from gridframe.plans.registry import QUERIES, SQL  # noqa: F401
