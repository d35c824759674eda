"""Query keys: each module registers Spark builders and DuckDB oracle SQL."""

from staffline.plans import (audit_q, basics_q, flatten_q, identity_q, reconcile_q,  # noqa: F401
                             runlog_q, timecard_q, views_q)  # (importing registers the keys)
from staffline.plans import composite_q  # noqa: F401,E402  (oracles of the chained runs)
from staffline.plans.registry import ORACLES, QUERIES, StaffTables, query

__all__ = ["ORACLES", "QUERIES", "StaffTables", "query"]
