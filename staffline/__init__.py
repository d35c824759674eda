"""staffline: PySpark operators for staffing identity-and-hours data.

Everything is a function over DataFrames: flatten landed HR / directory
documents, reconcile full snapshots into long-lived tables, keep job
history, resolve duplicate accounts, link identities across systems, and
report calendar-year hours / FTE with integrity audits.
"""

from staffline.params import Params

__all__ = ["Params"]
