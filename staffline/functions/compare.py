"""Change-detection predicates and rounding shared by all operators."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def changed_null_unsafe(pairs: list[tuple[Column, Column]]) -> Column:
    """OR of ``a != b``: the reference's counting form; NULL on either side
    never counts as a change (NULL-to-value is missed)."""
    return F.coalesce(reduce(or_, [a != b for a, b in pairs]), F.lit(False))


def changed_null_safe(pairs: list[tuple[Column, Column]]) -> Column:
    """OR of ``NOT (a <=> b)``: what EXCEPT actually applies."""
    return reduce(or_, [~a.eqNullSafe(b) for a, b in pairs])


def round2(x: Column, scale: int = 2) -> Column:
    """Deterministic decimal rounding (HALF_UP) of a computed double.

    Values pass through decimal(18,6) first so both engines round the same
    decimal, not the binary double.
    """
    return F.round(x.cast("decimal(18,6)"), scale).cast("double")
