"""Date predicates and calendar-year proration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def in_year(x, year: int) -> Column:
    """``YEAR(x) = year`` as a half-open range so Parquet min/max stats prune."""
    lo, hi = dt.date(year, 1, 1), dt.date(year + 1, 1, 1)
    c = _c(x)
    return (c >= F.lit(lo)) & (c < F.lit(hi))


def overlaps_year(start, end, year: int) -> Column:
    """``end >= Jan 1 AND start <= Dec 31``; NULL bounds drop the row."""
    return (_c(end) >= F.lit(dt.date(year, 1, 1))) & (_c(start) <= F.lit(dt.date(year, 12, 31)))


def clip_start(start, year: int) -> Column:
    lo = F.lit(dt.date(year, 1, 1))
    return F.when(_c(start) < lo, lo).otherwise(_c(start))


def clip_end(end, year: int) -> Column:
    hi = F.lit(dt.date(year, 12, 31))
    return F.when(_c(end) > hi, hi).otherwise(_c(end))


def year_fraction(start, end, year: int) -> Column:
    """(days inside the year + 1) / (all days + 1), as a double."""
    inside = F.datediff(clip_end(end, year), clip_start(start, year)) + 1
    total = F.datediff(_c(end), _c(start)) + 1
    return inside.cast("double") / total.cast("double")


def iso_duration_minutes(x) -> Column:
    """ISO-8601 ``PT{h}H{m}M`` text to whole minutes.

    Matches a prefix; seconds are ignored; fractional or malformed text
    gives 0, as does NULL.
    """
    pattern = r"^PT(?:([0-9]+)H)?(?:([0-9]+)M)?"
    c = _c(x)
    h = F.coalesce(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("bigint"), F.lit(0))
    m = F.coalesce(F.nullif(F.regexp_extract(c, pattern, 2), F.lit("")).try_cast("bigint"), F.lit(0))
    return h * 60 + m
