"""Run parameters.

The reference hard-codes these in SQL text; here they are arguments so a
report can be rerun for any year and any "now".
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------
# Pay codes (timecard classification).
REGULAR_CODES = ("REGULAR", "REGSAL")
WORK_EXTRA_CODES = ("OVERTIME", "MKU", "EXT", "YSG", "YSX", "DBLTME")
PAID_EXTRA_CODES = ("PTO", "ETO-1", "FLOAT", "HOLIDAY", "JURY", "CME", "BEREAV",
                    "CED SAL", "ESL", "RLL", "SICK", "CED")
UNPAID_CODES = ("UNPAID", "PDLCHAWD", "MEALPENALTY")
# Directory: enabled userAccountControl values.
ENABLED_UAC = (512, 66048)
# Directory: comma-part offset (from the right) of the group in the DN.
DN_GROUP_OFFSET = {"server1": 5, "server2": 4}
# Organisation e-mail marker that ranks an account first among duplicates.
ORG_DOMAIN = "organizationname.org"
# Hire date that stands for "migrated"; the real one comes from seniority dates.
HIRE_SENTINEL = "2023-10-01"
# Prefix of the manager position id; the employee id follows it.
POSITION_PREFIX = "S3600"
# Clinical account user types compared in the name/email audit.
CLINICAL_USER_TYPES = (1, 2, 9)
# Open end of a job-history interval.
OPEN_END_DATE = "2099-12-31"
# FTE constants.
FTE_YEAR_HOURS = 2080
FTE_DAY_HOURS = 8
MIN_ROWS_PER_WORKDAY = 600
# Pooled contractor ids whose hours are shared by several people.
POOLED_DIVISORS = {24: 5.0, 23: 4.0}
# EHR service account excluded from linkage.
EXCLUDED_EHR_IDS = ("SA000",)
# Clinical JSON instances in workforce_map.ecw_ids.
ECW_INSTANCES = ("ecw instance 1", "ecw instance 2")


@dataclass(frozen=True)
class Params:
    reporting_year: int = 2000
    as_of: dt.datetime = dt.datetime(2000, 7, 15, 10, 30, 0)
    fte_year_hours: int = FTE_YEAR_HOURS
    fte_day_hours: int = FTE_DAY_HOURS
    min_rows_per_workday: int = MIN_ROWS_PER_WORKDAY
    pooled_divisors: dict = field(default_factory=lambda: dict(POOLED_DIVISORS))
    org_domain: str = ORG_DOMAIN
    hire_sentinel: str = HIRE_SENTINEL
    position_prefix: str = POSITION_PREFIX
    excluded_ehr_ids: tuple = EXCLUDED_EHR_IDS
    open_end_date: str = OPEN_END_DATE
    # employees audited when terminated in or after this year
    audit_employee_since_year: int = 2023
    # accounts audited unless disabled / deleted before this year
    audit_account_since_year: int = 2024
    # reproduce SQL NOT IN (a NULL in the subquery empties the result)
    sql_null_semantics: bool = False
    # reproduce UNION-distinct of hour rows (drops equal rows)
    dedupe_hours: bool = False

    def with_(self, **kw) -> "Params":
        d = self.__dict__.copy()
        d.update(kw)
        return Params(**d)

    @property
    def year_start(self) -> dt.date:
        return dt.date(self.reporting_year, 1, 1)

    @property
    def year_end(self) -> dt.date:
        return dt.date(self.reporting_year, 12, 31)

    @property
    def next_year_start(self) -> dt.date:
        return dt.date(self.reporting_year + 1, 1, 1)
