from staffline.functions.compare import changed_null_safe, changed_null_unsafe, round2
from staffline.functions.dates import (clip_end, clip_start, in_year, iso_duration_minutes,
                                       overlaps_year, year_fraction)
from staffline.functions.text import (dn_group, full_name_with_initial, has_digit, is_org_email,
                                      left, looks_like_person, manager_cn, name_last_first,
                                      norm_key, primary_email, strip, strip_lower, title_case,
                                      tsql_concat)

__all__ = [
    "changed_null_safe", "changed_null_unsafe", "round2", "clip_end", "clip_start", "in_year",
    "iso_duration_minutes", "overlaps_year", "year_fraction", "dn_group", "full_name_with_initial",
    "has_digit", "is_org_email", "left", "looks_like_person", "manager_cn", "name_last_first",
    "norm_key", "primary_email", "strip", "strip_lower", "title_case", "tsql_concat",
]
