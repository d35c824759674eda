"""String column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staffline.params import ORG_DOMAIN

# Length argument of a substring that goes on to the end.
END = 2**31 - 1


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Python's str.isspace(): Unicode white space plus the ASCII separators 0x1c-0x1f.
_WS = r"[\s\x1c-\x1f]"


def strip(x) -> Column:
    """Python ``str.strip()``: remove all leading/trailing white space (Unicode
    included), not only spaces."""
    return F.regexp_replace(_c(x), r"(?U)^" + _WS + r"+|" + _WS + r"+$", "")


def strip_lower(x) -> Column:
    return F.lower(strip(x))


def norm_key(x) -> Column:
    """``TRIM(LOWER(x))`` used as a join key for e-mails and names."""
    return F.trim(F.lower(_c(x)))


def title_case(x) -> Column:
    """Python ``str.strip().title()``.

    Every run of cased letters (upper, lower, title case) gets an upper-case
    first letter and lower-case rest; anything else starts a new word
    (``smith-jones`` -> ``Smith-Jones``), unlike ``initcap`` which only splits
    on spaces.
    """
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    parts = F.regexp_extract_all(F.lower(strip(x)), F.lit(f"([{cased}]+|[^{cased}]+)"), 1)
    capped = F.transform(parts, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, END)))
    return F.when(_c(x).isNotNull(), F.array_join(capped, ""))


def primary_email(proxy_addresses) -> Column:
    """First upper-case ``SMTP:`` proxy address, lower-cased; NULL if none."""
    found = F.filter(
        F.transform(_c(proxy_addresses), lambda a: F.regexp_extract(a, r"SMTP:(.+)", 1)),
        lambda a: a != "")
    return F.lower(F.get(found, 0))


def dn_group(distinguished_name, offset_from_right) -> Column:
    """Group from a distinguished name: the n-th comma part from the right,
    minus its 3-character ``OU=`` prefix."""
    off = offset_from_right if isinstance(offset_from_right, Column) else F.lit(offset_from_right)
    part = F.try_element_at(F.split(_c(distinguished_name), ","), -off)
    return F.substring(part, 4, END)


def manager_cn(manager_dn) -> Column:
    """``CN=([^,]+)`` of the manager's DN; NULL stays NULL, no match gives NULL."""
    return F.nullif(F.regexp_extract(_c(manager_dn), r"CN=([^,]+)", 1), F.lit(""))


def tsql_concat(*cols) -> Column:
    """T-SQL ``CONCAT``: NULL arguments count as empty strings."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def left(x, n: int) -> Column:
    return F.substring(_c(x), 1, n)


def has_digit(x) -> Column:
    return _c(x).rlike("[0-9]")


def looks_like_person(common_name) -> Column:
    """``common_name LIKE '% %' AND PATINDEX('%[0-9]%', common_name) = 0``."""
    cn = _c(common_name)
    return cn.contains(" ") & ~has_digit(cn)


def is_org_email(email, domain: str = ORG_DOMAIN) -> Column:
    return _c(email).contains(domain)


def name_last_first(name) -> tuple[Column, Column]:
    """Split ``"Last, First"`` into (first, last), lower-cased and trimmed.

    A name without a comma has no last name in the reference (its LEFT(x,-1)
    fails); here both parts become NULL for it.
    """
    n = _c(name)
    pos = F.instr(n, ",")
    has = pos > 0
    first = F.when(has, F.lower(F.trim(F.substring(n, pos + 1, END))))
    last = F.when(has, F.lower(F.substring(n, F.lit(1), pos - 1)))
    return first, last


def full_name_with_initial(first, middle, last) -> Column:
    """``CONCAT_WS(' ', first, LEFT(middle, 1), last)``."""
    return F.concat_ws(" ", _c(first), left(middle, 1), _c(last))
