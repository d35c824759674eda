"""Helpers to write the DuckDB oracle SQL of each query key.

Oracle SQL follows the reference's statements (T-SQL semantics spelled in
DuckDB); fixtures are prepended as CTEs so the oracle reads only the
pre-registered base tables.
"""

from __future__ import annotations

import re

from staffline.sources.recipes import RECIPES

_FX_RE = re.compile(r"\bfx_\w+\b")


def with_fixtures(sql: str) -> str:
    """Prepend the ``fx_*`` recipes referenced by ``sql`` as CTEs."""
    body = sql.strip().rstrip(";")
    names: list[str] = []

    def visit(text: str) -> None:
        for n in _FX_RE.findall(text):
            if n in RECIPES and n not in names:
                visit(RECIPES[n])  # dependencies first
                if n not in names:
                    names.append(n)

    visit(body)
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({RECIPES[n]})" for n in names)
    if re.match(r"(?is)^\s*with\s", body):
        return "WITH " + ctes + ",\n" + re.sub(r"(?is)^\s*with\s", "", body, count=1)
    return "WITH " + ctes + "\n" + body


def rnd(expr: str, scale: int = 2) -> str:
    """Same deterministic rounding as ``staffline.functions.round2``."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(18,6)), {scale}) AS DOUBLE)"


def in_year(col: str, year: int) -> str:
    return f"({col} >= DATE '{year}-01-01' AND {col} < DATE '{year + 1}-01-01')"
