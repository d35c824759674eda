"""Table catalog: base Parquet tables of a data folder plus derived fixtures.

Every DataFrame here is lazy; column pruning and filter pushdown reach the
Parquet scan because fixtures are plain SQL over ``spark.read.parquet``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from staffline.sources.recipes import RECIPES

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

_TABLE_RE = re.compile(r"\b(" + "|".join(BASE_TABLES) + r"|fx_\w+)\b")


def _placeholder_sql(sql: str) -> tuple[str, list[str]]:
    """Escape literal braces and turn table names into ``{name}`` slots."""
    escaped = sql.replace("{", "{{").replace("}", "}}")
    used: list[str] = []

    def repl(m: re.Match) -> str:
        if m.group(1).startswith("fx_") and m.group(1) not in RECIPES:
            return m.group(1)
        if m.group(1) not in used:
            used.append(m.group(1))
        return "{" + m.group(1) + "}"

    return _TABLE_RE.sub(repl, escaped), used


class Catalog:
    """Named DataFrames of one data folder (``sf_dir``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def fixture(self, name: str) -> DataFrame:
        key = name if name.startswith("fx_") else f"fx_{name}"
        if key not in self._cache:
            sql, used = _placeholder_sql(RECIPES[key])
            self._cache[key] = self.spark.sql(sql, **{t: self[t] for t in used})
        return self._cache[key]

    def __getitem__(self, name: str) -> DataFrame:
        return self.fixture(name) if name.startswith("fx_") else self.table(name)


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(spark, sf_dir)
