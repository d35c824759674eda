"""Snapshot reconciliation: set differences, join-updates, inserts, soft
delete / undelete, key cascade and surrogate ids.

Each operator is a pure function ``(target, source, ...) -> new target``
(plus counts where the reference reports them). A full snapshot is joined to
the long-lived table once on its business key, so each statement is one
shuffle on that key; nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from staffline.functions import changed_null_safe, changed_null_unsafe
from staffline.session import cut_lineage


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def snapshot_diff(source: DataFrame, target: DataFrame, cols: list[str]) -> DataFrame:
    """``SELECT cols FROM source EXCEPT SELECT cols FROM target`` (distinct,
    NULL equals NULL); planned as a NULL-safe anti join."""
    return source.select(*cols).subtract(target.select(*cols))


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` whose key is not NULL and absent from ``right``.

    This is ``NOT IN`` for a subquery without NULLs, planned as a shuffled
    anti join (a plain ``NOT IN`` becomes a null-aware broadcast join that
    cannot grow with the right side).
    """
    rk = right_key or left_key
    keys = right.select(F.col(rk).alias("__k")).filter(F.col("__k").isNotNull())
    return (left.filter(F.col(left_key).isNotNull())
            .join(keys, F.col(left_key) == F.col("__k"), "left_anti"))


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
           sql_null_semantics: bool = True) -> DataFrame:
    """Exact SQL ``left_key NOT IN (SELECT right_key FROM right)``.

    With ``sql_null_semantics`` a NULL in the subquery empties the result (as
    SQL does); the check is a one-row aggregate joined as a filter, so nothing
    reaches the driver. Without it, NULLs in the subquery are ignored.
    """
    out = anti_join(left, right, left_key, right_key)
    if not sql_null_semantics:
        return out
    rk = right_key or left_key
    has_null = right.agg(F.max(F.col(rk).isNull().cast("int")).alias("__has_null"))
    # One-row frame: fixed size, safe to broadcast.
    return (out.crossJoin(F.broadcast(has_null))
            .filter(F.coalesce(F.col("__has_null"), F.lit(0)) == 0).drop("__has_null"))


def semi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    rk = right_key or left_key
    return left.join(right.select(F.col(rk).alias("__k")), F.col(left_key) == F.col("__k"), "left_semi")


def spread_nulls(key: str | Column) -> Column:
    """A non-negative integer key for the left side of a left join: NULLs
    become distinct negative numbers, which match nothing and spread over all tasks
    instead of meeting in one."""
    col = F.col(key) if isinstance(key, str) else key
    return F.coalesce(col.cast("long"), -F.monotonically_increasing_id() - 1)


def join_update(target: DataFrame, source: DataFrame, on, set_cols: dict[str, Column],
                where: Column | None = None, matched_flag: str | None = None) -> DataFrame:
    """``UPDATE target SET c = expr FROM source WHERE target.key = source.key [AND where]``.

    ``source`` must be unique on ``on`` (use ``first_by`` first: an UPDATE
    FROM with several matches is non-deterministic). Source columns are
    visible as ``s.<name>``, target columns as ``t.<name>``.
    """
    keys = _keys(on)
    s = source.select(*[F.col(c).alias(f"s.{c}") for c in source.columns], F.lit(True).alias("__m"))
    t = target.select(*[F.col(c).alias(f"t.{c}") for c in target.columns])
    cond = reduce(and_, [F.col(f"`t.{k}`") == F.col(f"`s.{k}`") for k in keys])
    j = t.join(s, cond, "left")
    hit = F.coalesce(F.col("__m"), F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    out = []
    for c in target.columns:
        cur = F.col(f"`t.{c}`")
        out.append((F.when(hit, set_cols[c]).otherwise(cur) if c in set_cols else cur).alias(c))
    if matched_flag:
        out.append(hit.alias(matched_flag))
    return j.select(*out)


def sref(c: str) -> Column:
    """Source column inside ``join_update`` expressions."""
    return F.col(f"`s.{c}`")


def tref(c: str) -> Column:
    """Target column inside ``join_update`` expressions."""
    return F.col(f"`t.{c}`")


def soft_delete(target: DataFrame, present: DataFrame, key: str, as_of: dt.datetime,
                present_key: str | None = None) -> DataFrame:
    """Rows whose key is absent from ``present`` and not yet deleted get
    ``is_deleted = true, deleted_at = as_of``."""
    pk = present_key or key
    keys = present.select(F.col(pk).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
    j = target.join(keys.withColumn("__p", F.lit(True)), F.col(key) == F.col("__k"), "left").drop("__k")
    gone = F.col("__p").isNull() & ~F.coalesce(F.col("is_deleted"), F.lit(False))
    return (j.withColumn("deleted_at", F.when(gone, F.lit(as_of)).otherwise(F.col("deleted_at")))
            .withColumn("is_deleted", F.when(gone, F.lit(True)).otherwise(F.col("is_deleted")))
            .drop("__p").select(*target.columns))


def undelete(target: DataFrame, present: DataFrame, key: str, present_key: str | None = None) -> DataFrame:
    """Deleted rows whose key is present again: ``is_deleted = false, deleted_at = NULL``."""
    pk = present_key or key
    keys = present.select(F.col(pk).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
    j = target.join(keys.withColumn("__p", F.lit(True)), F.col(key) == F.col("__k"), "left").drop("__k")
    back = F.col("__p").isNotNull() & F.coalesce(F.col("is_deleted"), F.lit(False))
    return (j.withColumn("deleted_at", F.when(back, F.lit(None)).otherwise(F.col("deleted_at")))
            .withColumn("is_deleted", F.when(back, F.lit(False)).otherwise(F.col("is_deleted")))
            .drop("__p").select(*target.columns))


def count_changed(target: DataFrame, source: DataFrame, on, cols: list[str]) -> DataFrame:
    """Matched rows that differ, counted both ways (H2): ``changed_reference``
    uses NULL-unsafe ``!=`` like the reference's count, ``changed`` is NULL-safe."""
    keys = _keys(on)
    s = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in cols])
    j = target.select(*keys, *cols).join(s, keys)
    pairs = [(F.col(f"__s_{c}"), F.col(c)) for c in cols]
    return j.agg(F.count_if(changed_null_unsafe(pairs)).alias("changed_reference"),
                 F.count_if(changed_null_safe(pairs)).alias("changed"))


def assign_ids(df: DataFrame, order_by: list[str], id_col: str = "id", start_after: Column | int = 0,
               num_partitions: int | None = None) -> DataFrame:
    """Dense surrogate ids in ``order_by`` order: ``start_after + 1, + 2, ...``.

    No unpartitioned window: rows are range-partitioned and sorted by the
    key, numbered inside each partition, and shifted by the running total of
    the partition sizes (one small row per partition). The numbered frame is
    checkpointed so a retried task cannot renumber rows.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    ranged = cut_lineage(ranged)
    sizes = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # At most one row per partition: a proven bound, broadcast it.
    offsets = sizes.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    return (ranged.join(F.broadcast(offsets), "__pid")
            .withColumn(id_col, (base + F.col("__off") + F.col("__local") + 1).cast("long"))
            .drop("__pid", "__local", "__off"))


def cascade_key(child: DataFrame, fk: str, id_changes: DataFrame, old: str = "old_id", new: str = "new_id") -> DataFrame:
    """Re-key a child table after parent ids changed (``ON UPDATE CASCADE``)."""
    ch = id_changes.select(F.col(old).alias("__old"), F.col(new).alias("__new"))
    return (child.withColumn("__fk", spread_nulls(fk)).join(ch, F.col("__fk") == F.col("__old"), "left")
            .withColumn(fk, F.coalesce(F.col("__new"), F.col(fk)))
            .drop("__old", "__new", "__fk"))
