"""Directory snapshot -> network_users (diff, update, undelete, soft delete, insert).

The snapshot is the full current directory export; ``network_users`` keeps
every account ever seen. One run = ``reconcile_accounts`` (then the duplicate
resolvers of ``operators.dedupe``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.operators.ordering import first_by
from staffline.operators.reconcile import (anti_join, assign_ids, count_changed, join_update,
                                           snapshot_diff, soft_delete, sref, tref, undelete)
from staffline.schemas import conform
from staffline.session import cut_lineage

# The 20 compared / copied directory columns.
AD_COLUMNS = ["guid", "source", "first_name", "last_name", "common_name", "display_name",
              "network_email", "primary_email", "email", "job_title", "account_name",
              "active_dir_group", "department", "location", "manager", "user_description",
              "phone_extension", "mobile_phone", "created_at", "is_disabled"]
# Columns the change count compares (no guid, no source).
COUNTED = AD_COLUMNS[2:]

# Which row of a guid counts when an export lists it more than once.
DIFF_ORDER = [("created_at", "desc"), ("source", "asc"), ("account_name", "asc")]


def _snap(snapshot: DataFrame) -> DataFrame:
    return conform(snapshot, "network_users").select(*AD_COLUMNS)


def account_diff(snapshot: DataFrame, users: DataFrame) -> DataFrame:
    """Snapshot rows not already stored exactly (20 columns, NULL-safe EXCEPT)."""
    return snapshot_diff(_snap(snapshot), conform(users, "network_users"), AD_COLUMNS)


def account_change_count(users: DataFrame, snapshot: DataFrame) -> DataFrame:
    return count_changed(conform(users, "network_users"), _snap(snapshot), "guid", COUNTED)


def update_accounts(users: DataFrame, diff: DataFrame, as_of: dt.datetime,
                    clear_disabled_at: bool = False) -> DataFrame:
    """Changed accounts take the snapshot's values (``source`` too).

    ``disabled_at`` becomes ``as_of`` when an account turns disabled. While it
    stays disabled the old time is kept; ``clear_disabled_at=True`` reproduces
    the reference, which clears it on any other change.
    """
    nu = conform(users, "network_users")
    # One diff row per guid (a guid twice in one export would make the update non-deterministic).
    src = first_by(diff, ["guid"], DIFF_ORDER)
    turned = (tref("is_disabled") == F.lit(False)) & (sref("is_disabled") == F.lit(True))
    if clear_disabled_at:
        disabled_at = F.when(turned, F.lit(as_of).cast("timestamp"))
    else:
        disabled_at = (F.when(turned, F.lit(as_of).cast("timestamp"))
                       .when(sref("is_disabled") == F.lit(True), tref("disabled_at")))
    sets = {c: sref(c) for c in AD_COLUMNS}
    sets["disabled_at"] = disabled_at
    return join_update(nu, src, "guid", sets)


def undelete_accounts(users: DataFrame, snapshot: DataFrame) -> DataFrame:
    return undelete(conform(users, "network_users"), snapshot, "guid")


def soft_delete_accounts(users: DataFrame, snapshot: DataFrame, as_of: dt.datetime) -> DataFrame:
    return soft_delete(conform(users, "network_users"), snapshot, "guid", as_of)


def insert_accounts(users: DataFrame, diff: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One diff row per new guid (the one the update would take, when both
    servers list it); ids continue after the largest id, in guid order."""
    nu = conform(users, "network_users")
    new = first_by(anti_join(diff, nu, "guid"), ["guid"], DIFF_ORDER)
    base = nu.agg(F.coalesce(F.max("id"), F.lit(0)).alias("__base"))
    new = assign_ids(new.crossJoin(F.broadcast(base)), ["guid"], start_after=F.col("__base"))
    ts = F.lit(as_of).cast("timestamp")
    new = (new.withColumn("primary_guid", F.col("guid"))
           .withColumn("disabled_at", F.when(F.col("is_disabled") == F.lit(True), ts))
           .withColumn("inserted_at", ts)
           .withColumn("is_primary_acct", F.lit(True)).withColumn("is_non_user", F.lit(False))
           .withColumn("is_deleted", F.lit(False)).withColumn("deleted_at", F.lit(None).cast("timestamp")))
    return nu.unionByName(conform(new, "network_users").select(*nu.columns))


def account_counts(users: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Pre-state counts of one run in one row: changed (both modes), undeleted,
    soft-deleted, inserted, and the diff size."""
    nu = conform(users, "network_users")
    snap = _snap(snapshot)
    diff = account_diff(snapshot, users)
    changed = account_change_count(users, snapshot)
    keys = snap.select(F.col("guid").alias("__g")).filter(F.col("__g").isNotNull()).distinct().withColumn("__p", F.lit(True))
    state = nu.join(keys, F.col("guid") == F.col("__g"), "left").agg(
        F.count_if(F.col("__p").isNotNull() & (F.col("is_deleted") == F.lit(True))).alias("undeleted"),
        F.count_if(F.col("__p").isNull() & (F.col("is_deleted") == F.lit(False))).alias("deleted"))
    inserted = anti_join(diff, nu, "guid").agg(F.count(F.lit(1)).alias("inserted"))
    diff_n = diff.agg(F.count(F.lit(1)).alias("diff_rows"))
    return changed.crossJoin(state).crossJoin(inserted).crossJoin(diff_n)


#: A run may soft-delete this share of the accounts that are not deleted yet.
MAX_DELETED = 0.5


class TooManyDeletions(RuntimeError):
    """A snapshot would delete more accounts than a run may."""


def deletion_share(users: DataFrame, snapshot: DataFrame) -> DataFrame:
    """One row: accounts not deleted (``live``) and those of them that the snapshot lacks (``gone``)."""
    nu = conform(users, "network_users").where(~F.coalesce(F.col("is_deleted"), F.lit(False))).select("guid")
    keys = snapshot.select(F.col("guid").alias("__g")).where(F.col("__g").isNotNull()).distinct()
    return (nu.join(keys, F.col("guid") == F.col("__g"), "left")
            .agg(F.count(F.lit(1)).alias("live"), F.count_if(F.col("__g").isNull()).alias("gone")))


def check_deletions(users: DataFrame, snapshot: DataFrame, max_deleted: float | None = MAX_DELETED) -> None:
    """End the run if ``snapshot`` lacks more than the share ``max_deleted`` of the accounts (None: no
    limit): an export that was cut short looks like a mass leaving."""
    if max_deleted is None:
        return
    row = deletion_share(users, snapshot).first()
    if row.gone > max_deleted * row.live:
        raise TooManyDeletions(f"the snapshot would delete {row.gone} of {row.live} accounts")


def reconcile_accounts(users: DataFrame, snapshot: DataFrame, as_of: dt.datetime,
                       short_circuit: bool = False, clear_disabled_at: bool = False) -> DataFrame:
    """Update, undelete, soft delete, insert, in that order.

    ``short_circuit=True`` reproduces the reference's early exit (no diff rows
    means no deletes or undeletes either); it costs one extra small job.
    """
    # The diff feeds the update and the insert: stage it once.
    diff = cut_lineage(account_diff(snapshot, users))
    if short_circuit and diff.isEmpty():
        return conform(users, "network_users")
    out = update_accounts(users, diff, as_of, clear_disabled_at)
    out = undelete_accounts(out, snapshot)
    out = soft_delete_accounts(out, snapshot, as_of)
    return insert_accounts(out, diff, as_of)
