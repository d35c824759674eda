"""Duplicate-account resolution over the directory table.

For one key (e-mail, primary e-mail, network e-mail, common name, display
name, or first + last name): keys with more than one primary, real-user
account are duplicates; among *all* real-user accounts of such a key the
best one stays primary, every other one gets ``is_primary_acct = false`` and
``primary_guid`` = the winner's guid. The flag is never set back to true.

Plan: one aggregate per key (count + ``min_by`` winner, both partial) and
one join back on the key; no window sort of a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffline.functions import is_org_email
from staffline.operators.ordering import sort_struct
from staffline.params import ORG_DOMAIN
from staffline.schemas import conform
from staffline.session import cut_lineage

# Key column (or expression) of each resolver, and whether an org e-mail ranks first.
RESOLVERS = {
    "email": (lambda: F.col("email"), True),
    "primary_email": (lambda: F.col("primary_email"), True),
    "network_email": (lambda: F.col("network_email"), True),
    "common_name": (lambda: F.col("common_name"), False),
    "display_name": (lambda: F.col("display_name"), False),
    "concat_name": (lambda: F.concat_ws(" ", "first_name", "last_name"), False),
}
# Resolvers the directory run applies, in order, each on the last one's result.
DEFAULT_SEQUENCE = ("email", "primary_email", "network_email", "common_name")

# The columns that keys, ranking and demotion read.
NARROW = ["id", "guid", "email", "primary_email", "network_email", "common_name", "display_name", "first_name",
          "last_name", "created_at", "inserted_at", "is_disabled", "is_deleted", "is_non_user", "is_primary_acct",
          "primary_guid"]


def _valid_key(name: str, key: Column) -> Column:
    return key != "" if name == "concat_name" else key.isNotNull()


def priority_order(key: Column, org_first: bool, domain: str = ORG_DOMAIN) -> list[tuple]:
    order = [("is_deleted", "asc"), ("is_disabled", "asc")]
    if org_first:
        order.append((is_org_email(key, domain).cast("int"), "desc"))
    order += [("created_at", "desc"), ("inserted_at", "desc"), ("id", "asc")]  # id: tie-break
    return order


def _key(name: str, collation: str | None) -> Column:
    """The resolver's key; with a collation (e.g. ``UTF8_LCASE``) keys that
    differ only in case group together, as a case-insensitive SQL collation
    would compare them."""
    key = RESOLVERS[name][0]()
    return F.collate(key, collation) if collation else key


def duplicate_winners(users: DataFrame, name: str, domain: str = ORG_DOMAIN,
                      collation: str | None = None) -> DataFrame:
    """(key, winner_id, winner_guid) for every duplicated key of one resolver."""
    _, org_first = RESOLVERS[name]
    nu = conform(users, "network_users").withColumn("__key", _key(name, collation))
    ranked = nu.filter(_valid_key(name, F.col("__key")) & (F.col("is_non_user") == F.lit(False)))
    order = priority_order(F.col("__key"), org_first, domain)
    return (ranked.groupBy("__key").agg(
                F.count_if(F.col("is_primary_acct") == F.lit(True)).alias("__n_primary"),
                F.min_by(F.struct(F.col("id").alias("id"), F.col("guid").alias("guid")),
                         sort_struct(ranked, order)).alias("__w"))
            .filter(F.col("__n_primary") > 1)
            .select("__key", F.col("__w.id").alias("__winner_id"), F.col("__w.guid").alias("__winner_guid")))


def resolve_duplicates(users: DataFrame, name: str, domain: str = ORG_DOMAIN,
                       collation: str | None = None) -> DataFrame:
    """Apply one resolver; returns the whole table with demotions applied."""
    nu = conform(users, "network_users")
    return _apply(nu, demotions(nu, name, domain, collation), users.columns)


def demotions(nu: DataFrame, name: str, domain: str = ORG_DOMAIN, collation: str | None = None) -> DataFrame:
    """(id, winner's guid) of the accounts that one resolver demotes. Rows
    without a key are filtered before the join, so they meet in no task."""
    winners = duplicate_winners(nu, name, domain, collation)
    keyed = nu.withColumn("__key", _key(name, collation)).filter(
        _valid_key(name, F.col("__key")) & (F.col("is_non_user") == F.lit(False)))
    return (keyed.select("id", "__key").join(winners, "__key").filter(F.col("id") != F.col("__winner_id"))
            .select(F.col("id").alias("__id"), F.col("__winner_guid").alias("__guid")))


def _apply(nu: DataFrame, demoted: DataFrame, cols: list[str]) -> DataFrame:
    """The table with the demoted accounts' two columns set."""
    hit = F.col("__id").isNotNull()
    out = (nu.join(demoted, F.col("id") == F.col("__id"), "left")
           .withColumn("is_primary_acct", F.when(hit, F.lit(False)).otherwise(F.col("is_primary_acct")))
           .withColumn("primary_guid", F.when(hit, F.col("__guid")).otherwise(F.col("primary_guid"))))
    return out.select(*[c for c in nu.columns if c in cols or c in ("is_primary_acct", "primary_guid")])


def resolve_all(users: DataFrame, sequence=DEFAULT_SEQUENCE, domain: str = ORG_DOMAIN,
                checkpoint_between: bool = True, collation: str | None = None) -> DataFrame:
    """Run resolvers in order, each seeing the previous one's result.

    Only what the resolvers read goes through the passes (id, guid, keys, flags
    and order columns); each pass reads its input twice, so by default the narrow
    table is written to the checkpoint folder after each one (as each UPDATE
    commits in the reference). The two changed columns are joined back once."""
    nu = conform(users, "network_users")
    narrow = nu.select(*NARROW)
    last = None
    for name in sequence:
        demoted = demotions(narrow, name, domain, collation)
        if checkpoint_between:
            demoted = cut_lineage(demoted)
        # The last resolver that demotes an account names its guid.
        step = demoted.toDF("__id", "__new")
        last = (step.select("__id", F.col("__new").alias("__guid")) if last is None else
                last.join(step, "__id", "full").select("__id", F.coalesce("__new", "__guid").alias("__guid")))
        narrow = _apply(narrow, demoted, NARROW)
        if checkpoint_between:
            narrow, last = cut_lineage(narrow), cut_lineage(last)
    return _apply(nu, last, users.columns) if last is not None else users
