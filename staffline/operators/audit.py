"""Integrity audits of the identity map and the entity tables.

Each audit returns the offending rows (an empty result means the check
passes); all are set differences, anti joins or grouped counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.functions import looks_like_person, norm_key, tsql_concat
from staffline.operators.reconcile import not_in, spread_nulls
from staffline.params import CLINICAL_USER_TYPES, ECW_INSTANCES
from staffline.schemas import conform

MAP_COLUMNS = {"employee": "employee_id", "contractor": "contractor_id", "learner": "learner_id",
               "volunteer": "volunteer_id"}

#: Map column of each kind that ``audit_all`` looks at.
AUDITED = {"network": "network_id", **MAP_COLUMNS, "relevant": "relevant_id", "epic": "epic_id"}


def unmapped_entities(entities: DataFrame, workforce_map: DataFrame, kind: str,
                      keep: F.Column | None = None) -> DataFrame:
    """Entity ids missing from the map (``SELECT id ... EXCEPT SELECT <kind>_id FROM map``)."""
    ids = entities if keep is None else entities.filter(keep)
    col = MAP_COLUMNS[kind]
    return ids.select("id").subtract(conform(workforce_map, "workforce_map").select(F.col(col).alias("id")))


def expected_employee(since_year: int) -> F.Column:
    """Still active, or terminated since that year."""
    return F.col("termination_date").isNull() | (F.col("termination_date") >= F.lit(dt.date(since_year, 1, 1)))


def unmapped_employees(employees: DataFrame, workforce_map: DataFrame, since_year: int) -> DataFrame:
    """Employees still active or terminated since ``since_year`` but not mapped."""
    return unmapped_entities(employees, workforce_map, "employee", expected_employee(since_year))


def orphan_ids(workforce_map: DataFrame, entities: DataFrame, kind: str) -> DataFrame:
    """Mapped ids that no longer exist in the entity table."""
    col = MAP_COLUMNS[kind]
    wm = conform(workforce_map, "workforce_map")
    return wm.filter(F.col(col).isNotNull()).select(col).subtract(entities.select(F.col("id").alias(col)))


def expected_ehr(providers: DataFrame, encounters: DataFrame | None = None, service_area=None,
                 service_accounts: tuple = ()) -> DataFrame:
    """EHR user ids, as text, of providers (that have encounters, when given);
    of one service area if it is given, without the named service accounts."""
    p = providers.filter(F.col("user_id").isNotNull())
    if service_area is not None:
        p = p.filter(F.col("serv_area_id") == F.lit(service_area))
    if service_accounts:
        p = p.filter(~F.col("user_id").isin(*service_accounts))
    if encounters is not None:
        p = p.join(encounters.select(F.col("visit_prov_id").alias("__v")), F.col("prov_id") == F.col("__v"), "left_semi")
    return p.select(F.col("user_id").cast("string").alias("user_id")).distinct()


def unmapped_ehr(providers: DataFrame, workforce_map: DataFrame, encounters: DataFrame | None = None,
                 service_area=None, service_accounts: tuple = ()) -> DataFrame:
    """The users of ``expected_ehr`` that are not in the map."""
    users = expected_ehr(providers, encounters, service_area, service_accounts)
    wm = conform(workforce_map, "workforce_map")
    return users.subtract(wm.filter(F.col("epic_id").isNotNull()).select(F.col("epic_id").cast("string")))


def orphan_ehr(workforce_map: DataFrame, ehr_users: DataFrame) -> DataFrame:
    wm = conform(workforce_map, "workforce_map")
    return (wm.filter(F.col("epic_id").isNotNull()).select(F.col("epic_id").cast("string").alias("epic_id"))
            .subtract(ehr_users.select(F.col("user_id").cast("string"))))


def unmapped_accounts(network_users: DataFrame, workforce_map: DataFrame, since_year: int,
                      sql_null_semantics: bool = False) -> DataFrame:
    """Primary real-user accounts not in the map, unless disabled or deleted
    before ``since_year``. ``sql_null_semantics`` reproduces ``NOT IN`` over a
    map whose network_id has NULLs (then no row is returned)."""
    nu = conform(network_users, "network_users")
    since = F.lit(dt.datetime(since_year, 1, 1))
    keep = ((F.col("is_primary_acct") == F.lit(True)) & (F.col("is_non_user") == F.lit(False))
            & (F.col("disabled_at").isNull() | (F.col("disabled_at") >= since))
            & (F.col("deleted_at").isNull() | (F.col("deleted_at") >= since)))
    cols = ["id", "source", "first_name", "last_name", "common_name", "network_email", "primary_email",
            "email", "job_title", "account_name", "active_dir_group", "department", "location",
            "user_description", "phone_extension", "mobile_phone", "created_at", "inserted_at",
            "is_disabled", "disabled_at", "is_deleted", "deleted_at"]
    wm = conform(workforce_map, "workforce_map")
    return not_in(nu.filter(keep), wm, "id", "network_id", sql_null_semantics).select(*cols)


def duplicate_ids(workforce_map: DataFrame, col: str, include_null: bool = False) -> DataFrame:
    """Map ids used by more than one person (``HAVING COUNT(*) > 1``)."""
    wm = conform(workforce_map, "workforce_map")
    src = wm if include_null else wm.filter(F.col(col).isNotNull())
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def audit_all(workforce_map: DataFrame, entities: dict[str, DataFrame], columns: dict[str, str] | None = None,
              count_null: Sequence[str] = ("network",)) -> DataFrame:
    """(finding, kind, key, people) of all kinds in one pass: ``unmapped`` (people 0),
    ``orphan`` and ``duplicate`` (people: how many map rows hold the key).

    ``entities`` gives, for each kind that has any, rows (id, exists, expected): whether the
    entity is there, and whether the map should hold it. The map is read once and its
    references exploded to (kind, key); they and the entities' keys meet in one aggregate,
    reduced before the shuffle, so a key that a third of the people share costs one row a task.
    Keys are compared as text. NULL references count for the kinds in ``count_null``
    (as duplicates only); a kind without entities has duplicates only.
    """
    columns = AUDITED if columns is None else columns
    wm = conform(workforce_map, "workforce_map")
    refs = (wm.select(F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(col).cast("string").alias("key"))
                                          for kind, col in columns.items()))).alias("r"))
            .select("r.kind", "r.key", F.lit(1).alias("people"), F.lit(False).alias("exists"), F.lit(False).alias("expected"))
            .filter(F.col("key").isNotNull() | F.col("kind").isin(*count_null)))
    known = (rows.filter(F.col("id").isNotNull())
             .select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("key"), F.lit(0).alias("people"), "exists", "expected")
             for kind, rows in entities.items())
    seen = (reduce(DataFrame.unionByName, known, refs).groupBy("kind", "key")
            .agg(F.sum("people").alias("people"), F.max("exists").alias("exists"), F.max("expected").alias("expected")))
    has_entities = F.col("kind").isin(*entities) & F.col("key").isNotNull()
    findings = F.array(F.when(F.col("expected") & (F.col("people") == 0), F.lit("unmapped")),
                       F.when(has_entities & ~F.col("exists") & (F.col("people") > 0), F.lit("orphan")),
                       F.when(F.col("people") > 1, F.lit("duplicate")))
    return seen.select(F.explode(F.array_compact(findings)).alias("finding"), "kind", "key", "people")


def json_ids(workforce_map: DataFrame, instances: Sequence[str] | None = ECW_INSTANCES) -> DataFrame:
    """(id, network_id, source, ecw_id) for every id listed in the JSON column
    (an empty or missing list yields no row, like CROSS APPLY). The map is read
    and parsed once for all ``instances``; None takes every instance that the column names."""
    wm = conform(workforce_map, "workforce_map")
    lists = wm.select("id", "network_id", F.explode(F.from_json("ecw_ids", "map<string,array<string>>")).alias("source", "__ids"))
    if instances is not None:
        lists = lists.filter(F.col("source").isin(*instances))
    return lists.select("id", "network_id", "source", F.explode("__ids").alias("ecw_id"))


def duplicate_json_ids(workforce_map: DataFrame, instances=ECW_INSTANCES) -> DataFrame:
    """JSON ids used by more than one person (after UNION-distinct of (id, source, ecw_id))."""
    ids = json_ids(workforce_map, instances).select("id", "source", "ecw_id").distinct()
    return ids.groupBy("source", "ecw_id").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def json_name_check(workforce_map: DataFrame, network_users: DataFrame, clinical: dict,
                    user_types=CLINICAL_USER_TYPES) -> DataFrame:
    """Side by side: the person's directory name / e-mail and each linked
    clinical account's name / e-mail, for clinician user types."""
    nu = conform(network_users, "network_users").select(
        F.col("id").alias("__nid"), "common_name", "first_name", "last_name", "primary_email", "network_email",
        F.col("email").alias("email_alias"))
    # The users of all instances, each with its instance, meet the ids of all instances in one join.
    users = reduce(DataFrame.unionByName, (
        u.select(F.lit(source).alias("__source"), F.col("uid").alias("__uid"), "uemail", "ufname", "ulname", "usertype")
        for source, u in clinical.items()))
    ids = json_ids(workforce_map, tuple(clinical))
    # The filter on the clinical side makes its join an inner one.
    linked = ids.join(users.filter(F.col("usertype").isin(*user_types)),
                      (F.col("ecw_id") == F.col("__uid")) & (F.col("source") == F.col("__source")))
    return (linked.withColumn("__net_key", spread_nulls("network_id"))
            .join(nu, F.col("__net_key") == F.col("__nid"), "left")
            .select("id", "source", F.col("__uid").alias("ecw_id"),
                    F.coalesce("email_alias", "primary_email", "network_email").alias("network_email"),
                    norm_key("uemail").alias("ecw_email"),
                    F.when(looks_like_person("common_name"), F.col("common_name"))
                    .otherwise(tsql_concat("first_name", F.lit(" "), "last_name")).alias("network_name"),
                    F.concat_ws(" ", "ufname", "ulname").alias("ecw_name"))
            .distinct())


__all__ = ["unmapped_entities", "unmapped_employees", "orphan_ids", "unmapped_ehr", "orphan_ehr",
           "unmapped_accounts", "duplicate_ids", "audit_all", "json_ids", "duplicate_json_ids", "json_name_check"]
