"""Cross-system identity linkage: directory accounts <-> HR employees,
analytics users and EHR users.

The reference matches with an OR of equalities (any of three e-mails, full
name, or first + last name), which Spark can only run as a nested-loop or
cartesian join. Here every side is turned into tagged keys
``(kind, k1, k2)`` (one row per non-blank key) and joined on equality. The
candidate side is first reduced to its best row per key (a partial
aggregate), so a key shared by many rows never multiplies into all pairs;
the winner per target row is then one more partial aggregate. Blank keys
never match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffline.functions import name_last_first, norm_key
from staffline.operators.ordering import first_by
from staffline.operators.reconcile import anti_join, join_update, sref
from staffline.params import EXCLUDED_EHR_IDS
from staffline.schemas import conform

KIND_RANK = {"email": 0, "full_name": 1, "first_last": 2}


def _keys(df: DataFrame, id_col: str, entries: list[tuple[str, Column, Column | None]], extra=()) -> DataFrame:
    """One row per non-blank key of a row: (id, kind, k1, k2).

    A row may repeat a key (same e-mail in two columns); every consumer
    reduces with ``min``, so repeats are harmless and no distinct (shuffle)
    is needed here."""
    arr = F.array(*[F.struct(F.lit(kind).alias("kind"), k1.alias("k1"),
                             (k2 if k2 is not None else F.lit("")).alias("k2"))
                    for kind, k1, k2 in entries])
    return (df.select(F.col(id_col).alias("__id"), *extra, F.explode(arr).alias("__k"))
            .select("__id", *[F.col(c) for c in extra], "__k.kind", "__k.k1", "__k.k2")
            .filter(F.col("k1").isNotNull() & (F.col("k1") != "") & F.col("k2").isNotNull()
                    & ~((F.col("kind") == "first_last") & (F.col("k2") == ""))))


def _email_keys(df: DataFrame, id_col: str, cols=("network_email", "email", "primary_email")) -> DataFrame:
    return _keys(df, id_col, [("email", norm_key(c), None) for c in cols])


def _best_per_key(keys: DataFrame) -> DataFrame:
    """Smallest candidate id per (kind, k1, k2)."""
    return keys.groupBy("kind", "k1", "k2").agg(F.min("__id").alias("__cand"))


def link_employees(network_users: DataFrame, employees: DataFrame, workforce_map: DataFrame) -> DataFrame:
    """New (network_id, employee_id) links between unmapped primary real-user
    accounts and unmapped employees whose work e-mail equals one of the
    account's e-mails: every matched employee with its smallest account id, and
    every matched account with its smallest employee id. That is at most one row per
    employee plus one per account, and no matched side is left out."""
    wm = conform(workforce_map, "workforce_map")
    nu = conform(network_users, "network_users")
    users = anti_join(nu.filter((F.col("is_non_user") == F.lit(False)) & (F.col("is_primary_acct") == F.lit(True))),
                      wm, "id", "network_id")
    emps = anti_join(employees, wm, "id", "employee_id")
    ukeys = _email_keys(users, "id")
    ekeys = _keys(emps, "id", [("email", norm_key("work_email"), None)])

    def best(rows: DataFrame, others: DataFrame, row_id: str, other_id: str) -> DataFrame:
        return (rows.join(_best_per_key(others), ["kind", "k1", "k2"])
                .groupBy(F.col("__id").alias(row_id)).agg(F.min("__cand").alias(other_id))
                .select("network_id", "employee_id"))

    return best(ekeys, ukeys, "employee_id", "network_id").union(
        best(ukeys, ekeys, "network_id", "employee_id")).distinct()


def link_analytics(analytics_users: DataFrame, network_users: DataFrame, workforce_map: DataFrame) -> DataFrame:
    """Set ``workforce_map.analytics_id`` from analytics users matched by e-mail
    to the map row's account; ids already used anywhere in the map are
    skipped; the smallest analytics id wins per map row."""
    wm = conform(workforce_map, "workforce_map")
    nu = conform(network_users, "network_users")
    free = anti_join(analytics_users, wm, "id", "analytics_id")
    akeys = _best_per_key(_keys(free, "id", [("email", norm_key("email"), None)]))
    per_user = (_email_keys(nu, "id").join(akeys, ["kind", "k1", "k2"])
                .groupBy(F.col("__id").alias("network_id")).agg(F.min("__cand").alias("new_analytics_id")))
    upd = (wm.select("id", "network_id", "analytics_id").join(per_user, "network_id")
           .filter(F.col("analytics_id").isNull() | (F.col("analytics_id") != F.col("new_analytics_id")))
           .select("id", F.col("new_analytics_id").alias("analytics_id")))
    return join_update(wm, upd, "id", {"analytics_id": sref("analytics_id")})


def join_ehr_users(users: DataFrame, demographics: DataFrame) -> DataFrame:
    """The EHR's user rows with the e-mail of their demographic row (users
    without one are left out)."""
    return users.join(demographics.select("user_id", "email"), "user_id")


def ehr_names(ehr_users: DataFrame) -> DataFrame:
    """Adds lower-cased first / last name from ``"Last, First"`` and the
    ``"first last"`` form."""
    first, last = name_last_first("name")
    return (ehr_users.withColumn("first_name", first).withColumn("last_name", last)
            .withColumn("reformatted_name", F.when(first.isNotNull(), F.concat(first, F.lit(" "), last))))


def best_ehr_rows(ehr_users: DataFrame, excluded=EXCLUDED_EHR_IDS) -> DataFrame:
    """One EHR row per name: with e-mail first, then lowest status, then the
    latest password update, then the smallest user id."""
    rows = ehr_names(ehr_users.filter(~F.col("user_id").isin(*excluded)))
    order = [(F.col("email").isNull().cast("int"), "asc"), ("user_status_c", "asc"),
             ("last_pw_update", "desc"), ("user_id", "asc")]
    return first_by(rows, ["name"], order)


def link_ehr(ehr_users: DataFrame, network_users: DataFrame, workforce_map: DataFrame,
             excluded=EXCLUDED_EHR_IDS) -> DataFrame:
    """Set ``workforce_map.epic_id`` (where NULL) from unmapped EHR users
    matched to the map row's account by e-mail, full name, or first + last
    name; per map row the best kind wins (e-mail, full name, first + last),
    then the smallest user id."""
    wm = conform(workforce_map, "workforce_map").withColumn("epic_id", F.col("epic_id").cast("string"))
    nu = conform(network_users, "network_users")
    cand = anti_join(best_ehr_rows(ehr_users, excluded), wm, "user_id", "epic_id")
    ckeys = _keys(cand, "user_id", [("email", norm_key("email"), None),
                                    ("full_name", norm_key("reformatted_name"), None),
                                    ("first_last", norm_key("first_name"), norm_key("last_name"))])
    ckeys = _best_per_key(ckeys)
    ukeys = _keys(nu, "id", [("email", norm_key("network_email"), None), ("email", norm_key("email"), None),
                             ("email", norm_key("primary_email"), None), ("full_name", norm_key("common_name"), None),
                             ("first_last", norm_key("first_name"), norm_key("last_name"))])
    rank = F.when(F.col("kind") == "email", 0).when(F.col("kind") == "full_name", 1).otherwise(2)
    per_user = (ukeys.join(ckeys, ["kind", "k1", "k2"])
                .groupBy(F.col("__id").alias("network_id"))
                .agg(F.min(F.struct(rank.alias("r"), F.col("__cand").alias("u"))).alias("__best"))
                .select("network_id", F.col("__best.u").alias("new_epic_id")))
    upd = (wm.filter(F.col("epic_id").isNull()).select("id", "network_id").join(per_user, "network_id")
           .select("id", F.col("new_epic_id").alias("epic_id")))
    return join_update(wm, upd, "id", {"epic_id": sref("epic_id")})
