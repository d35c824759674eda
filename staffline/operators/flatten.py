"""Landed documents -> staging rows (workers, directory entries).

The worker flattener is table-driven: each output column is
``(name, expression, policy[, code or date text])`` where policy ``R`` = required (a NULL is an
error), ``N`` = missing gives NULL, ``D`` = missing gives a default (built
into the expression). A document without a primary assignment is an error, as
are a page that does not parse and a code or date that is there but unreadable.
``mode='failfast'`` raises on the first error row (the reference aborts the
run); ``mode='quarantine'`` returns (good rows, error rows) instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffline.functions import dn_group, manager_cn, primary_email, strip, strip_lower, title_case
from staffline.params import DN_GROUP_OFFSET, ENABLED_UAC, HIRE_SENTINEL, POSITION_PREFIX
from staffline.sources.documents import CORRUPT, unparsed

W = "w"  # struct column holding one worker document


def _w(path: str) -> Column:
    return F.col(f"{W}.{path}")


def primary_assignment() -> Column:
    return F.get(F.filter(_w("workAssignments"), lambda a: a["primaryIndicator"] == F.lit(True)), 0)


def _date(c: Column) -> Column:
    return c.try_cast("date")


PA = "__pa"  # the primary assignment, extracted once per row
LOST = "__lost"  # whether the row stands for a page that does not parse


def worker_columns(hire_sentinel: str = HIRE_SENTINEL, position_prefix: str = POSITION_PREFIX) -> list[tuple]:
    pa = F.col(PA)
    unit = F.get(pa["assignedOrganizationalUnits"], 1)["nameCode"]
    person = _w("person")
    site = pa["homeWorkLocation"]["nameCode"]["codeValue"]
    position = F.get(pa["reportsTo"], 0)["positionID"]
    reports = F.nullif(F.regexp_extract(position, position_prefix + r"(\d+)", 1), F.lit("")).try_cast("bigint")

    def unread(text: Column, kind: str) -> Column:
        return text.isNotNull() & text.try_cast(kind).isNull()

    dates = _w("customFieldGroup.dateFields")
    hire = _date(pa["hireDate"])
    actual_seniority = _date(F.get(dates, 2)["dateValue"])
    seniority = _date(pa["seniorityDate"])
    original = _date(_w("workerDates.originalHireDate"))
    return [
        ("id", pa["payrollFileNumber"].try_cast("bigint"), "R"),
        ("aoid", _w("associateOID"), "R"),
        ("location_id", F.coalesce(site.try_cast("bigint"), F.lit(0)), "D", unread(site, "bigint")),
        ("location", F.coalesce(pa["homeWorkLocation"]["nameCode"]["shortName"], F.lit("Unassigned")), "D"),
        ("department_id", F.coalesce(unit["codeValue"].try_cast("bigint"), F.lit(0)), "D", unread(unit["codeValue"], "bigint")),
        ("department", F.coalesce(F.regexp_replace(F.coalesce(unit["shortName"], unit["longName"]), r"\d+ - (.*)", "$1"),
                                  F.lit("Unassigned")), "D"),
        ("reports_to_id", reports, "N", position.isNotNull() & reports.isNull()),
        ("job_title_id", pa["jobCode"]["codeValue"].try_cast("bigint"), "R"),
        ("job_title", F.coalesce(pa["jobCode"]["longName"], pa["jobCode"]["shortName"]), "R"),
        ("legal_first_name", person["legalName"]["givenName"], "R"),
        ("legal_middle_name", person["legalName"]["middleName"], "N"),
        ("legal_last_name", person["legalName"]["familyName1"], "R"),
        ("preferred_first_name", person["preferredName"]["givenName"], "N"),
        ("preferred_middle_name", person["preferredName"]["middleName"], "N"),
        ("preferred_last_name", person["preferredName"]["familyName1"], "N"),
        ("gender", person["genderCode"]["longName"], "N"),
        ("pronouns", person["preferredGenderPronounCode"]["shortName"], "N"),
        ("work_email", F.lower(F.get(_w("businessCommunication.emails"), 0)["emailUri"]), "N"),
        ("personal_email", F.lower(F.get(person["communication"]["emails"], 0)["emailUri"]), "N"),
        ("personal_mobile", F.get(person["communication"]["mobiles"], 0)["formattedNumber"], "N"),
        ("status", _w("workerStatus.statusCode.codeValue"), "N"),
        ("employment_type", F.coalesce(pa["workerTypeCode"]["longName"], pa["workerTypeCode"]["shortName"]), "N"),
        ("actual_seniority_date", actual_seniority, "N", unread(F.get(dates, 2)["dateValue"], "date")),
        ("seniority_date", seniority, "N", unread(pa["seniorityDate"], "date")),
        ("original_hire_date", original, "N", unread(_w("workerDates.originalHireDate"), "date")),
        ("hire_date", hire, "N", unread(pa["hireDate"], "date")),
        ("ultimate_hire_date", F.when(hire == F.lit(hire_sentinel).cast("date"),
                                      F.coalesce(actual_seniority, seniority, original)).otherwise(hire), "N"),
        ("start_date", _date(pa["actualStartDate"]), "N", unread(pa["actualStartDate"], "date")),
        ("evaluation_date", _date(F.get(dates, 1)["dateValue"]), "N", unread(F.get(dates, 1)["dateValue"], "date")),
        ("termination_date", _date(_w("workerDates.terminationDate")), "N", unread(_w("workerDates.terminationDate"), "date")),
        ("hired_fte", pa["fullTimeEquivalenceRatio"].cast("decimal(6,2)"), "N"),
        ("is_manager", pa["managementPositionIndicator"], "N"),
        ("dob", _date(person["birthDate"]), "R"),
        ("address_line_1", person["legalAddress"]["lineOne"], "R"),
        ("address_line_2", person["legalAddress"]["lineTwo"], "N"),
        ("city", person["legalAddress"]["cityName"], "R"),
        ("state", person["legalAddress"]["countrySubdivisionLevel1"]["codeValue"], "R"),
        ("zip_code", F.substring(person["legalAddress"]["postalCode"], 1, 5), "R"),
    ]


def flatten_workers(docs: DataFrame, mode: str = "failfast", **kw):
    """One staging row per worker. ``docs`` has a ``workers`` array column (a
    landed page) or one worker struct per row in column ``w``."""
    pages = docs if "workers" in docs.columns else None
    if pages is not None:
        bad_page = unparsed(pages, "workers")
        workers = F.col("workers")
        if mode != "quarantine":
            # Inside the exploded expression: a filter before it would come after the NULL check that Spark infers.
            workers = F.when(bad_page, F.raise_error(F.lit("worker page does not parse"))).otherwise(workers)
        else:
            # A lost page goes on as one row without a worker: a filter of its own for such pages would make
            # and parse every document again, once for each mention of it.
            workers = F.when(bad_page, F.array(F.lit(None).cast(pages.schema["workers"].dataType.elementType))).otherwise(workers)
        rows = pages.select(F.explode(workers).alias(W), (bad_page if mode == "quarantine" else F.lit(False)).alias(LOST))
    else:
        rows = docs.select(W, F.lit(False).alias(LOST))
    rows = rows.select(W, primary_assignment().alias(PA), LOST)
    spec = worker_columns(**kw)
    errors = F.when(F.col(LOST), F.array(F.lit("page does not parse"))).otherwise(F.array_compact(F.array(
        F.when(F.col(PA).isNull(), F.lit("no primary assignment")),
        *[F.when(expr.isNull(), F.lit(name)) for name, expr, policy, *_ in spec if policy == "R"],
        *[F.when(unread[0], F.lit(name)) for name, _, _, *unread in spec if unread])))
    # The row number keeps the optimizer from copying the long error expression into a filter further down
    # (and from there into every constraint it infers): predicates are not moved below it.
    flat = rows.select(*[expr.alias(name) for name, expr, *_ in spec], errors.alias("__errors"), LOST,
                       F.monotonically_increasing_id().alias("__row"))
    counted = F.col("__row") >= 0
    if mode == "quarantine":
        bad = flat.filter(counted & (F.size("__errors") > 0))
        # Of a lost page nothing is known: no defaults either.
        bad = bad.select(*[(F.when(~F.col(LOST), F.col(name)) if policy == "D" else F.col(name)).alias(name)
                           for name, _, policy, *_ in spec], F.col("__errors").alias("errors"))
        return flat.filter(counted & (F.size("__errors") == 0)).drop("__errors", "__row", LOST), bad
    # A filter predicate (not a dropped column, which the optimizer would prune) so every row is checked.
    said = F.filter(F.array(F.array_join("__errors", ", ")), lambda e: e != "")
    ok = F.forall(said, lambda e: F.raise_error(F.concat(F.lit("worker document error: "),
                                                         F.coalesce(F.col("aoid"), F.lit("?")), F.lit(": "), e)).isNull())
    return flat.filter(counted & ok).drop("__errors", "__row", LOST)


def flatten_directory(entries: DataFrame, source_col: str = "source", offsets: dict | None = None,
                      mode: str = "failfast"):
    """Directory entries (any number of servers, tagged by ``source``) -> network_users columns.

    An entry that does not parse or has no objectGUID ends the run: as a row of NULLs it would
    delete its account. With ``mode="quarantine"`` the result is (rows, bad): bad entries with
    their source, error, account name and text, beside the others."""
    text = F.col(CORRUPT) if CORRUPT in entries.columns else F.lit(None).cast("string")
    error = (F.when(text.isNotNull(), F.lit("entry does not parse"))
             .when(F.coalesce(F.col("objectGUID"), F.lit("")) == "", F.lit("no objectGUID")))
    if mode == "quarantine":
        marked = entries.withColumn("__error", error)
        bad = marked.where(F.col("__error").isNotNull()).select(
            F.col(source_col).alias("source"), F.col("__error").alias("error"),
            F.when(text.isNull(), F.col("sAMAccountName")).alias("account_name"), text.alias("entry"))
        return _directory_columns(marked.where(F.col("__error").isNull()), source_col, offsets), bad
    # A filter predicate (not a column, which the optimizer would prune) so every entry is checked.
    said = F.when(error.isNotNull(), F.raise_error(F.concat(F.lit("directory entry of "), F.coalesce(F.col(source_col), F.lit("?")),
                                                            F.lit(": "), error)).cast("boolean")).otherwise(F.lit(True))
    return _directory_columns(entries.where(said), source_col, offsets)


def _directory_columns(entries: DataFrame, source_col: str, offsets: dict | None) -> DataFrame:
    offsets = offsets or DN_GROUP_OFFSET
    off = None
    for src, n in offsets.items():
        off = F.when(F.col(source_col) == src, F.lit(n)) if off is None else off.when(F.col(source_col) == src, F.lit(n))
    guid = F.col("objectGUID")
    return entries.select(
        F.when(guid.isNotNull(), F.substring(guid, F.lit(2), F.length(guid) - 2)).alias("guid"),
        F.col(source_col).alias("source"),
        title_case("givenName").alias("first_name"),
        title_case("sn").alias("last_name"),
        title_case("cn").alias("common_name"),
        title_case("displayName").alias("display_name"),
        strip_lower("userPrincipalName").alias("network_email"),
        primary_email("proxyAddresses").alias("primary_email"),
        strip_lower("mail").alias("email"),
        strip("title").alias("job_title"),
        strip_lower("sAMAccountName").alias("account_name"),
        dn_group("distinguishedName", off).alias("active_dir_group"),
        strip("department").alias("department"),
        strip("physicalDeliveryOfficeName").alias("location"),
        manager_cn("manager").alias("manager"),
        F.col("description").alias("user_description"),
        F.col("telephoneNumber").alias("phone_extension"),
        F.col("mobile").alias("mobile_phone"),
        F.date_trunc("second", F.col("whenCreated")).alias("created_at"),
        (~F.coalesce(F.col("userAccountControl").isin(*ENABLED_UAC), F.lit(False))).alias("is_disabled"))
