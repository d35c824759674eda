"""Query keys of document flattening (SRC-1, SRC-3, 2.2 extractors, 2.3 directory).

Documents are derived from the supplied tables (one worker document and one
directory entry per customer) as JSON text and parsed with the fixed
schemas, exactly like landed files; the oracles state the expected values
from the same base columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from staffline.operators import flatten as FL
from staffline.plans.registry import query
from staffline.sources import documents as DOC


def _workers(t):
    docs = DOC.parse(DOC.worker_documents_from_tables(t["customer"], t["employee_job_titles"]), "doc",
                     DOC.WORKER_PAGE_SCHEMA)
    return FL.flatten_workers(docs)


def _directory(t):
    return FL.flatten_directory(DOC.directory_entries_from_tables(t["customer"]))


_K = "c.c_custkey"
_ACTUAL = f"CASE WHEN {_K} % 9 = 0 THEN DATE '1992-01-01' + CAST({_K} % 900 AS INTEGER) END"
_SENIOR = f"CASE WHEN {_K} % 5 <> 0 THEN DATE '1994-06-01' + CAST({_K} % 1400 AS INTEGER) END"
_ORIGINAL = f"CASE WHEN {_K} % 4 <> 0 THEN DATE '1993-01-01' + CAST({_K} % 1100 AS INTEGER) END"
WORKER_SQL = f"""
WITH jt AS (SELECT job_title_id, MIN(job_title) AS title FROM fx_job_titles GROUP BY job_title_id)
SELECT CAST({_K} AS BIGINT) AS id, concat('G', printf('%015d', {_K})) AS aoid,
  CAST(c.c_nationkey AS BIGINT) AS location_id, concat('Site ', CAST(c.c_nationkey AS VARCHAR)) AS location,
  CAST({_K} % 12 AS BIGINT) AS department_id, concat('Department ', CAST({_K} % 12 AS VARCHAR)) AS department,
  CASE WHEN {_K} % 9 <> 0 THEN CAST({_K} % 50 AS BIGINT) END AS reports_to_id,
  CAST({_K} % 50 AS BIGINT) AS job_title_id, COALESCE(jt.title, concat('Title ', CAST({_K} % 50 AS VARCHAR))) AS job_title,
  c.c_mktsegment AS legal_first_name, CASE WHEN {_K} % 3 <> 0 THEN 'Quinn' END AS legal_middle_name,
  concat('Name', CAST({_K} AS VARCHAR)) AS legal_last_name,
  CASE WHEN {_K} % 6 = 0 THEN concat('Pref', CAST({_K} AS VARCHAR)) END AS preferred_first_name,
  CASE WHEN {_K} % 12 = 0 THEN 'Mid' END AS preferred_middle_name,
  CASE WHEN {_K} % 18 = 0 THEN 'Last' END AS preferred_last_name,
  CASE WHEN {_K} % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender, CASE WHEN {_K} % 7 = 0 THEN 'they/them' END AS pronouns,
  lower(concat(c.c_mktsegment, '.', CAST({_K} AS VARCHAR), '@Example.org')) AS work_email,
  CASE WHEN {_K} % 4 <> 0 THEN lower(concat('P', CAST({_K} AS VARCHAR), '@Mail.example')) END AS personal_email,
  CASE WHEN {_K} % 3 = 0 THEN concat('(530) 555-', lpad(CAST({_K} % 10000 AS VARCHAR), 4, '0')) END AS personal_mobile,
  CASE WHEN c.c_acctbal < 0 THEN 'Terminated' ELSE 'Active' END AS status,
  CASE WHEN {_K} % 2 = 0 THEN 'Full Time' ELSE 'FT' END AS employment_type,
  {_ACTUAL} AS actual_seniority_date, {_SENIOR} AS seniority_date, {_ORIGINAL} AS original_hire_date,
  CASE WHEN {_K} % 17 = 0 THEN DATE '2023-10-01' ELSE DATE '1995-01-01' + CAST({_K} % 1500 AS INTEGER) END AS hire_date,
  CASE WHEN {_K} % 17 = 0 THEN COALESCE({_ACTUAL}, {_SENIOR}, {_ORIGINAL})
       ELSE DATE '1995-01-01' + CAST({_K} % 1500 AS INTEGER) END AS ultimate_hire_date,
  DATE '1995-01-01' + CAST({_K} % 1500 AS INTEGER) AS start_date,
  CASE WHEN {_K} % 3 = 1 THEN DATE '2001-01-01' + CAST({_K} % 300 AS INTEGER) END AS evaluation_date,
  CASE WHEN c.c_acctbal < 0 THEN DATE '2000-06-30' END AS termination_date,
  CAST(c.c_acctbal / 10000 AS DECIMAL(6,2)) AS hired_fte, {_K} % 10 = 0 AS is_manager,
  DATE '1970-01-01' + CAST({_K} % 9000 AS INTEGER) AS dob, concat(CAST({_K} AS VARCHAR), ' Main St') AS address_line_1,
  CASE WHEN {_K} % 8 = 0 THEN concat('Apt ', CAST({_K} AS VARCHAR)) END AS address_line_2, 'Davis' AS city, 'CA' AS state,
  concat('95', lpad(CAST({_K} % 1000 AS VARCHAR), 3, '0')) AS zip_code
FROM customer c LEFT JOIN jt ON CAST({_K} % 50 AS INTEGER) = jt.job_title_id
"""


@query("worker_flatten", WORKER_SQL)
def q_worker_flatten(t):
    """SRC-1 + 2.2: worker pages -> 38 staging columns (fail-fast policy checks)."""
    return _workers(t)


_SEG = "c.c_mktsegment"
_TITLE_SEG = f"concat(upper(substr({_SEG}, 1, 1)), lower(substr({_SEG}, 2)))"
DIRECTORY_SQL = f"""
SELECT concat('g-', CAST({_K} AS VARCHAR)) AS guid,
  CASE WHEN {_K} % 2 = 0 THEN 'server1' ELSE 'server2' END AS source,
  concat({_TITLE_SEG}, '-O''Neil') AS first_name,
  concat('Name', CAST({_K} AS VARCHAR)) AS last_name,
  concat({_TITLE_SEG}, ' Name', CAST({_K} % 300 AS VARCHAR)) AS common_name,
  CASE WHEN {_K} % 5 <> 0 THEN concat({_TITLE_SEG}, ' Mc', lower({_SEG})) END AS display_name,
  concat(lower({_SEG}), '.', CAST({_K} AS VARCHAR), '@example.org') AS network_email,
  CASE WHEN {_K} % 6 <> 0 THEN concat('primary.', CAST({_K} AS VARCHAR), '@example.org') END AS primary_email,
  CASE WHEN {_K} % 4 <> 0 THEN concat('u', CAST({_K} % 97 AS VARCHAR), '@example.org') END AS email,
  {_SEG} AS job_title, concat('acc', CAST({_K} AS VARCHAR)) AS account_name,
  concat('Group', CAST({_K} % 7 AS VARCHAR)) AS active_dir_group,
  'Dept' AS department, CASE WHEN {_K} % 2 = 0 THEN concat('Site ', CAST({_K} % 25 AS VARCHAR)) END AS location,
  CASE WHEN {_K} % 3 = 0 THEN concat('Boss ', CAST({_K} % 11 AS VARCHAR)) END AS manager,
  CASE WHEN {_K} % 7 <> 0 THEN concat(' Staff ', CAST({_K} AS VARCHAR)) END AS user_description,
  CASE WHEN {_K} % 8 <> 0 THEN concat('x', CAST({_K} % 1000 AS VARCHAR)) END AS phone_extension,
  CASE WHEN {_K} % 9 = 0 THEN concat('(530) 555-', lpad(CAST({_K} % 10000 AS VARCHAR), 4, '0')) END AS mobile_phone,
  TIMESTAMP '2000-01-01 00:00:00' + to_seconds(CAST({_K} % 3600 AS BIGINT)) AS created_at,
  {_K} % 3 = 2 AS is_disabled
FROM customer c
"""


@query("directory_flatten", DIRECTORY_SQL)
def q_directory_flatten(t):
    """SRC-3 + 2.3: entries of two directory servers -> 20 account columns."""
    return _directory(t)


@query("primary_email", f"SELECT guid, primary_email FROM ({DIRECTORY_SQL})")
def q_primary_email(t):
    """DIR-5: first upper-case SMTP proxy address, lower-cased."""
    return _directory(t).select("guid", "primary_email")


@query("title_case_names", f"SELECT guid, first_name, last_name, common_name, display_name FROM ({DIRECTORY_SQL})")
def q_title_case_names(t):
    """DIR-2 / SCA-3: Python-style title case (every letter run capitalised)."""
    return _directory(t).select("guid", "first_name", "last_name", "common_name", "display_name")


@query("dn_group", f"SELECT guid, source, active_dir_group FROM ({DIRECTORY_SQL})")
def q_dn_group(t):
    """DIR-6: group from the distinguished name, offset by server."""
    return _directory(t).select("guid", "source", "active_dir_group")


# A derived document fails a required-field check only where its source column
# is NULL: the given name (market segment) is the only nullable source of a
# required field; all others derive from the key or constants.
@query("worker_quarantine", """
SELECT CASE WHEN c_custkey % 10 <> 3 THEN concat('G', printf('%015d', c_custkey)) END AS aoid,
  CASE c_custkey % 10 WHEN 1 THEN 'no primary assignment, id, job_title_id, job_title' WHEN 3 THEN 'page does not parse'
       WHEN 4 THEN 'dob, hire_date' WHEN 5 THEN 'location_id' ELSE 'zip_code' END AS errors
FROM customer WHERE c_custkey % 10 IN (1, 3, 4, 5, 6)
""")
def q_worker_quarantine(t):
    """2.2 quarantine mode: rows failing a required-field check, with their errors."""
    docs = DOC.worker_documents_from_tables(t["customer"], t["employee_job_titles"])
    # Damage by the last digit of the worker's number: no primary assignment, a page cut off, unreadable dates,
    # an unreadable code, a required field gone.
    doc, last = F.col("doc"), F.regexp_extract("doc", r'"associateOID":"G\d*(\d)"', 1)
    docs = docs.withColumn("doc", F.when(last == "1", F.replace(doc, F.lit('"primaryIndicator":true'), F.lit('"primaryIndicator":false')))
                           .when(last == "3", F.left(doc, F.lit(100)))
                           .when(last == "4", F.regexp_replace(doc, r'"(hireDate|birthDate)":"', '"$1":"x'))
                           .when(last == "5", F.regexp_replace(doc, r'"homeWorkLocation":\{"nameCode":\{"codeValue":"', '$0N/A'))
                           .when(last == "6", F.replace(doc, F.lit('"postalCode"'), F.lit('"gone"'))).otherwise(doc))
    docs = DOC.parse(docs, "doc", DOC.WORKER_PAGE_SCHEMA)
    good, bad = FL.flatten_workers(docs, mode="quarantine")
    return bad.select("aoid", F.array_join("errors", ", ").alias("errors"))


@query("directory_quarantine", """
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'server1' ELSE 'server2' END AS source,
  CASE WHEN c_custkey % 10 < 2 THEN 'entry does not parse' ELSE 'no objectGUID' END AS error,
  CASE WHEN c_custkey % 10 >= 2 THEN concat('ACC', c_custkey) END AS account_name
FROM customer WHERE c_custkey % 10 IN (0, 1, 6, 7)
""")
def q_directory_quarantine(t):
    """2.1 SRC-3 quarantine mode: entries that are cut off or have no (or an empty) objectGUID."""
    entries = DOC.directory_entries_from_tables(t["customer"])
    lines = entries.select("source", F.to_json(F.struct(*[c for c in entries.columns if c != "source"])).alias("line"))
    # Damage by the last digit of the account's number.
    last = F.regexp_extract("line", r'"sAMAccountName":"ACC\d*(\d)"', 1)
    lines = lines.withColumn("line", F.when(last.isin("0", "1"), F.left("line", F.lit(60)))
                             .when(last == "6", F.replace("line", F.lit('"objectGUID"'), F.lit('"gone"')))
                             .when(last == "7", F.regexp_replace("line", r'"objectGUID":"[^"]*"', '"objectGUID":""'))
                             .otherwise(F.col("line")))
    _, bad = FL.flatten_directory(DOC.parse(lines, "line", DOC.DIRECTORY_SCHEMA, keep=["source"]), mode="quarantine")
    return bad.select("source", "error", "account_name")
