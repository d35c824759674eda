"""Fixture recipes: the supplied TPC-H-style tables re-shaped into the
staffing tables (see FIXTURES.md part B).

The same SQL text feeds both engines: Spark runs it through
``spark.sql(recipe, **tables)``; the DuckDB oracle prepends it as a CTE.
"""

from __future__ import annotations

RECIPES: dict[str, str] = {
    "fx_job_titles": (
        'SELECT CAST(p_partkey AS BIGINT) AS id, CAST(p_partkey AS BIGINT) AS job_title_id, p_name AS job_title, p_brand AS uds_line, CAST(p_size AS STRING) AS hcai_line, p_size > 25 AS has_clinical_admin_time FROM part'
    ),
    "fx_employees": (
        "SELECT CAST(c_custkey AS BIGINT) AS id, concat('G', lpad(CAST(c_custkey AS STRING), 15, '0')) AS aoid, CAST(c_nationkey AS BIGINT) AS location_id, CAST(c_custkey % 12 AS BIGINT) AS department_id, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 50 AS BIGINT) END AS reports_to_id, CAST(c_custkey % 50 AS BIGINT) AS job_title_id, c_mktsegment AS legal_first_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Quinn' END AS legal_middle_name, concat('Name', CAST(c_custkey AS STRING)) AS legal_last_name, concat(' ', c_mktsegment, '.', CAST(c_custkey AS STRING), '@Example.org') AS work_email, CASE WHEN c_acctbal < 0 THEN 'Terminated' WHEN c_acctbal < 1000 THEN 'Inactive' ELSE 'Active' END AS status, DATE '1995-01-01' + CAST(c_custkey % 1500 AS INT) AS hire_date, CASE WHEN c_acctbal < 0 THEN DATE '2000-06-30' END AS termination_date, c_custkey % 10 = 0 AS is_manager FROM customer"
    ),
    "fx_employee_hours": (
        'SELECT CAST(o_custkey AS BIGINT) AS employee_id, CAST(MAX(o_orderkey % 50) AS BIGINT) AS job_title_id, CAST(o_orderdate AS DATE) AS date, CAST(SUM(o_orderkey % 480) AS BIGINT) AS work_minutes, CAST(SUM(o_orderkey % 600) AS BIGINT) AS paid_minutes, CAST(SUM(o_orderkey % 400) AS BIGINT) AS regular_minutes FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)'
    ),
    "fx_raw_timecards": (
        "SELECT concat('G', lpad(CAST(o_custkey AS STRING), 15, '0')) AS associate_oid, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_start, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS entry_date, CASE l_linenumber WHEN 1 THEN 'REGULAR' WHEN 2 THEN 'REGSAL' WHEN 3 THEN 'OVERTIME' WHEN 4 THEN 'PTO' WHEN 5 THEN 'UNPAID' ELSE 'ZZZ' END AS pay_code, concat('PT', CAST(CAST(l_quantity AS INT) % 12 AS STRING), 'H', CAST(CAST(l_quantity AS BIGINT) AS STRING), 'M') AS time_duration FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
    ),
    "fx_job_history": (
        "SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS BIGINT) AS employee_id, CAST(o_orderkey % 50 AS BIGINT) AS job_title_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date, o_orderdate AS inserted_at FROM orders"
    ),
    "fx_network_users": (
        "SELECT CAST(c_custkey AS BIGINT) AS id, concat('g-', CAST(c_custkey AS STRING)) AS guid, concat('g-', CAST(c_custkey AS STRING)) AS primary_guid, CASE WHEN c_custkey % 2 = 0 THEN 'server1' ELSE 'server2' END AS source, c_mktsegment AS first_name, concat('Name', CAST(CASE WHEN c_custkey % 12 = 0 THEN c_custkey % 36 ELSE c_custkey END AS STRING)) AS last_name, concat(c_mktsegment, ' Name', CAST(c_custkey % 300 AS STRING)) AS common_name, concat(c_mktsegment, ' D', CAST(c_custkey % 60 AS STRING)) AS display_name, CASE WHEN c_custkey % 10 = 0 THEN concat('team', CAST(c_custkey % 30 AS STRING), '@example.org') ELSE concat(lower(c_mktsegment), '.', CAST(c_custkey AS STRING), '@example.org') END AS network_email, CASE WHEN c_custkey % 6 <> 0 THEN concat('primary.', CAST(c_custkey % 70 AS STRING), '@example.org') END AS primary_email, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('u', CAST(c_custkey % 97 AS STRING), CASE WHEN c_custkey % 3 = 0 THEN '@organizationname.org' ELSE '@example.org' END) END AS email, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS job_title, TIMESTAMP '2000-01-01 00:00:00' AS created_at, c_custkey % 19 = 0 AS is_disabled, c_custkey % 11 = 0 AS is_deleted, TRUE AS is_primary_acct, c_custkey % 23 = 0 AS is_non_user FROM customer WHERE c_custkey % 17 <> 0"
    ),
    "fx_network_snapshot": (
        "SELECT concat('g-', CAST(c_custkey AS STRING)) AS guid, CASE WHEN c_custkey % 2 = 0 THEN 'server1' ELSE 'server2' END AS source, c_mktsegment AS first_name, concat('Name', CAST(CASE WHEN c_custkey % 12 = 0 THEN c_custkey % 36 ELSE c_custkey END AS STRING)) AS last_name, concat(c_mktsegment, ' Name', CAST(c_custkey % 300 AS STRING)) AS common_name, concat(c_mktsegment, ' D', CAST(c_custkey % 60 AS STRING)) AS display_name, CASE WHEN c_custkey % 10 = 0 THEN concat('team', CAST(c_custkey % 30 AS STRING), '@example.org') ELSE concat(lower(c_mktsegment), '.', CAST(c_custkey AS STRING), '@example.org') END AS network_email, CASE WHEN c_custkey % 6 <> 0 THEN concat('primary.', CAST(c_custkey % 70 AS STRING), '@example.org') END AS primary_email, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('u', CAST(c_custkey % 97 AS STRING), CASE WHEN c_custkey % 3 = 0 THEN '@organizationname.org' ELSE '@example.org' END) END AS email, CASE WHEN c_custkey % 14 = 0 THEN 'CHANGED' WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS job_title, TIMESTAMP '2000-01-01 00:00:00' AS created_at, c_custkey % 38 = 0 AS is_disabled FROM customer WHERE c_custkey % 13 <> 0"
    ),
    "fx_workforce_map": (
        'SELECT CAST(c_custkey AS BIGINT) AS id, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey AS BIGINT) END AS network_id, CASE WHEN c_custkey % 51 = 0 THEN CAST(c_custkey + 1000000 AS BIGINT) WHEN c_custkey % 33 = 0 THEN CAST(c_custkey - 3 AS BIGINT) WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS BIGINT) END AS employee_id, CASE WHEN c_custkey % 19 = 0 AND c_custkey % 3 = 1 THEN CAST(c_custkey + 2000000 AS BIGINT) WHEN c_custkey % 3 = 1 THEN CAST(c_custkey % 50 * 2 AS BIGINT) END AS contractor_id, CASE WHEN c_custkey % 47 = 0 AND c_custkey % 3 = 2 THEN CAST(c_custkey + 3000000 AS BIGINT) WHEN c_custkey % 3 = 2 THEN CAST(c_custkey % 150 AS BIGINT) END AS learner_id, CASE WHEN c_custkey % 30 = 12 THEN CAST(c_custkey + 4000000 AS BIGINT) WHEN c_custkey % 10 = 2 THEN CAST(c_custkey % 150 AS BIGINT) END AS volunteer_id, CASE WHEN c_custkey % 8 = 0 THEN CAST(c_custkey % 40 AS BIGINT) END AS relevant_id, CASE WHEN c_custkey % 16 = 0 THEN CAST(c_custkey + 100000 AS BIGINT) WHEN c_custkey % 16 = 2 THEN CAST(7 AS BIGINT) END AS analytics_id, CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 700 AS BIGINT) END AS epic_id, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat(\'{"ecw instance 1":["\', CAST(c_custkey % 900 AS STRING), \'","\', CAST(c_custkey % 31 AS STRING), \'"],"ecw instance 2":["\', CAST(c_custkey % 800 AS STRING), \'"]}\') END AS ecw_ids FROM customer'
    ),
    "fx_contractors": (
        "SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS first_name, CAST(s_nationkey AS STRING) AS last_name, concat('c', CAST(s_suppkey AS STRING), '@vendor.example') AS email, CASE WHEN s_suppkey % 2 = 0 THEN 'MD' ELSE 'RN' END AS job_title FROM supplier"
    ),
    "fx_contractor_job_hours": (
        "SELECT CAST(l_suppkey AS BIGINT) AS contractor_id, CASE WHEN l_linenumber % 2 = 0 THEN 'MD' ELSE 'RN' END AS job_title, l_returnflag AS uds_line, l_linestatus AS hcai_line, CAST(l_shipdate AS DATE) AS start_date, CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INT) AS end_date, CAST(l_quantity AS DECIMAL(6,2)) AS hours FROM lineitem"
    ),
    "fx_learner_job_hours": (
        "SELECT CAST(user_id AS BIGINT) AS learner_id, CASE WHEN event_id % 2 = 0 THEN 'Intern' ELSE 'Resident' END AS job_title, CAST(ts AS DATE) - CAST(event_id % 40 AS INT) AS start_date, CAST(ts AS DATE) + CAST(event_id % 400 AS INT) AS end_date, CAST(event_id % 300 AS DECIMAL(6,2)) AS hours FROM events WHERE event_type = 'view'"
    ),
    "fx_volunteer_job_hours": (
        "SELECT CAST(user_id AS BIGINT) AS volunteer_id, 'Volunteer' AS job_title, CAST(ts AS DATE) AS start_date, CAST(ts AS DATE) + 30 AS end_date, CAST(event_id % 9 AS DECIMAL(3,2)) AS hours FROM events WHERE event_type = 'signup'"
    ),
    "fx_ehr_users": (
        "SELECT concat('E', CAST(c_custkey AS STRING)) AS user_id, CASE WHEN c_custkey % 2 = 0 THEN concat(lower(c_mktsegment), '.', CAST(c_custkey AS STRING), '@example.org') END AS email, concat('NAME', CAST(c_custkey % 900 AS STRING), ', ', c_mktsegment) AS name, CAST(c_custkey % 3 AS BIGINT) AS user_status_c, TIMESTAMP '2000-01-01 00:00:00' AS last_pw_update FROM customer"
    ),
    "fx_locations": (
        "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS location, CASE WHEN n_nationkey % 2 = 0 THEN concat('Clinic ', n_name) END AS epic_location FROM nation"
    ),
    "fx_departments": (
        "SELECT CAST(s_suppkey AS BIGINT) AS id, concat('Department ', CAST(s_suppkey AS STRING)) AS name FROM supplier"
    ),
    "fx_workers_snapshot": (
        "SELECT CAST(c_custkey AS BIGINT) AS id, concat('G', lpad(CAST(c_custkey AS STRING), 15, '0')) AS aoid, CAST(c_nationkey AS BIGINT) AS location_id, concat('Site ', CAST(c_nationkey AS STRING)) AS location, CAST(c_custkey % 12 AS BIGINT) AS department_id, concat('Department ', CAST(c_custkey % 12 AS STRING)) AS department, CASE WHEN c_custkey % 8 = 0 THEN 'Rivera' WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Quinn' END AS legal_middle_name, CASE WHEN c_custkey % 20 = 0 THEN 'Terminated' ELSE 'Active' END AS status, CAST(c_custkey % 50 AS BIGINT) AS job_title_id FROM customer WHERE c_custkey % 13 <> 0"
    ),
    "fx_learners": (
        "SELECT CAST(c_custkey AS BIGINT) AS id, c_mktsegment AS first_name, concat('Learner', CAST(c_custkey AS STRING)) AS last_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('l', CAST(c_custkey AS STRING), '@school.example') END AS email, CASE WHEN c_custkey % 2 = 0 THEN 'Intern' ELSE 'Resident' END AS job_title FROM customer"
    ),
    "fx_volunteers": (
        "SELECT CAST(c_custkey AS BIGINT) AS id, c_mktsegment AS first_name, concat('Volunteer', CAST(c_custkey AS STRING)) AS last_name, concat('v', CAST(c_custkey AS STRING), '@home.example') AS email, 'Volunteer' AS job_title, c_custkey % 4 = 0 AS is_event_only FROM customer"
    ),
    "fx_analytics_users": (
        "SELECT CAST(c_custkey + 100000 AS BIGINT) AS id, c_mktsegment AS first_name, concat('Name', CAST(c_custkey AS STRING)) AS last_name, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat(' ', upper(c_mktsegment), '.', CAST(c_custkey AS STRING), '@example.org ') END AS email FROM customer WHERE c_custkey % 2 = 0"
    ),
    "fx_clinical_users": (
        "SELECT CAST(c_custkey AS STRING) AS uid, concat(' U', CAST(c_custkey AS STRING), '@Example.org') AS uemail, c_mktsegment AS ufname, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('Name', CAST(c_custkey AS STRING)) END AS ulname, CAST(c_custkey % 12 AS BIGINT) AS usertype FROM customer"
    ),
}

# Recipes of this library (not in FIXTURES.md), same dialect rules: plain SQL
# that Spark and DuckDB both run unchanged.
RECIPES.update({
    # EHR provider table keyed by the EHR user id (epic ids of fx_workforce_map are 0..699).
    "fx_clinical_providers": (
        "SELECT CAST(c_custkey AS STRING) AS user_id, concat('P', CAST(c_custkey AS STRING)) AS prov_id, "
        "CAST(c_custkey % 4 AS BIGINT) AS serv_area_id "
        "FROM customer"
    ),
})

RECIPES.update({
    # Full worker staging rows (the flattened HR snapshot), derived from
    # fx_workers_snapshot: some payroll ids change (id % 29), some titles are new (id % 7),
    # some workers are re-hired under a new aoid (id % 31).
    "fx_worker_staging": (
        "SELECT CAST(CASE WHEN w.id % 29 = 0 THEN w.id + 100000 ELSE w.id END AS BIGINT) AS id, "
        "CASE WHEN w.id % 31 = 0 THEN concat('H', substr(w.aoid, 2)) ELSE w.aoid END AS aoid, "
        "w.location_id, w.location, w.department_id, w.department, "
        "CASE WHEN w.id % 9 = 0 THEN NULL ELSE CAST(w.id % 50 AS BIGINT) END AS reports_to_id, w.job_title_id, "
        "CASE WHEN w.id % 7 = 0 AND jt.job_title IS NOT NULL THEN concat(jt.job_title, ' II') ELSE jt.job_title END AS job_title, "
        "c.c_mktsegment AS legal_first_name, w.legal_middle_name, concat('Name', CAST(c.c_custkey AS STRING)) AS legal_last_name, "
        "CAST(NULL AS STRING) AS preferred_first_name, CAST(NULL AS STRING) AS preferred_middle_name, "
        "CAST(NULL AS STRING) AS preferred_last_name, CASE WHEN c.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender, "
        "CAST(NULL AS STRING) AS pronouns, concat(' ', c.c_mktsegment, '.', CAST(c.c_custkey AS STRING), '@Example.org') AS work_email, "
        "CAST(NULL AS STRING) AS personal_email, CAST(NULL AS STRING) AS personal_mobile, w.status, "
        "CASE WHEN c.c_custkey % 2 = 0 THEN 'Full Time' ELSE 'Part Time' END AS employment_type, "
        "DATE '1995-01-01' + CAST(c.c_custkey % 1500 AS INT) AS hire_date, "
        "CAST(date_trunc('month', DATE '1995-01-01' + CAST(c.c_custkey % 1500 AS INT)) AS DATE) AS start_date, "
        "CAST(NULL AS DATE) AS evaluation_date, CASE WHEN w.status = 'Terminated' THEN DATE '2000-06-30' END AS termination_date, "
        "CAST(NULL AS DECIMAL(6,2)) AS hired_fte, c.c_custkey % 10 = 0 AS is_manager, "
        "DATE '1970-01-01' + CAST(c.c_custkey % 9000 AS INT) AS dob, concat(CAST(c.c_custkey AS STRING), ' Main St') AS address_line_1, "
        "CAST(NULL AS STRING) AS address_line_2, 'Davis' AS city, 'CA' AS state, '95616' AS zip_code "
        "FROM fx_workers_snapshot w JOIN customer c ON w.id = c.c_custkey "
        "LEFT JOIN (SELECT job_title_id, MIN(job_title) AS job_title FROM fx_job_titles GROUP BY job_title_id) jt "
        "ON w.job_title_id = jt.job_title_id"
    ),
    # Stored employee_info rows: every 7th carries a stale aoid (so its worker is
    # inserted), some cities differ.
    "fx_employee_info": (
        "SELECT CAST(c_custkey AS BIGINT) AS id, "
        "concat(CASE WHEN c_custkey % 7 = 0 THEN 'R' ELSE 'G' END, lpad(CAST(c_custkey AS STRING), 15, '0')) AS aoid, "
        "DATE '1970-01-01' + CAST(c_custkey % 9000 AS INT) AS dob, concat(CAST(c_custkey AS STRING), ' Main St') AS address_line_1, "
        "CAST(NULL AS STRING) AS address_line_2, CASE WHEN c_custkey % 5 = 0 THEN 'Woodland' ELSE 'Davis' END AS city, "
        "'CA' AS state, '95616' AS zip_code FROM customer"
    ),
    # Stored timecard dates.
    "fx_timecard_dates": (
        "SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start, CAST(o_orderdate AS DATE) AS date "
        "FROM orders"
    ),
})
