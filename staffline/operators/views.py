"""Reporting views (people, hours, employees, job history, contractors,
learners, volunteers), each one lazy plan over the stored tables.

Dimension joins are plain equi-joins: the planner broadcasts a side only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE
re-plans from the real shuffle sizes), otherwise it shuffles both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.functions import (clip_end, clip_start, full_name_with_initial, in_year, looks_like_person,
                                 overlaps_year, round2, tsql_concat, year_fraction)
from staffline.operators import hours as H
from staffline.operators.reconcile import spread_nulls
from staffline.params import Params
from staffline.schemas import conform


def _pref(df: DataFrame, prefix: str, cols) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])


def _network(network_users: DataFrame) -> DataFrame:
    nu = conform(network_users, "network_users")
    return _pref(nu, "nu_", ["id", "common_name", "primary_email", "email", "network_email", "job_title",
                              "created_at", "disabled_at", "deleted_at", "is_deleted", "is_disabled",
                              "first_name", "last_name"])


def _email_chain(*cols):
    return F.coalesce("nu_primary_email", "nu_email", "nu_network_email", *cols)


#: Kind of key -> map column that holds it.
_KEYS = {"n": "network_id", "e": "employee_id", "c": "contractor_id", "l": "learner_id", "v": "volunteer_id",
         "x": "epic_id"}


def _keyed(kind: str, df: DataFrame, key: str = "id") -> DataFrame:
    """Rows of one kind of entity or fact under the key (kind, key) that the map refers to."""
    return df.withColumn("key", F.col(key).cast("string")).withColumn("kind", F.lit(kind)).drop(key)


def _map_keys(wm: DataFrame, kinds: str) -> DataFrame:
    """(id, kind, key) of every id that a map row refers to; NULL ids give no row."""
    refs = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(_KEYS[k]).cast("string").alias("key")) for k in kinds))
    return (wm.select("id", F.explode(F.filter(refs, lambda r: r["key"].isNotNull())).alias("r"))
            .select("id", "r.kind", "r.key"))


def _per_person(wm: DataFrame, parts: list[DataFrame], aggs: list, kinds: str) -> DataFrame:
    """One row per map row: the columns of all parts (rows keyed by (kind, key))
    that it refers to, by one join and one aggregate. A column comes from one
    kind, so its value is the only one there is; ``aggs`` sum up the others."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    summed = {name for _, name, used in aggs for name in used}
    plain = [c for c in rows.columns if c not in ("kind", "key") and c not in summed]
    own = [c for c in wm.columns if c != "id"]
    found = _map_keys(wm, kinds).join(rows, ["kind", "key"]).drop("key")
    return (found.unionByName(wm, allowMissingColumns=True).groupBy("id")
            .agg(*(F.max(c).alias(c) for c in own + plain), *(expr.alias(name) for expr, name, _ in aggs)))


def _identity_parts(t: dict, with_titles: bool) -> list[DataFrame]:
    """The account / employee / contractor / learner / volunteer columns of the
    people views, as rows keyed by (kind, key)."""
    base = ["id", "first_name", "last_name", "email"]
    extra = ["job_title", "uds_line", "hcai_line"] if with_titles else []
    e_cols = ["id", "legal_first_name", "legal_last_name", "work_email"]
    if with_titles:
        e_cols += ["job_title_id", "status", "hire_date", "start_date", "termination_date"]
    e = _pref(conform(t["employees"], "employees"), "e_", e_cols)
    entities = {k: conform(t[name], name).select(*base, *extra)
                for k, name in (("c", "contractors"), ("l", "learners"), ("v", "volunteers"))}
    if with_titles:
        jt = _pref(conform(t["employee_job_titles"], "employee_job_titles"), "t_", ["id", "job_title", "uds_line", "hcai_line"])
        e = (e.withColumn("__title", spread_nulls("e_job_title_id"))
             .join(jt, F.col("__title") == F.col("t_id"), "left").drop("t_id", "__title", "e_job_title_id"))
        # Earliest start of each (person, title), of all three kinds in one aggregate and one join.
        hours = {"c": "contractor", "l": "learner", "v": "volunteer"}
        starts, people = None, None
        for k, kind in hours.items():
            rows = conform(t[f"{kind}_job_hours"], f"{kind}_job_hours").select(
                F.lit(k).alias("kind"), F.col(f"{kind}_id").alias("id"), "job_title", "start_date")
            one = entities[k].withColumn("kind", F.lit(k))
            starts = rows if starts is None else starts.unionByName(rows)
            people = one if people is None else people.unionByName(one)
        starts = starts.groupBy("kind", "id", "job_title").agg(F.min("start_date").alias("start"))
        people = people.join(starts, ["kind", "id", "job_title"], "left")
        entities = {k: people.filter(F.col("kind") == k).drop("kind") for k in hours}
        extra = extra + ["start"]
        people = people.select(F.col("id").cast("string").alias("key"), "kind", *(
            F.when(F.col("kind") == k, F.col(c)).alias(f"{k}_{c}") for k in hours for c in base[1:] + extra))
        kept = [people]
    else:
        kept = [_keyed(k, _pref(df, f"{k}_", df.columns), f"{k}_id") for k, df in entities.items()]
    return [_keyed("n", _network(t["network_users"]), "nu_id"), _keyed("e", e, "e_id"), *kept]


def _staff_name():
    return (F.when(F.col("employee_id").isNotNull(), tsql_concat("e_legal_first_name", F.lit(" "), "e_legal_last_name"))
            .when(looks_like_person("nu_common_name"), F.col("nu_common_name"))
            .when(F.col("contractor_id").isNotNull(), tsql_concat("c_first_name", F.lit(" "), "c_last_name"))
            .when(F.col("learner_id").isNotNull(), tsql_concat("l_first_name", F.lit(" "), "l_last_name"))
            .when(F.col("volunteer_id").isNotNull(), tsql_concat("v_first_name", F.lit(" "), "v_last_name")))


def view_people(t: dict, params: Params) -> DataFrame:
    """One row per mapped person (VW-1).

    Every lookup and every sum of hours is a row keyed by (kind, key); the map is
    turned once into the keys it refers to, joined to them and aggregated by its
    unique ``id`` (see ``_per_person``). Learner / volunteer hour rows are collapsed
    to the earliest start date per (person, title) instead of fanning out one
    row per hour row (VW-l re-aimed).
    """
    wm = conform(t["workforce_map"], "workforce_map").select(
        "id", "network_id", "employee_id", "contractor_id", "learner_id", "volunteer_id",
        F.col("epic_id").cast("string").alias("epic_id"), "ecw_ids")
    hours = H.hours_by_owner(conform(t["employees"], "employees"), t["employee_hours"],
                             conform(t["employee_job_titles"], "employee_job_titles"),
                             conform(t["contractor_job_hours"], "contractor_job_hours"),
                             conform(t["learner_job_hours"], "learner_job_hours"),
                             conform(t["volunteer_job_hours"], "volunteer_job_hours"), params)
    clin = _keyed("x", t["clinical_providers"].select(F.col("user_id").alias("id"),
                                                      F.col("prov_id").alias("epic_prov_id")))
    counts = [(F.sum(F.when(F.col("kind") == k, F.col("h_rows"))), f"h_{k}", ("h_rows",)) for k in "clve"]
    j = _per_person(wm, [*_identity_parts(t, with_titles=True), hours, clin],
                    [*counts, (F.sum("h_hours"), "h_sum", ("h_hours",))], "neclvx")
    # Sources in order of name, each as often as it has hour rows.
    names = {"c": "Contractor", "e": "Employee", "l": "Learner", "v": "Volunteer"}
    listed = F.flatten(F.array(*(F.array_repeat(F.lit(n), F.coalesce(F.col(f"h_{k}"), F.lit(0)).cast("int"))
                                 for k, n in names.items())))
    j = (j.withColumn("calendar_year_hours_source", F.when(F.size(listed) > 0, F.array_join(listed, " | ")))
         .withColumn("calendar_year_hours", round2(F.col("h_sum")))
         .withColumn("calendar_year_ftes", round2(F.col("h_sum") / F.lit(float(params.fte_year_hours)))))

    staff_type = F.coalesce(
        F.col("calendar_year_hours_source"),
        F.when(F.col("employee_id").isNotNull(), "Employee")
        .when(F.col("contractor_id").isNotNull(), "Contractor")
        .when(F.col("learner_id").isNotNull(), "Learner")
        .when(F.col("volunteer_id").isNotNull(), "Volunteer"))
    status = (F.when((F.col("e_status") == "Terminated") | F.col("nu_is_deleted"), "Terminated")
              .when((F.col("e_status") == "Inactive") | F.col("nu_is_disabled"), "Inactive")
              .otherwise("Active"))
    start = F.coalesce(F.col("e_hire_date").cast("timestamp"), F.col("e_start_date").cast("timestamp"),
                       F.col("nu_created_at").cast("timestamp"), F.col("c_start").cast("timestamp"),
                       F.col("l_start").cast("timestamp"), F.col("v_start").cast("timestamp"))
    end = F.coalesce(F.col("e_termination_date").cast("timestamp"), F.col("nu_disabled_at").cast("timestamp"),
                     F.col("nu_deleted_at").cast("timestamp"))
    return j.select(
        "id", "network_id", "employee_id", "contractor_id", "learner_id", "volunteer_id",
        staff_type.alias("staff_type"), _staff_name().alias("staff_name"),
        _email_chain("e_work_email", "c_email", "l_email", "v_email").alias("email"),
        F.coalesce("t_job_title", "c_job_title", "l_job_title", "v_job_title", "nu_job_title").alias("job_title"),
        F.coalesce("t_uds_line", "c_uds_line", "l_uds_line", "v_uds_line").alias("current_uds_line"),
        F.coalesce("t_hcai_line", "c_hcai_line", "l_hcai_line", "v_hcai_line").alias("current_hcai_line"),
        status.alias("status"),
        F.date_format(start, "yyyy-MM-dd").alias("start_date"),
        F.date_format(end, "yyyy-MM-dd").alias("end_date"),
        F.col("epic_id").alias("epic_user_id"), "epic_prov_id", "ecw_ids",
        "calendar_year_hours", "calendar_year_ftes")


def _person_names(t: dict) -> DataFrame:
    """id, full_name, email of every mapped person (the inner view of VW-2)."""
    wm = conform(t["workforce_map"], "workforce_map").select(
        "id", "network_id", "employee_id", "contractor_id", "learner_id", "volunteer_id")
    j = _per_person(wm, _identity_parts(t, with_titles=False), [], "neclv")
    return j.select("id", _staff_name().alias("full_name"),
                    _email_chain("e_work_email", "c_email", "l_email", "v_email").alias("email"))


def view_hours(t: dict, params: Params, min_rows: int | None = None) -> DataFrame:
    """Per person x source x title x lines: hours, FTE and projected FTE (VW-2)."""
    y = params.reporting_year
    wm = conform(t["workforce_map"], "workforce_map")
    titles = conform(t["employee_job_titles"], "employee_job_titles")
    cjh = conform(t["contractor_job_hours"], "contractor_job_hours")
    ljh = conform(t["learner_job_hours"], "learner_job_hours")
    vjh = conform(t["volunteer_job_hours"], "volunteer_job_hours")
    line_cols = ["job_title", "uds_line", "hcai_line", "start_date", "end_date", "hours"]

    # Employee: pre-aggregate per (employee, title id) before joining the map.
    eh = (t["employee_hours"].filter(in_year("date", y))
          .groupBy("employee_id", "job_title_id")
          .agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"),
               F.sum("paid_minutes").alias("paid_minutes")))
    emp = (eh.join(titles.select(F.col("id").alias("job_title_id"), "job_title", "uds_line", "hcai_line"), "job_title_id")
           .groupBy("employee_id", "job_title", "uds_line", "hcai_line")
           .agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
                (F.sum("paid_minutes") / F.lit(60.0)).cast("double").alias("hours"))
           .select(F.col("employee_id").alias("id"), F.lit("Employee").alias("source"), *line_cols))

    con = (H.contractor_hours(cjh, y, by=("contractor_id", "job_title", "uds_line", "hcai_line"), with_dates=True)
           .withColumn("hours", H.pooled_hours(F.col("contractor_id"), F.col("hours").cast("double"), params.pooled_divisors))
           .select(F.col("contractor_id").alias("id"), F.lit("Contractor").alias("source"), *line_cols))

    lrn = (H.prorated_rows(ljh.select("learner_id", "job_title", "uds_line", "hcai_line", "start_date", "end_date", "hours"), y)
           .select(F.col("learner_id").alias("id"), F.lit("Learner").alias("source"), "job_title", "uds_line", "hcai_line",
                   F.col("adjusted_start_date").alias("start_date"), F.col("adjusted_end_date").alias("end_date"),
                   F.col("year_hours").alias("hours")))

    vol = (H.overlapping_rows(vjh.select("volunteer_id", "job_title", "uds_line", "hcai_line", "start_date", "end_date", "hours"), y)
           .select(F.col("volunteer_id").alias("id"), F.lit("Volunteer").alias("source"), "job_title", "uds_line", "hcai_line",
                   "start_date", "end_date", F.col("hours").cast("double").alias("hours")))

    # All sources meet the map in one join on (kind, key).
    owned = [_keyed(k, df) for k, df in (("e", emp), ("c", con), ("l", lrn), ("v", vol))]
    total = (_map_keys(wm, "eclv").join(owned[0].unionByName(owned[1]).unionByName(owned[2]).unionByName(owned[3]),
                                        ["kind", "key"]).select("id", "source", *line_cols))
    if params.dedupe_hours:
        total = total.distinct()
    # One-row frame: its size is fixed, so broadcasting it is always safe.
    workdays = F.broadcast(H.workday_hours(t["employee_hours"], params, min_rows))
    return (_person_names(t).join(total, "id").crossJoin(workdays)
            .select("id", "full_name", "email", "source", "job_title", "uds_line", "hcai_line",
                    "start_date", "end_date",
                    round2(F.col("hours")).alias("current_calendar_year_hours"),
                    round2(F.col("hours") / F.lit(float(params.fte_year_hours))).alias("current_calendar_year_fte"),
                    round2(F.try_divide(F.col("hours"), F.col("count").cast("double"))).alias("projected_eoy_fte")))


def view_employees(t: dict, params: Params) -> DataFrame:
    """Employee profile with this and last year's FTE and the manager's name (VW-3)."""
    y = params.reporting_year
    emp = conform(t["employees"], "employees")
    titles = conform(t["employee_job_titles"], "employee_job_titles")
    locs = conform(t["locations"], "locations")
    deps = conform(t["departments"], "departments")
    eh = t["employee_hours"]
    cur = H.employee_minutes(eh, y).select(
        F.col("employee_id").alias("_cur_id"),
        round2(F.col("paid_minutes").cast("double") / 60).alias("current_year_hours"),
        round2(F.col("paid_minutes").cast("double") / (60 * params.fte_year_hours)).alias("current_year_fte"))
    prev = H.employee_minutes(eh, y - 1).select(
        F.col("employee_id").alias("_prev_id"),
        round2(F.col("paid_minutes").cast("double") / (60 * params.fte_year_hours)).alias("previous_year_fte"))
    # Manager names keyed by the employee's primary key: the (employee, manager)
    # pairs without NULLs meet the manager rows, then join back on the unique id,
    # so employees without a manager never gather in one partition.
    mgr = (emp.filter(F.col("reports_to_id").isNotNull())
           .select(F.col("id").alias("_mgr_of"), F.col("reports_to_id").alias("_rid"))
           .join(emp.select(F.col("id").alias("_rid"), F.col("legal_first_name").alias("_mf"),
                            F.col("legal_middle_name").alias("_mm"), F.col("legal_last_name").alias("_ml")), "_rid")
           .drop("_rid"))
    wm = conform(t["workforce_map"], "workforce_map").select(F.col("id").alias("map_id"), F.col("employee_id").alias("_map_emp"))
    e = emp.alias("e")
    return (e.join(wm, F.col("e.id") == F.col("_map_emp"), "left")
            .join(mgr, F.col("e.id") == F.col("_mgr_of"), "left")
            .join(deps.select(F.col("id").alias("_dep_id"), F.col("name").alias("department")),
                  F.col("e.department_id") == F.col("_dep_id"), "left")
            .join(locs.select(F.col("id").alias("_loc_id"), F.coalesce("epic_location", "location").alias("location")),
                  F.col("e.location_id") == F.col("_loc_id"), "left")
            .join(titles.select(F.col("id").alias("_t_id"), "job_title", "uds_line", "hcai_line", "has_clinical_admin_time"),
                  F.col("e.job_title_id") == F.col("_t_id"), "left")
            .join(cur, F.col("e.id") == F.col("_cur_id"), "left")
            .join(prev, F.col("e.id") == F.col("_prev_id"), "left")
            .select(F.col("map_id").alias("id"), F.col("e.id").alias("employee_id"),
                    full_name_with_initial("e.legal_first_name", "e.legal_middle_name", "e.legal_last_name").alias("full_name"),
                    "e.work_email", "location", "department", "job_title", "uds_line", "hcai_line",
                    "has_clinical_admin_time", "e.status", "e.employment_type", "e.hire_date", "e.start_date",
                    "e.termination_date", "current_year_hours", "current_year_fte", "previous_year_fte",
                    "e.hired_fte", full_name_with_initial("_mf", "_mm", "_ml").alias("manager"), "e.is_manager"))


def view_job_history(t: dict) -> DataFrame:
    """Job history rows with titles and the person's map id (VW-4)."""
    emp = conform(t["employees"], "employees")
    titles = conform(t["employee_job_titles"], "employee_job_titles")
    hist = conform(t["employee_job_history"], "employee_job_history")
    wm = conform(t["workforce_map"], "workforce_map").select(F.col("id").alias("map_id"), F.col("employee_id").alias("_map_emp"))
    return (emp.alias("e")
            .join(wm, F.col("e.id") == F.col("_map_emp"), "left")
            .join(hist.alias("h"), F.col("e.id") == F.col("h.employee_id"))
            .join(titles.select(F.col("id").alias("_t_id"), "job_title", "uds_line", "hcai_line"),
                  F.col("h.job_title_id") == F.col("_t_id"))
            .select(F.col("map_id").alias("id"), F.col("e.id").alias("employee_id"),
                    full_name_with_initial("e.legal_first_name", "e.legal_middle_name", "e.legal_last_name").alias("full_name"),
                    "h.job_title_id", "job_title", "uds_line", "hcai_line", "h.start_date", "h.end_date",
                    "e.status", "h.inserted_at"))


def view_contractors(t: dict, params: Params) -> DataFrame:
    """Contractor profile, first/last dates, this and last year's hours / FTE (VW-5)."""
    y, fte = params.reporting_year, float(params.fte_year_hours)
    con = conform(t["contractors"], "contractors")
    cjh = conform(t["contractor_job_hours"], "contractor_job_hours")
    wm = conform(t["workforce_map"], "workforce_map").select(F.col("id").alias("map_id"), F.col("contractor_id").alias("_map_c"), "network_id")
    dates = cjh.groupBy("contractor_id").agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))
    cur = H.contractor_hours(cjh, y).select(F.col("contractor_id").alias("_cur_id"), F.col("hours").cast("double").alias("_cur_h"))
    prev = H.contractor_hours(cjh, y - 1).select(F.col("contractor_id").alias("_prev_id"), F.col("hours").cast("double").alias("_prev_h"))
    div = params.pooled_divisors
    return (con.alias("c")
            .join(wm, F.col("c.id") == F.col("_map_c"), "left")
            .withColumn("_net_key", spread_nulls("network_id"))
            .join(_network(t["network_users"]), F.col("_net_key") == F.col("nu_id"), "left")
            .join(dates.withColumnRenamed("contractor_id", "_d_id"), F.col("c.id") == F.col("_d_id"), "left")
            .join(cur, F.col("c.id") == F.col("_cur_id"), "left")
            .join(prev, F.col("c.id") == F.col("_prev_id"), "left")
            .select(F.col("map_id").alias("id"), F.col("c.id").alias("contractor_id"),
                    F.concat_ws(" ", "c.first_name", "c.last_name").alias("contractor"),
                    F.col("nu_common_name").alias("full_name"),
                    _email_chain("c.email").alias("email"),
                    "c.vendor", "c.job_title", "c.uds_line", "c.hcai_line", "start_date", "end_date",
                    round2(H.pooled_hours(F.col("_cur_id"), F.col("_cur_h"), div)).alias("current_year_hours"),
                    round2(H.pooled_hours(F.col("_cur_id"), F.col("_cur_h") / fte, div)).alias("current_year_fte"),
                    round2(H.pooled_hours(F.col("_prev_id"), F.col("_prev_h") / fte, div)).alias("previous_year_fte")))


def view_learners(t: dict, params: Params) -> DataFrame:
    """One row per learner x hour row with the year's prorated hours (VW-6).

    Each hour row carries its own prorated share (the reference's join of all
    current-year rows to all hour rows of a learner is re-aimed to this).
    """
    fte = float(params.fte_year_hours)
    lrn = conform(t["learners"], "learners")
    ljh = conform(t["learner_job_hours"], "learner_job_hours")
    wm = conform(t["workforce_map"], "workforce_map").select(F.col("id").alias("map_id"), F.col("learner_id").alias("_map_l"), "network_id")
    return (lrn.alias("l")
            .join(wm, F.col("l.id") == F.col("_map_l"), "left")
            .withColumn("_net_key", spread_nulls("network_id"))
            .join(_network(t["network_users"]), F.col("_net_key") == F.col("nu_id"), "left")
            .join(_learner_rows(ljh, params), F.col("l.id") == F.col("_h_l"), "left")
            .select(F.col("map_id").alias("id"), F.col("l.id").alias("learner_id"),
                    F.concat_ws(" ", "l.first_name", "l.last_name").alias("full_name"),
                    _email_chain("l.email").alias("email"),
                    "l.job_title", "l.site", "l.supervisor", "l.uds_line", "l.hcai_line",
                    "start_date", "end_date", "pre_graduate", "post_graduate", "workforce_role",
                    "adjusted_start_date", "adjusted_end_date",
                    F.col("year_hours").alias("current_year_hours"),
                    round2(F.col("year_hours") / fte).alias("current_year_fte")))


def _learner_rows(ljh: DataFrame, params: Params) -> DataFrame:
    """Every hour row; the year columns are set only when the row overlaps the
    year with positive hours."""
    y = params.reporting_year
    hours = F.coalesce(F.col("hours"), F.lit(0))
    ok = overlaps_year("start_date", "end_date", y) & (hours > 0)
    return ljh.select(
        F.col("learner_id").alias("_h_l"), "start_date", "end_date", "pre_graduate", "post_graduate", "workforce_role",
        F.when(ok, clip_start("start_date", y)).alias("adjusted_start_date"),
        F.when(ok, clip_end("end_date", y)).alias("adjusted_end_date"),
        F.when(ok, round2(year_fraction("start_date", "end_date", y) * hours.cast("double"))).alias("year_hours"))


def view_volunteers(t: dict, params: Params) -> DataFrame:
    """One row per volunteer x hour row of the volunteer's title (VW-7); the
    year's hours are those of that row when it overlaps the year."""
    fte = float(params.fte_year_hours)
    vol = conform(t["volunteers"], "volunteers")
    vjh = conform(t["volunteer_job_hours"], "volunteer_job_hours")
    wm = conform(t["workforce_map"], "workforce_map").select(F.col("id").alias("map_id"), F.col("volunteer_id").alias("_map_v"), "network_id")
    hours = F.coalesce(F.col("hours"), F.lit(0))
    ok = overlaps_year("start_date", "end_date", params.reporting_year) & (hours > 0)
    rows = vjh.select(F.col("volunteer_id").alias("_h_v"), F.col("job_title").alias("_h_t"), "start_date", "end_date",
                      "pre_graduate", "post_graduate", "workforce_role",
                      F.when(ok, F.col("hours").cast("double")).alias("current_year_hours"))
    return (vol.alias("v")
            .join(wm, F.col("v.id") == F.col("_map_v"), "left")
            .withColumn("_net_key", spread_nulls("network_id"))
            .join(_network(t["network_users"]), F.col("_net_key") == F.col("nu_id"), "left")
            .join(rows, (F.col("v.id") == F.col("_h_v")) & (F.col("v.job_title") == F.col("_h_t")), "left")
            .select(F.col("map_id").alias("id"), F.col("v.id").alias("volunteer_id"),
                    F.concat_ws(" ", "v.first_name", "v.last_name").alias("full_name"),
                    _email_chain("v.email").alias("email"),
                    "v.job_title", "v.supervisor", "v.is_event_only", "v.uds_line", "v.hcai_line",
                    "start_date", "end_date", "pre_graduate", "post_graduate", "workforce_role",
                    "current_year_hours",
                    round2(F.col("current_year_hours") / fte).alias("current_year_fte")))
