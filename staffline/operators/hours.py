"""Calendar-year hours of the four staff kinds (employee, contractor,
learner, volunteer) and FTE arithmetic.

Every source is pre-aggregated to one row per owner before it is joined to
the identity map, so the large fact tables never travel through a join
un-reduced; sums are partial (map-side) aggregates and stay skew-proof.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffline.functions import in_year, overlaps_year, round2, year_fraction
from staffline.functions.dates import clip_end, clip_start
from staffline.params import Params


def pooled_hours(contractor_id: Column, hours: Column, divisors: dict) -> Column:
    """Hours of a pooled contractor id are shared by several people."""
    expr = None
    for cid, div in divisors.items():
        cond = contractor_id == F.lit(cid)
        expr = F.when(cond, hours / F.lit(float(div))) if expr is None else expr.when(cond, hours / F.lit(float(div)))
    return hours if expr is None else expr.otherwise(hours)


def employee_minutes(employee_hours: DataFrame, year: int, by: tuple = ("employee_id",)) -> DataFrame:
    """Sum of paid minutes per key within one calendar year (VW-a)."""
    return (employee_hours.filter(in_year("date", year))
            .groupBy(*by).agg(F.sum("paid_minutes").alias("paid_minutes")))


def contractor_hours(contractor_job_hours: DataFrame, year: int, by: tuple = ("contractor_id",),
                     with_dates: bool = False) -> DataFrame:
    """Contractor hours whose start date falls in the year (VW-b), summed per key."""
    aggs = [F.sum("hours").alias("hours")]
    if with_dates:
        aggs = [F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")] + aggs
    return contractor_job_hours.filter(in_year("start_date", year)).groupBy(*by).agg(*aggs)


def prorated_rows(job_hours: DataFrame, year: int, nullable_hours: bool = False) -> DataFrame:
    """Hour rows overlapping the year, with the year's share of their hours (VW-c).

    Adds ``adjusted_start_date``, ``adjusted_end_date`` and ``year_hours``
    (= hours x (clipped days + 1) / (days + 1), rounded to 2 places).
    """
    hours = F.coalesce(F.col("hours"), F.lit(0)) if nullable_hours else F.col("hours")
    return (job_hours
            .filter(overlaps_year("start_date", "end_date", year) & (hours > 0))
            .withColumn("adjusted_start_date", clip_start("start_date", year))
            .withColumn("adjusted_end_date", clip_end("end_date", year))
            .withColumn("year_hours", round2(year_fraction("start_date", "end_date", year)
                                             * hours.cast("double"))))


def overlapping_rows(job_hours: DataFrame, year: int) -> DataFrame:
    """Hour rows overlapping the year, hours not prorated (VW-d)."""
    return job_hours.filter(overlaps_year("start_date", "end_date", year) & (F.col("hours") > 0))


def workforce_hours(workforce_map: DataFrame, employees: DataFrame, employee_hours: DataFrame,
                    job_titles: DataFrame, contractor_job_hours: DataFrame,
                    learner_job_hours: DataFrame, volunteer_job_hours: DataFrame,
                    params: Params) -> DataFrame:
    """(id, source, hours) rows of every mapped person for the reporting year.

    ``params.dedupe_hours`` reproduces a UNION-distinct of these rows (two
    equal rows of one person collapse); by default every row is kept.
    """
    y = params.reporting_year
    m = workforce_map.select("id", "employee_id", "contractor_id", "learner_id", "volunteer_id")

    # Employee: the employee's current title must exist (inner join).
    emp = (employees.select(F.col("id").alias("employee_id"), "job_title_id")
           .join(job_titles.select(F.col("id").alias("job_title_id")), "job_title_id")
           .join(employee_minutes(employee_hours, y), "employee_id")
           .join(m.select("id", "employee_id"), "employee_id")
           .select("id", F.lit("Employee").alias("source"),
                   (F.col("paid_minutes") / F.lit(60.0)).cast("double").alias("hours")))

    con = (contractor_hours(contractor_job_hours, y)
           .join(m.select("id", "contractor_id"), "contractor_id")
           .select("id", F.lit("Contractor").alias("source"),
                   pooled_hours(F.col("contractor_id"), F.col("hours").cast("double"),
                                params.pooled_divisors).alias("hours")))

    lrn = (prorated_rows(learner_job_hours.select("learner_id", "start_date", "end_date", "hours"), y)
           .join(m.select("id", "learner_id"), "learner_id")
           .select("id", F.lit("Learner").alias("source"), F.col("year_hours").alias("hours")))

    vol = (overlapping_rows(volunteer_job_hours.select("volunteer_id", "start_date", "end_date", "hours"), y)
           .join(m.select("id", "volunteer_id"), "volunteer_id")
           .select("id", F.lit("Volunteer").alias("source"), F.col("hours").cast("double").alias("hours")))

    out = emp.unionByName(con).unionByName(lrn).unionByName(vol)
    return out.distinct() if params.dedupe_hours else out


def hours_by_owner(employees: DataFrame, employee_hours: DataFrame, job_titles: DataFrame,
                   contractor_job_hours: DataFrame, learner_job_hours: DataFrame,
                   volunteer_job_hours: DataFrame, params: Params) -> DataFrame:
    """(kind, key, h_rows, h_hours): how many hour rows ``workforce_hours`` has for
    each owner of hours and their sum, before any person is looked up. Kinds: e, c, l, v."""
    y = params.reporting_year
    emp = (employees.select(F.col("id").alias("employee_id"), "job_title_id")
           .join(job_titles.select(F.col("id").alias("job_title_id")), "job_title_id")
           .join(employee_minutes(employee_hours, y), "employee_id")
           .select(F.lit("e").alias("kind"), F.col("employee_id").alias("key"),
                   (F.col("paid_minutes") / F.lit(60.0)).cast("double").alias("hours")))
    con = contractor_hours(contractor_job_hours, y).select(
        F.lit("c").alias("kind"), F.col("contractor_id").alias("key"),
        pooled_hours(F.col("contractor_id"), F.col("hours").cast("double"), params.pooled_divisors).alias("hours"))
    lrn = prorated_rows(learner_job_hours.select("learner_id", "start_date", "end_date", "hours"), y).select(
        F.lit("l").alias("kind"), F.col("learner_id").alias("key"), F.col("year_hours").alias("hours"))
    vol = overlapping_rows(volunteer_job_hours.select("volunteer_id", "start_date", "end_date", "hours"), y).select(
        F.lit("v").alias("kind"), F.col("volunteer_id").alias("key"), F.col("hours").cast("double").alias("hours"))
    rows = lrn.unionByName(vol)
    if params.dedupe_hours:
        rows = rows.distinct()
    # Employees and contractors have one row each by now.
    summed = rows.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("h_rows"), F.sum("hours").alias("h_hours"))
    single = emp.unionByName(con).select("kind", "key", F.lit(1).cast("long").alias("h_rows"), F.col("hours").alias("h_hours"))
    return summed.unionByName(single).withColumn("key", F.col("key").cast("string"))


def sources_text(rows: DataFrame, out: str, *sums) -> DataFrame:
    """Per ``id``: the sources of its rows, sorted and ' | '-joined, and sums. Rows
    are counted per (id, source) first, so that what is gathered per id is one
    element for each kind of source."""
    per = rows.groupBy("id", "source").agg(F.count(F.lit(1)).cast("int").alias("_n"), *sums)
    names = [c for c in per.columns if c not in ("id", "source", "_n")]
    kinds = F.array_sort(F.collect_list(F.struct("source", "_n")))
    text = F.array_join(F.flatten(F.transform("_k", lambda k: F.array_repeat(k["source"], k["_n"]))), " | ")
    return (per.groupBy("id").agg(kinds.alias("_k"), *(F.sum(c).alias(c) for c in names))
            .select("id", text.alias(out), *names))


def calendar_year_ftes(hours_rows: DataFrame, params: Params) -> DataFrame:
    """Per person: sources (sorted, ' | '-joined), hours and FTE (AGG-7, AGG-4)."""
    return (sources_text(hours_rows, "calendar_year_hours_source", F.sum("hours").alias("_h"))
        .select("id", "calendar_year_hours_source",
                round2(F.col("_h")).alias("calendar_year_hours"),
                round2(F.col("_h") / F.lit(float(params.fte_year_hours))).alias("calendar_year_ftes")))


def workday_hours(employee_hours: DataFrame, params: Params, min_rows: int | None = None) -> DataFrame:
    """One row: ``count`` = 8 x number of dates of the year (up to ``as_of``)
    having more than ``min_rows`` hour rows (VW-k, AGG-10)."""
    threshold = params.min_rows_per_workday if min_rows is None else min_rows
    dates = (employee_hours.filter(in_year("date", params.reporting_year)
                                   & (F.col("date") <= F.lit(params.as_of).cast("date")))
             .groupBy("date").agg(F.count("date").alias("n"))
             .filter(F.col("n") > threshold))
    return dates.agg((F.count(F.lit(1)) * F.lit(params.fte_day_hours)).alias("count"))
