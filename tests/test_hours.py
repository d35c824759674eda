"""Hand-computed calendar-year hours and FTE (VW-a..d, VW-k)."""

import datetime as dt

from staffline.operators import hours as H
from staffline.params import Params

D = dt.date
P = Params(reporting_year=2024, as_of=dt.datetime(2024, 12, 31))


def test_learner_proration(spark):
    rows = spark.createDataFrame([
        (1, D(2023, 12, 22), D(2024, 1, 10), 20.0),   # 10 of 20 days in 2024 -> 10.00
        (2, D(2024, 3, 1), D(2024, 3, 31), 7.5),      # fully inside -> 7.50
        (3, D(2024, 12, 1), D(2025, 1, 30), 3.0),     # 31 of 61 days -> 1.52
        (4, D(2022, 1, 1), D(2023, 12, 31), 9.0),     # no overlap -> dropped
        (5, D(2024, 5, 1), D(2024, 5, 2), 0.0),       # no hours -> dropped
    ], "learner_id int, start_date date, end_date date, hours double")
    got = {r.learner_id: r.year_hours for r in H.prorated_rows(rows, 2024).collect()}
    assert got == {1: 10.0, 2: 7.5, 3: 1.52}


def test_people_hours_and_fte(spark):
    wm = spark.createDataFrame([(1, 10, None, None, None), (2, None, 24, None, None), (3, None, None, 7, 7)],
                               "id int, employee_id int, contractor_id int, learner_id int, volunteer_id int")
    emp = spark.createDataFrame([(10, 5)], "id int, job_title_id int")
    titles = spark.createDataFrame([(5,)], "id int")
    eh = spark.createDataFrame([(10, D(2024, 1, 2), 600), (10, D(2024, 1, 3), 480), (10, D(2023, 12, 29), 999)],
                               "employee_id int, date date, paid_minutes int")
    cjh = spark.createDataFrame([(24, D(2024, 2, 1), D(2024, 2, 2), 10.0), (24, D(2023, 2, 1), D(2023, 2, 2), 99.0)],
                                "contractor_id int, start_date date, end_date date, hours double")
    ljh = spark.createDataFrame([(7, D(2024, 1, 1), D(2024, 1, 31), 4.0)],
                                "learner_id int, start_date date, end_date date, hours double")
    vjh = spark.createDataFrame([(7, D(2024, 6, 1), D(2024, 7, 1), 2.0)],
                                "volunteer_id int, start_date date, end_date date, hours double")
    rows = H.workforce_hours(wm, emp, eh, titles, cjh, ljh, vjh, P)
    out = {r.id: r for r in H.calendar_year_ftes(rows, P).collect()}
    assert out[1].calendar_year_hours == 18.0 and out[1].calendar_year_ftes == 0.01   # 1080 min / 60
    assert out[2].calendar_year_hours == 2.0                                           # pooled id 24: / 5
    assert out[3].calendar_year_hours_source == "Learner | Volunteer"
    assert out[3].calendar_year_hours == 6.0


def test_workday_count(spark):
    eh = spark.createDataFrame([(i, D(2024, 1, 1 + i % 3)) for i in range(9)] + [(99, D(2025, 1, 1))],
                               "employee_id int, date date")
    # three dates with 3 rows each; threshold 2 -> 3 dates x 8 h
    assert H.workday_hours(eh, P, min_rows=2).first()["count"] == 24
    assert H.workday_hours(eh, P, min_rows=3).first()["count"] == 0
