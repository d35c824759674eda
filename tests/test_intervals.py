"""The sweep along an employee's dates against a plain comparison with every position."""

import datetime as dt
import random

import pytest

from staffline.operators import timecards as TC

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
HISTORY = "id long, employee_id long, job_title_id long, start_date date, end_date date"
HOURS = "id long, employee_id long, job_title_id long, date date, work_minutes long, paid_minutes long, regular_minutes long"


def in_force(positions, employee, date):
    open_ = [p for p in positions if p[1] is not None and p[1] == employee and date is not None and p[3] is not None
             and p[3] <= date <= (p[4] or dt.date(2099, 12, 31))]
    return max(open_, key=lambda p: (p[3], p[0])) if open_ else None


def frames(spark, positions, days):
    return (spark.createDataFrame(days, HOURS).repartition(3), spark.createDataFrame(positions, HISTORY).repartition(3))


@pytest.mark.parametrize("seed", range(6))
def test_overlapping_and_nested_positions(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([0, 4, 40, 120])
    positions = [(i, rng.choice([1, 2, 3, -4, None]), rng.choice([10, 20, 30, None]),
                  rng.choice([None] + [D(rng.randint(0, 60))] * 6), rng.choice([None] + [D(rng.randint(0, 90))] * 6))
                 for i in range(n)]
    days = [(k, e, 99, D(d) if d < 100 else None, 1, 2, 3) for k, (e, d) in
            enumerate((e, d) for e in (1, 2, 3, -4, 5, None) for d in (*range(-3, 95), 100))]
    hours, history = frames(spark, positions, days)
    want = {}
    for _, e, _, date, *_ in days:
        p = in_force(positions, e, date)
        if p:
            want[e, date] = (p[0], p[2])
    got = TC.containing_interval(hours, history).collect()
    assert len(got) == len(want) and {(r[0], r[1]): (r[2], r[3]) for r in got} == want
    titled = sorted(TC.retitle_hours(hours, history).collect())
    assert [tuple(r) for r in titled] == [
        (k, e, want.get((e, date), (0, None))[1] or t, date, *m) for k, e, t, date, *m in days]


def test_a_position_in_force_again(spark):
    """After nested positions the outer one comes back, also across two of the same start."""
    positions = [(1, 1, 10, D(0), D(100)), (2, 1, 20, D(10), D(20)), (3, 1, 30, D(12), D(15)), (4, 1, 40, D(12), D(13)),
                 (5, 1, 50, D(21), D(22)), (6, 1, 60, D(50), D(40))]
    rows = sorted((r["__from"], r["__hid"]) for r in TC.position_spans(frames(spark, positions, [])[1]).collect())
    assert rows == [(D(0), 1), (D(10), 2), (D(12), 4), (D(14), 3), (D(16), 2), (D(21), 5), (D(23), 1)]


def test_repeated_hours_and_empty_tables(spark):
    positions = [(1, 1, 10, D(0), None)]
    days = [(1, 1, 99, D(3), 1, 1, 1), (2, 1, 99, D(3), 2, 2, 2)]
    hours, history = frames(spark, positions, days)
    assert [tuple(r) for r in TC.containing_interval(hours, history).collect()] == [(1, D(3), 1, 10)]
    assert sorted((r.id, r.job_title_id) for r in TC.retitle_hours(hours, history).collect()) == [(1, 10), (2, 10)]
    none, empty = frames(spark, [], [])
    assert TC.containing_interval(hours, empty).count() == 0 and TC.containing_interval(none, history).count() == 0
    assert TC.retitle_hours(hours, empty).count() == 2 and TC.retitle_hours(none, history).count() == 0


def test_many_positions_of_one_employee(spark):
    """A third of all positions on one employee: the stack holds one position for each end date at most."""
    positions = [(i, 1 if i % 3 else i, i % 7, D(i % 365), D(i % 365 + i % 11)) for i in range(30_000)]
    days = [(d, 1, 99, D(d), 1, 1, 1) for d in range(400)]
    hours, history = frames(spark, positions, days)
    got = {r.date: r.history_id for r in TC.containing_interval(hours, history).collect()}
    assert got == {D(d): p[0] for d in range(400) if (p := in_force(positions, 1, D(d)))}


def test_no_row_is_copied(spark):
    """Two shuffles, one for the positions and one for both sides, and nothing exploded or joined."""
    hours, history = frames(spark, [(1, 1, 10, D(0), None)], [(1, 1, 99, D(3), 1, 1, 1)])
    plan = TC.retitle_hours(hours.coalesce(1), history.coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert "Generate" not in plan and "Join" not in plan
