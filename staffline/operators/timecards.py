"""Timecards -> daily minutes -> employee_hours.

Pay-code classification is a projection (``isin`` over fixed code lists), so
no dimension join is needed; minutes are summed with partial aggregation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffline.functions import changed_null_safe, changed_null_unsafe, iso_duration_minutes
from staffline.operators.ordering import first_by
from staffline.operators.reconcile import assign_ids, count_changed, join_update, snapshot_diff, sref
from staffline.params import (OPEN_END_DATE, PAID_EXTRA_CODES, REGULAR_CODES, UNPAID_CODES,
                              WORK_EXTRA_CODES)
from staffline.schemas import conform
from staffline.session import cut_lineage
from staffline.sources.documents import unparsed

WORK_CODES = REGULAR_CODES + WORK_EXTRA_CODES
PAID_CODES = WORK_CODES + PAID_EXTRA_CODES
KNOWN_CODES = PAID_CODES + UNPAID_CODES


def eligible_employees(employees: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Employees not terminated, or terminated within a month before ``as_of``."""
    cutoff = F.lit(as_of).cast("timestamp") - F.expr("INTERVAL 1 MONTH")
    keep = (F.col("status") != "Terminated") | (F.col("termination_date").cast("timestamp") >= cutoff)
    return employees.filter(keep).select("id", "aoid", "job_title_id")


def flatten_timecards(docs: DataFrame) -> DataFrame:
    """``timeCards[] x dailyTotals[]`` rows that have an entry date; a document
    that does not parse, or an unreadable date, aborts the run."""
    # Inside the exploded expression: a filter before it would come after the NULL check that Spark infers.
    checked = F.when(unparsed(docs, "timeCards"), F.raise_error(F.lit("timecard document does not parse"))) \
        .otherwise(F.col("timeCards"))
    cards = docs.select(F.explode(checked).alias("tc"))
    days = cards.select(F.col("tc.associateOID").alias("associate_oid"),
                        F.col("tc.timePeriod.startDate").cast("date").alias("period_start"),
                        F.explode("tc.dailyTotals").alias("d"))
    return (days.filter(F.col("d.entryDate").isNotNull())
            .select("associate_oid", "period_start",
                    F.col("d.entryDate").cast("date").alias("entry_date"),
                    F.col("d.payCode.codeValue").alias("pay_code"),
                    F.col("d.payCode.shortName").alias("pay_code_name"),
                    F.col("d.timeDuration").alias("time_duration")))


def classify_minutes(rows: DataFrame) -> DataFrame:
    """Adds ``minutes`` and the regular / work / paid minute columns plus an
    ``unmapped`` flag for codes in no list (paid 0, the run goes on)."""
    code = F.col("pay_code")
    m = F.col("minutes")  # parsed once, referenced by the three classes
    return (rows.withColumn("minutes", iso_duration_minutes("time_duration"))
            .select("*",
                    F.when(code.isin(*REGULAR_CODES), m).otherwise(0).alias("regular_minutes"),
                    F.when(code.isin(*WORK_CODES), m).otherwise(0).alias("work_minutes"),
                    F.when(code.isin(*PAID_CODES), m).otherwise(0).alias("paid_minutes"),
                    (~F.coalesce(code.isin(*KNOWN_CODES), F.lit(False))).alias("unmapped")))


def lookup_employees(rows: DataFrame, eligible: DataFrame) -> DataFrame:
    """Attach employee id and job title by aoid (one eligible row per aoid:
    the smallest id)."""
    one = first_by(eligible.filter(F.col("aoid").isNotNull()), ["aoid"], [("id", "asc")])
    return rows.join(one.select(F.col("aoid").alias("associate_oid"), F.col("id").alias("employee_id"),
                                "job_title_id"), "associate_oid")


def daily_minutes(rows: DataFrame) -> DataFrame:
    """Minutes per (employee, title, period, date); rows with a NULL key drop out."""
    keys = ["employee_id", "job_title_id", "period_start", "entry_date"]
    return (rows.filter(F.col("employee_id").isNotNull() & F.col("job_title_id").isNotNull()
                        & F.col("period_start").isNotNull() & F.col("entry_date").isNotNull())
            .groupBy(*keys)
            .agg(F.sum("work_minutes").alias("work_minutes"), F.sum("paid_minutes").alias("paid_minutes"),
                 F.sum("regular_minutes").alias("regular_minutes"))
            .withColumnRenamed("entry_date", "date"))


def daily_minutes_prereduced(classified: DataFrame, eligible: DataFrame) -> DataFrame:
    """``daily_minutes(lookup_employees(classified, eligible))`` with the minutes
    summed per (aoid, period, date) before the lookup join, so the join and its
    shuffle see one row per person-day instead of one per pay-code entry; the
    second sum merges aoids that share an employee id, as the per-row form does."""
    keys = ["associate_oid", "period_start", "entry_date"]
    pre = (classified.filter(F.col("associate_oid").isNotNull() & F.col("period_start").isNotNull()
                             & F.col("entry_date").isNotNull())
           .groupBy(*keys)
           .agg(F.sum("work_minutes").alias("work_minutes"), F.sum("paid_minutes").alias("paid_minutes"),
                F.sum("regular_minutes").alias("regular_minutes")))
    return daily_minutes(lookup_employees(pre, eligible))


def unmapped_paycodes(rows: DataFrame) -> DataFrame:
    """Pay codes in no list, with how many rows carry them."""
    return (rows.filter(F.col("unmapped")).groupBy("pay_code")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("minutes").alias("minutes")))


def paycode_warning(rows: DataFrame, listed: int = 100) -> DataFrame:
    """One row: the run log's warning about unmapped pay codes (NULL if there
    are none). It names the first ``listed`` codes and counts the others, so that
    the row stays small whatever the data hold."""
    codes = unmapped_paycodes(rows).select("pay_code")
    first = (codes.orderBy("pay_code").limit(listed)
             .agg(F.array_join(F.array_sort(F.collect_list("pay_code")), ", ").alias("codes")))
    more = codes.agg((F.count(F.lit(1)) - listed).alias("more"))
    text = F.concat(F.lit("Unmapped paycodes: "), F.col("codes"),
                    F.when(F.col("more") > 0, F.concat(F.lit(" and "), F.col("more").cast("string"), F.lit(" more")))
                    .otherwise(F.lit("")))
    return first.crossJoin(more).select(F.when(F.col("codes") != "", text).alias("warnings"))  # one row each


def run_counts(daily: DataFrame, hours: DataFrame) -> DataFrame:
    """One row, by one join of the run's days to the stored hours: query_count,
    inserted (days not stored yet), changed_reference and changed (see ``count_changed``)."""
    cols = ["work_minutes", "paid_minutes", "regular_minutes"]
    stored = hours.select(F.col("employee_id").alias("__e"), F.col("date").alias("__d"),
                          *(F.col(c).alias(f"__s_{c}") for c in cols))
    j = daily.join(stored, (F.col("employee_id") == F.col("__e")) & (F.col("date") == F.col("__d")), "left")
    pairs, hit = [(F.col(c), F.col(f"__s_{c}")) for c in cols], F.col("__e").isNotNull()
    return j.agg(F.count(F.lit(1)).alias("query_count"), F.count_if(~hit).alias("inserted"),
                 F.count_if(hit & F.coalesce(changed_null_unsafe(pairs), F.lit(False))).alias("changed_reference"),
                 F.count_if(hit & changed_null_safe(pairs)).alias("changed"))


def new_timecard_dates(timecards: DataFrame, timecard_dates: DataFrame) -> DataFrame:
    """Distinct (period_start, date) pairs not stored yet."""
    return snapshot_diff(timecards.select("period_start", "date"), timecard_dates, ["period_start", "date"])


def per_day(timecards: DataFrame) -> DataFrame:
    """One row per (employee, date): minutes summed over periods and titles;
    the title of the latest period (then the smallest title id) is kept."""
    sums = timecards.groupBy("employee_id", "date").agg(
        F.sum("work_minutes").alias("work_minutes"),
        F.sum("paid_minutes").alias("paid_minutes"),
        F.sum("regular_minutes").alias("regular_minutes"),
        F.min_by("job_title_id", F.struct(-F.unix_date("period_start"), F.col("job_title_id"))).alias("job_title_id"))
    return sums


def hours_change_count(timecards: DataFrame, hours: DataFrame) -> DataFrame:
    return count_changed(hours, timecards, ["employee_id", "date"],
                         ["work_minutes", "paid_minutes", "regular_minutes"])


def update_hours(hours: DataFrame, timecards: DataFrame) -> DataFrame:
    return _updated(conform(hours, "employee_hours"), per_day(timecards))


def _updated(h: DataFrame, day: DataFrame) -> DataFrame:
    return join_update(h, day, ["employee_id", "date"],
                       {c: sref(c) for c in ("work_minutes", "paid_minutes", "regular_minutes")})


#: (employee, date) ranges of ``position_spans``, in order; at most one row per employee and first day.
_SPANS = "employee_id long, __from date, __to date, __hid long, __tid long"


def position_spans(history: DataFrame) -> DataFrame:
    """Who holds which title from which day on: (employee_id, __from, __to, __hid, __tid), one row for every
    day on which the position in force changes. ``__to`` is the end of the position itself; the next row
    of the employee takes over before that if it begins earlier.

    Positions may overlap and nest: on a day the one with the latest start is in force, then the larger
    id; when it ends, the latest of those still open is in force again. Which one that is depends on
    all positions before, so the rows, sorted by employee and start, go through one pass
    with a stack of the open positions. A position that a later one outlasts leaves the stack, so it holds at most
    one position for each end date, whatever the number of rows; nothing is grouped in memory.
    Positions without an employee or a start, or that end before they start, are in force on no day.
    """
    h = conform(history, "employee_job_history").select(
        F.col("employee_id").cast("long").alias("e"), F.unix_date("start_date").cast("long").alias("s"),
        F.unix_date(F.coalesce("end_date", F.lit(dt.date.fromisoformat(OPEN_END_DATE)))).cast("long").alias("t"),
        F.col("id").cast("long").alias("h"), F.col("job_title_id").cast("long").alias("j"))
    h = h.where(F.col("e").isNotNull() & F.col("s").isNotNull() & (F.col("s") <= F.col("t")))

    def sweep(batches):
        import pyarrow as pa
        days, ids = pa.date32(), pa.int64()
        employee, stack, begun, out = None, [], None, []  # begun: the row of the latest start, replaced by another of that day

        def close(before):
            """Positions that end before a day leave; the next open one is in force from the day after."""
            while stack and stack[-1][0] < before:
                last = stack.pop()[0]
                if stack and last + 1 < before:
                    out.append((employee, last + 1, *stack[-1]))

        def table():
            cols = list(zip(*out)) or [()] * 5
            types = (ids, days, days, ids, ids)
            arrays = [pa.array(c, ids if t is ids else pa.int32()).cast(t) for c, t in zip(cols, types)]
            return pa.RecordBatch.from_arrays(arrays, names=["employee_id", "__from", "__to", "__hid", "__tid"])

        for batch in batches:
            for e, s, t, h, j in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and (e, s) != begun[:2]:
                    out.append(begun)
                    begun = None
                if e != employee:
                    close(float("inf"))
                    employee = e
                close(s)
                while stack and stack[-1][0] <= t:
                    stack.pop()
                stack.append((t, h, j))
                begun = (e, s, t, h, j)
            yield table()
            out.clear()
        if begun:
            out.append(begun)
        close(float("inf"))
        yield table()

    # Ids without a value come first in the order, as in a descending order they come last.
    return h.repartition("e").sortWithinPartitions("e", "s", "h").mapInArrow(sweep, _SPANS)


def _in_force(rows: DataFrame, history: DataFrame) -> DataFrame:
    """``rows`` (employee_id, date, ...) with ``__hid`` and ``__tid`` of the position in force on the date, NULL without one.

    One shuffle on the employee for rows and spans together, then the latest span is carried along the
    dates. No row is copied or compared with several positions. A group is an employee's days: (employee_id,
    date) is the key of the stored hours, and the window streams."""
    kept = rows.select("*", F.lit(1).alias("__kind"),
                       # rows without an employee match nothing and need not meet in one task
                       F.when(F.col("employee_id").isNull(), F.monotonically_increasing_id()).alias("__alone"))
    spans = position_spans(history)
    events = spans.select(F.col("employee_id").cast(rows.schema["employee_id"].dataType).alias("employee_id"),
                          F.col("__from").alias("date"), F.lit(0).alias("__kind"), F.lit(None).cast("long").alias("__alone"),
                          F.struct("__to", "__hid", "__tid").alias("__span"))
    along = Window.partitionBy("employee_id", "__alone").orderBy("date", "__kind")
    carried = (kept.unionByName(events, allowMissingColumns=True)
               .withColumn("__now", F.last("__span", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
               .where(F.col("__kind") == 1))
    holds = F.col("__now.__to") >= F.col("date")
    return carried.select(*rows.columns, F.when(holds, F.col("__now.__hid")).alias("__hid"),
                          F.when(holds, F.col("__now.__tid")).alias("__tid"), F.coalesce(holds, F.lit(False)).alias("__held"))


def containing_interval(hours: DataFrame, history: DataFrame) -> DataFrame:
    """(employee_id, date, history_id, history_job_title_id): for each employee and date of the hours,
    the history interval containing the date (latest start wins, then the larger history id); dates inside no
    interval are absent. A sweep along the dates of each employee (see ``_in_force``)."""
    held = _in_force(hours.select("employee_id", "date"), history).where("__held")
    return (held.select("employee_id", "date", F.col("__hid").alias("history_id"), F.col("__tid").alias("history_job_title_id"))
            .dropDuplicates(["employee_id", "date"]))


def retitle_hours(hours: DataFrame, history: DataFrame) -> DataFrame:
    """Hours rows take the title of the history interval containing their date
    when it differs (see ``containing_interval``); all rows are kept."""
    h = conform(hours, "employee_hours")
    t = F.col("__tid")
    out = _in_force(h, history).withColumn(
        "job_title_id", F.when(t.isNotNull() & (t != F.col("job_title_id")), t).otherwise(F.col("job_title_id")))
    return out.select(*h.columns)


def month_of(date: str):
    return F.date_format(date, "yyyy-MM").alias("month")


def months_of_changed_positions(before: DataFrame, after: DataFrame, first: str, last: str) -> DataFrame:
    """The months (``yyyy-MM``) from ``first`` to ``last`` in which a position lies that is in one of two
    states of the job history only: no other month's hours can take another title."""
    cols = ["id", "employee_id", "job_title_id", "start_date", "end_date"]
    old, new = (conform(h, "employee_job_history").select(*cols) for h in (before, after))
    changed = old.exceptAll(new).unionByName(new.exceptAll(old))
    low, high = F.lit(f"{first}-01").cast("date"), F.lit(f"{last}-01").cast("date")
    span = changed.select(F.greatest(F.trunc("start_date", "month"), low).alias("a"),
                          F.least(F.trunc(F.coalesce("end_date", high), "month"), high).alias("b")).distinct()
    return (span.where(F.col("a") <= F.col("b")).select(F.explode(F.expr("sequence(a, b, INTERVAL 1 MONTH)")).alias("m"))
            .select(month_of("m")).distinct())


def insert_hours(hours: DataFrame, timecards: DataFrame) -> DataFrame:
    """Days not stored yet; ids continue after the largest id."""
    h = conform(hours, "employee_hours")
    return h.unionByName(_new_days(h, per_day(timecards)))


def _new_days(h: DataFrame, day: DataFrame, last_id: int | None = None) -> DataFrame:
    new = day.join(h.select("employee_id", "date"), ["employee_id", "date"], "left_anti")
    if last_id is None:
        base = h.agg(F.coalesce(F.max("id"), F.lit(0)).alias("__base"))
        new, start = new.crossJoin(F.broadcast(base)), F.col("__base")
    else:
        start = F.lit(last_id)
    new = assign_ids(new, ["employee_id", "date"], start_after=start)
    return conform(new, "employee_hours").select(*h.columns)


def upsert_hours(hours: DataFrame, timecards: DataFrame, history: DataFrame, last_id: int | None = None) -> DataFrame:
    """The hours transaction: update, re-title by history, insert. ``hours`` may be the months only
    that the pull can change; ``last_id`` is then the greatest id of all hours.

    The sums per day feed two statements; they are written once to the
    checkpoint folder (as the reference stages them in a table), so the pull is
    not recomputed and a lost executor restarts from the staged rows. The update
    changes neither keys nor ids: the days that are new come from the stored hours, not
    from the updated ones.
    """
    day = cut_lineage(per_day(timecards))
    h = conform(hours, "employee_hours")
    return retitle_hours(_updated(h, day), history).unionByName(_new_days(h, day, last_id))


__all__ = ["eligible_employees", "flatten_timecards", "classify_minutes", "lookup_employees",
           "daily_minutes", "daily_minutes_prereduced", "unmapped_paycodes", "new_timecard_dates", "per_day", "hours_change_count",
           "update_hours", "position_spans", "containing_interval", "retitle_hours", "insert_hours", "upsert_hours"]
