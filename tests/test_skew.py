"""A third of all rows on one key must not become all pairs or one huge group."""

import time

from pyspark.sql import functions as F

from staffline.operators import dedupe as D
from staffline.operators import linkage as LK

N = 60000


def _accounts(spark):
    k = F.col("id")
    return spark.range(1, N + 1).select(
        k.cast("int").alias("id"), F.concat(F.lit("g-"), k.cast("string")).alias("guid"),
        F.concat(F.lit("g-"), k.cast("string")).alias("primary_guid"),
        F.when(k % 3 == 0, F.lit("shared@x.org")).otherwise(F.concat(F.lit("u"), k.cast("string"), F.lit("@x.org"))).alias("email"),
        F.concat(F.lit("n"), k.cast("string"), F.lit("@x.org")).alias("network_email"),
        F.lit("2020-01-01 00:00:00").cast("timestamp").alias("created_at"),
        F.lit(False).alias("is_disabled"), F.lit(False).alias("is_deleted"),
        F.lit(True).alias("is_primary_acct"), F.lit(False).alias("is_non_user"))


def test_hot_email_link_is_linear(spark):
    users = _accounts(spark)
    emps = spark.range(1, N + 1).select(F.col("id").cast("int").alias("id"),
                                        F.when(F.col("id") % 3 == 0, F.lit("SHARED@x.org "))
                                        .otherwise(F.lit(None)).alias("work_email"))
    wm = spark.createDataFrame([], "id int, network_id int, employee_id int")
    t0 = time.time()
    links = LK.link_employees(users, emps, wm)
    n = links.count()
    assert n == 2 * (N // 3) - 1  # every employee and every account once, not N/3 x N/3 pairs
    assert links.select("employee_id").distinct().count() == links.select("network_id").distinct().count() == N // 3
    # Plan never joins the hot key's rows pairwise: the account side is reduced per key first.
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert time.time() - t0 < 120


def test_hot_email_dedupe(spark):
    out = D.resolve_duplicates(_accounts(spark), "email")
    primaries = out.filter("email = 'shared@x.org' AND is_primary_acct").count()
    demoted = out.filter("email = 'shared@x.org' AND NOT is_primary_acct").count()
    assert (primaries, demoted) == (1, N // 3 - 1)
    # every account of the key now points at the winner (whose primary_guid is its own guid)
    assert out.filter("email = 'shared@x.org'").select("primary_guid").distinct().count() == 1
