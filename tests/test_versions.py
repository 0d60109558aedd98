from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import Window as W, functions as F

from tidemark.operators import retention as R
from tidemark.operators import unions as U
from tidemark.operators import versions as V

NOW = datetime(2026, 3, 31, 3, 0, tzinfo=timezone.utc)


def events(spark):
    days = ["2026-01-30 10:00:00", "2026-01-30 11:00:00", "2026-02-01 00:00:00", "2026-02-01 23:59:59.999999", "2026-03-15 12:00:00"]
    return spark.createDataFrame(list(enumerate(days)), "id long, t string").select("id", F.col("t").cast("timestamp_ntz").alias("ts"))


def test_latest_batch_at_or_before(spark):
    def ids(at):
        return sorted(r.id for r in V.latest_batch(events(spark), "ts", at).collect())

    assert ids(date(2026, 2, 1)) == [2, 3]
    assert ids(date(2026, 3, 14)) == [2, 3]
    assert ids(datetime(2026, 3, 15, 0, 0)) == [4]
    assert ids(date(2026, 1, 29)) == []


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_latest_batch_of_instants_takes_utc_days(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    times = ["2026-02-01T00:00:00Z", "2026-02-01T23:59:59Z", "2026-02-02T00:00:00Z"]
    df = spark.createDataFrame(list(enumerate(times)), "id long, t string").select("id", F.col("t").cast("timestamp").alias("ts"))
    assert sorted(r.id for r in V.latest_batch(df, "ts", date(2026, 2, 1)).collect()) == [0, 1]
    assert sorted(r.id for r in V.as_of_nth_batch(df, "ts", 2).collect()) == [0, 1]
    got = V.version_list(df, F.col("ts")).orderBy("batch")
    assert [(r.added, r.total) for r in got.collect()] == [(1, 1), (1, 2), (1, 3)]


def test_as_of_nth_batch(spark):
    def ids(n):
        return sorted(r.id for r in V.as_of_nth_batch(events(spark), "ts", n).collect())

    assert (ids(1), ids(2), ids(3), ids(9)) == ([0, 1, 2, 3, 4], [0, 1, 2, 3], [0, 1], [0, 1])


@pytest.mark.parametrize("period", ["month", "year", "week"])
def test_version_list_chains_over_periods(spark, period):
    got = V.version_list(events(spark), F.col("ts").cast("date"), period=period).orderBy("batch")
    assert [tuple(r) for r in got.collect()] == [
        (date(2026, 1, 30), None, 2, 2), (date(2026, 2, 1), date(2026, 1, 30), 2, 4),
        (date(2026, 3, 15), date(2026, 2, 1), 1, 5),
    ]


def test_version_list_keeps_rows_without_a_time(spark):
    df = events(spark).unionByName(events(spark).limit(1).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    got = {r.batch: (r.parent, r.added, r.total) for r in V.version_list(df, F.col("ts").cast("date")).collect()}
    assert got[None] == (date(2026, 3, 15), 1, 6)


def test_version_list_equals_one_plain_window(spark):
    df = spark.range(5000).select(
        (F.abs(F.hash("id")) % 3).alias("name"), F.date_add(F.lit(date(2025, 1, 1)), (F.abs(F.hash(F.col("id") + 7)) % 500)).alias("d")
    )
    counts = df.groupBy("name", F.col("d").alias("batch")).agg(F.count(F.lit(1)).alias("added"))
    w = W.partitionBy("name").orderBy("batch")
    want = counts.select("name", "batch", F.lag("batch").over(w).alias("parent"), "added", F.sum("added").over(w).alias("total"))
    got = V.version_list(df, F.col("d"), by=["name"])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_union_missing(spark):
    a = spark.createDataFrame([(1, "x")], "b int, a string")
    b = spark.createDataFrame([(2.0, 7)], "c double, b int")
    assert U.union_missing([a, b]).columns == ["b", "a", "c"]
    merged = U.union_missing([a, b], sort_columns=True)
    assert merged.columns == ["a", "b", "c"]
    assert {r.b: (r.a, r.c) for r in merged.collect()} == {1: ("x", None), 7: (None, 2.0)}


POLICY = [R.Retention("live", 30, 5), R.Retention("gold", 7, 2), R.Retention("parks", 7, 1), R.Retention("gone", 7, 1)]


def versions(spark):
    """``(table, age in days, snapshot)``; ids repeat over tables."""
    ages = (
        [("live", d, 100 - d) for d in (0, 1, 29, 30, 31, 32, 60)]      # 31 and older are due, but five are kept
        + [("gold", d, 100 - d) for d in (20, 21, 22)]                    # all old: the newest two stay
        + [("parks", 0, 1), ("parks", 0, 2), ("parks", 8, 3)]
        + [("other", 400, 1)]                                             # no policy
    )
    data = [(t, s, (NOW - timedelta(days=d)).replace(tzinfo=None)) for t, d, s in ages]
    return spark.createDataFrame(data, "table string, snapshot_id long, committed_at timestamp")


def test_expire_plan(spark):
    got = sorted((r.table, r.snapshot_id) for r in R.expire_plan(versions(spark), POLICY, NOW).collect())
    assert got == [("gold", 78), ("live", 40), ("live", 68), ("parks", 3)]


def test_exactly_at_the_cutoff_is_kept(spark):
    policy = [R.Retention("live", 30, 1)]
    got = sorted(r.snapshot_id for r in R.expire_plan(versions(spark), policy, NOW).collect())
    assert got == [40, 68, 69]


def test_expire_report_and_skipped_tables(spark):
    got = {r.table: tuple(r)[1:] for r in R.expire_report(versions(spark), POLICY, NOW).collect()}
    assert got == {
        "live": (7, 5, 2, "ok"), "gold": (3, 2, 1, "ok"), "parks": (3, 2, 1, "ok"), "gone": (None, None, None, "skipped"),
    }


def test_versions_with_one_time_are_ranked_by_id(spark):
    same = NOW - timedelta(days=90)
    df = spark.createDataFrame([("live", i, same.replace(tzinfo=None)) for i in range(8)], versions(spark).schema)
    got = sorted(r.snapshot_id for r in R.expire_plan(df, [R.Retention("live", 30, 5)], NOW).collect())
    assert got == [0, 1, 2]


def test_expire_plan_equals_ranking(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "live").otherwise(F.concat(F.lit("t"), F.abs(F.hash("id")) % 20)).alias("table"),
        F.col("id").alias("snapshot_id"),
        (F.lit(NOW) - F.make_dt_interval(F.abs(F.hash(F.col("id") + 3)) % 90)).alias("committed_at"),
    )
    policy = [R.Retention("live", 30, 50)] + [R.Retention(f"t{i}", i, i) for i in range(1, 20)]
    rules = spark.createDataFrame([tuple(p) for p in policy], "table string, retain_days int, min_snapshots int")
    w = W.partitionBy("table").orderBy(F.desc("committed_at"), F.desc("snapshot_id"))
    want = (
        df.withColumn("rn", F.row_number().over(w)).join(rules, "table")
        .where(F.col("committed_at") < F.lit(NOW) - F.make_dt_interval(F.col("retain_days")))
        .where("rn > min_snapshots").select("table", "snapshot_id", "committed_at")
    )
    got = R.expire_plan(df, policy, NOW)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    report = R.expire_report(df, policy, NOW)
    assert report.agg(F.sum("expired")).first()[0] == want.count()


def test_nothing_kept_by_number(spark):
    policy = [R.Retention("gold", 7, 0), R.Retention("live", 30, 0)]
    got = sorted((r.table, r.snapshot_id) for r in R.expire_plan(versions(spark), policy, NOW).collect())
    assert got == [("gold", 78), ("gold", 79), ("gold", 80), ("live", 40), ("live", 68), ("live", 69)]
    report = {r.table: tuple(r)[1:] for r in R.expire_report(versions(spark), policy, NOW).collect()}
    assert report == {"gold": (3, 0, 3, "ok"), "live": (7, 4, 3, "ok")}


def test_versions_without_a_time_are_last_and_never_due(spark):
    df = versions(spark).unionByName(versions(spark).where("table = 'gold'").withColumn("committed_at", F.lit(None).cast("timestamp")))
    got = sorted(r.snapshot_id for r in R.expire_plan(df.where("table = 'gold'"), POLICY, NOW).collect())
    assert got == [78]


def test_many_versions_on_the_day_that_decides(spark):
    df = spark.range(500).select(
        F.lit("live").alias("table"), F.col("id").alias("snapshot_id"),
        (F.lit(NOW) - F.make_dt_interval(F.when(F.col("id") < 3, 10).otherwise(60)) + F.make_dt_interval(mins=(F.col("id") % 7).cast("int"))).alias("committed_at"),
    )
    kept = 3 + 7
    got = {r.snapshot_id for r in R.expire_plan(df, [R.Retention("live", 30, kept)], NOW).collect()}
    ranked = [r.snapshot_id for r in df.orderBy(F.desc("committed_at"), F.desc("snapshot_id")).collect()]
    assert got == set(ranked[kept:])


def test_versions_are_read_twice(spark, helpers, tmp_path):
    versions(spark).write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    for plan in (R.expire_plan(stored, POLICY, NOW), R.expire_report(stored, POLICY, NOW)):
        assert helpers.plan(plan).count("FileScan parquet") == 2


def test_batch_retention(spark):
    data = [("live", "2026-03-31"), ("live", "2026-03-01"), ("live", "2026-02-28"), ("live", "2026-02-28"),
            ("entities", "2026-03-24"), ("entities", "2026-03-23"), ("unknown", "2026-03-01")]
    df = spark.createDataFrame(data, "prefix string, d string").select("prefix", F.col("d").cast("date").alias("batch"))
    plan = R.batch_retention(df, "prefix", "batch", R.BRONZE_DAYS, 365)
    due = sorted((r.prefix, str(r.batch), r.files) for r in plan.where("expired").collect())
    assert due == [("entities", "2026-03-23", 1), ("live", "2026-02-28", 2)]
    report = {r.prefix: (r.files, r.expired) for r in R.batch_retention_report(plan).collect()}
    assert report == {"live": (4, 2), "entities": (2, 1), "unknown": (1, 0)}
    fixed = R.batch_retention(df, "prefix", "batch", R.BRONZE_DAYS, 365, F.lit(date(2026, 3, 1)))
    assert fixed.where("expired").isEmpty()


def test_the_policy_is_the_documented_one():
    assert {p.table: (p.retain_days, p.min_snapshots) for p in R.TABLE_POLICY} == {
        "silver.live_data": (30, 5), "gold.live_data_current": (7, 2), "silver.destinations": (7, 1),
        "silver.parks": (7, 1), "silver.entities": (7, 1),
    }
