"""The physical plans that the design counts on."""

import re
from datetime import timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import moment
from tidemark.plans import catalogue
from tidemark.plans.catalogue import QUERIES
from tidemark.sources import tables


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["latest_per_entity", "latest_line_per_part", "filter_then_latest", "last_known_nonnull"])
def test_one_row_per_key_and_task_is_shuffled(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "partial_max" in text.split("Exchange hashpartitioning", 1)[1]
    assert text.count("Exchange hashpartitioning") == 1


def test_members_are_joined_once_after_reducing(spark, sf_dir, settings):
    text = plan(spark, sf_dir, "filter_then_latest")
    assert text.count("LeftSemi") == 1 and "LeftSemi" not in text.split("partial_max")[-1]
    # Without broadcasts a filter built from the members' keys still reaches the scan of a large input.
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
    )
    assert "might_contain" in plan(spark, sf_dir, "filter_then_latest").split("partial_max", 1)[1]


def test_filter_reaches_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "filter_then_latest")
    assert "EqualTo(event_type,click)" in text
    assert "LessThanOrEqual(ts" in plan(spark, sf_dir, "latest_as_of")


def test_batch_limits_reach_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "latest_batch")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,", text)


def test_columns_are_pruned(spark, sf_dir):
    assert "l_extendedprice" not in plan(spark, sf_dir, "latest_line_per_part")
    assert "ReadSchema: struct<event_type:string>" in plan(spark, sf_dir, "status_counts")


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, sf_dir, settings):
    assert plan(spark, sf_dir, "star_board").count("BroadcastHashJoin") == 3
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    assert "BroadcastHashJoin" not in plan(spark, sf_dir, "star_board")
    assert "SortMergeJoin" in plan(spark, sf_dir, "star_board")


def test_retention_ranks_only_the_newest(spark, sf_dir):
    for name in ("expire_plan", "expire_report"):
        text = plan(spark, sf_dir, name)
        assert "row_number(), 5, Partial" in text
        assert "LocalTableScan" in text


def test_counts_are_partial(spark, sf_dir):
    for name in ("status_counts", "operating_ratio", "fetch_errors", "batch_summary", "dedup_counts", "snapshots"):
        assert "partial_count" in plan(spark, sf_dir, name)


def test_top_n_does_not_sort_everything(spark, sf_dir):
    text = plan(spark, sf_dir, "top_n")
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


@pytest.mark.parametrize("name", ["normalize_live", "land_flatten", "queue_flatten", "explode_parks", "payload_rows", "parse_ts", "quarantine", "good_rides"])
def test_row_functions_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan(spark, sf_dir, name)


def test_payloads_are_parsed_once(spark, sf_dir):
    for name in ("good_rides", "land_flatten", "queue_flatten"):
        assert plan(spark, sf_dir, name).count("from_json(") == 1


STORED = {"bronze_roundtrip", "live_files", "csv_roundtrip", "partitioned_parquet", "table_append", "table_overwrite", "table_history", "silver_stream", "gold_stream",
    "landing_report", "table_as_of", "stored_board", "stream_progress", "board_positions",
    "table_widened", "clustered_as_of", "colocated_board",
}


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - STORED))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_tables_in_equal_buckets_meet_without_a_shuffle(spark, sf_dir, helpers, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = helpers.plan(catalogue.colocated_board(spark, sf_dir))
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2


def rows_read(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_read_of_a_clustered_table_skips_what_is_later(spark, sf_dir, tmp_path, settings):
    settings(spark__sql__shuffle__partitions="8", spark__sql__adaptive__coalescePartitions__enabled="false")
    # Of times only those with a zone, as silver has them, are compared with Parquet's statistics by Spark.
    events = catalogue.read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).repartition(8)
    space, first = f"c_{tmp_path.name.replace('-', '_')}", events.agg(F.min("ts")).first()[0]
    tables.write_table(events, f"{space}.mixed", root=str(tmp_path))
    tables.write_table(events, f"{space}.clustered", root=str(tmp_path), cluster_by=["ts"])
    cut = F.col("ts") < moment(first.astimezone(timezone.utc) + timedelta(days=1), events.schema["ts"].dataType)
    mixed, clustered = (spark.table(f"{space}.{t}").where(cut) for t in ("mixed", "clustered"))
    assert sorted(map(str, mixed.collect())) == sorted(map(str, clustered.collect()))
    assert rows_read(mixed) == events.count() and rows_read(clustered) <= events.count() / 4
