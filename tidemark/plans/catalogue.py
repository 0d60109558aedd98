"""The operators run over the test tables, one query each.

``events`` plays the live history, ``customer`` the entities, ``nation`` the parks, ``region``
the destinations, ``orders`` the table versions and ``lineitem`` a large event log. Nested
inputs are built per row, so every query's work grows with its tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.columns import (
    clock_text,
    default_if_absent,
    iso_text,
    landing_path,
    moment,
    parse_iso,
    utc_clock,
)
from tidemark.functions.schemas import ENTITY, LIVE_FILE, LONG, PAYLOAD, TEXT, cast_timestamps, struct, void_to_string
from tidemark.operators import aggregates, boards, flatten, latest as newest_rows, retention, versions
from tidemark.operators.unions import union_missing
from tidemark.plans import medallion
from tidemark.session import scratch_path
from tidemark.sources import bronze, files, tables
from tidemark.streaming import live, progress

Query = Callable[[SparkSession, str], DataFrame]

ENTITY_KEY, TIME, TIE = ["user_id"], ["ts"], ["event_id"]
CUT = datetime(2024, 1, 10, tzinfo=timezone.utc)
BATCH_TIME = datetime(2024, 2, 1, 3, 0, 0, tzinfo=timezone.utc)


# The schemas of the test tables the queries read.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _parks_of_region(spark: SparkSession, d: str, region: int) -> DataFrame:
    """Entities whose park lies in a destination."""
    parks = read(spark, d, "nation").where(F.col("n_regionkey") == region)
    return read(spark, d, "customer").join(parks, F.col("c_nationkey") == F.col("n_nationkey"))


# --- current state -----------------------------------------------------------------------


def latest_per_entity(spark: SparkSession, d: str) -> DataFrame:
    return newest_rows.latest(read(spark, d, "events"), ENTITY_KEY, TIME, TIE)


def latest_as_of(spark: SparkSession, d: str) -> DataFrame:
    return newest_rows.latest_as_of(read(spark, d, "events"), ENTITY_KEY, "ts", CUT, TIE)


def filter_then_latest(spark: SparkSession, d: str) -> DataFrame:
    return newest_rows.filter_then_latest(
        read(spark, d, "events"), ENTITY_KEY, TIME, TIE,
        F.col("event_type") == "click", _parks_of_region(spark, d, 1), {"user_id": "c_custkey"},
    )


def latest_then_filter(spark: SparkSession, d: str) -> DataFrame:
    return newest_rows.latest_then_filter(
        read(spark, d, "events"), ENTITY_KEY, TIME, TIE,
        F.col("event_type") == "click", _parks_of_region(spark, d, 1), {"user_id": "c_custkey"},
    )


def last_known_nonnull(spark: SparkSession, d: str) -> DataFrame:
    known = F.when(~F.col("event_type").isin("error", "view"), F.col("event_type"))
    rows = read(spark, d, "events").select("user_id", known.alias("bg_status"), "value", "ts", "event_id")
    return newest_rows.last_known(rows, ENTITY_KEY, TIME, "bg_status", TIE).drop("event_id")


def latest_line_per_part(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    return newest_rows.latest(rows, ["l_partkey"], ["l_shipdate"], ["l_orderkey", "l_linenumber", "l_suppkey"])


def upsert_current(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events")
    cut = moment(CUT, T.TimestampNTZType())
    before = newest_rows.latest(events.where(F.col("ts") <= cut), ENTITY_KEY, TIME, TIE)
    return newest_rows.upsert(before, events.where(F.col("ts") > cut), ENTITY_KEY, TIME, TIE)


# --- boards ------------------------------------------------------------------------------


def star_board(spark: SparkSession, d: str) -> DataFrame:
    destinations = read(spark, d, "region").where(F.col("r_regionkey") == 1)
    parks = read(spark, d, "nation").where(F.col("n_nationkey").isin(1, 6))
    places = destinations.join(parks, F.col("r_regionkey") == F.col("n_regionkey")).join(
        read(spark, d, "customer"), F.col("n_nationkey") == F.col("c_nationkey")
    )
    return boards.star_board(
        read(spark, d, "events"), places, F.col("user_id") == F.col("c_custkey"),
        [
            F.col("r_name").alias("dest_name"), F.col("n_name").alias("park_name"),
            F.col("c_name").alias("entity_name"), F.col("event_type").alias("status"),
            F.col("value").alias("wait_time"), F.col("ts").alias("last_updated"),
        ],
        desc=["value"], asc=["event_id"],
    )


def current_board(spark: SparkSession, d: str) -> DataFrame:
    current = newest_rows.latest(
        read(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value"), ENTITY_KEY, TIME, TIE
    )
    places = read(spark, d, "customer").where(F.col("c_mktsegment").isNotNull()).join(
        read(spark, d, "nation").where(F.col("n_nationkey") == 1), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return boards.star_board(
        current, places, F.col("user_id") == F.col("c_custkey"),
        [
            F.col("c_name").alias("entity_name"), F.col("event_type").alias("status"),
            F.col("value").alias("wait_time"), F.col("ts").alias("last_updated"),
        ],
        desc=["value"], asc=["event_id"],
    )


def star_repeated(spark: SparkSession, d: str) -> DataFrame:
    """One column in front of all the columns of a destination."""
    rows = read(spark, d, "nation").alias("d").where(F.col("d.n_regionkey") == 1).select("d.*")
    return boards.leading(rows, ["n_name"])


def catalogued_only(spark: SparkSession, d: str) -> DataFrame:
    catalogue = read(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING")
    events = read(spark, d, "events").select("event_id", "user_id", "value")
    return newest_rows.having_partner(events, catalogue, {"user_id": "c_custkey"})


def top_n(spark: SparkSession, d: str) -> DataFrame:
    return boards.top_n(read(spark, d, "events").select("event_id", "value"), 10, desc=["value"], asc=["event_id"])


def board_positions(spark: SparkSession, d: str) -> DataFrame:
    """The place of every event in the order of a board: falling values, the unknown last."""
    return boards.positioned(read(spark, d, "events").select("event_id", "value"), desc=["value"], asc=["event_id"])


def where_text(spark: SparkSession, d: str) -> DataFrame:
    """A predicate given as text over a named view, with its values bound; a limit of 0 means all rows."""
    name = f"events_{uuid.uuid4().hex}"
    read(spark, d, "events").createOrReplaceTempView(name)
    text, values = "event_type = :kind and value > :least", {"kind": "view", "least": 10}
    found = tables.read_table(spark, name, text, 0, values).select("event_id", "user_id", "value")
    spark.catalog.dropTempView(name)
    return found


# --- aggregates --------------------------------------------------------------------------


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.count_by(read(spark, d, "events").withColumnRenamed("event_type", "status"), "status")


def operating_ratio(spark: SparkSession, d: str) -> DataFrame:
    entities = read(spark, d, "customer").join(
        read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return aggregates.share_by(
        read(spark, d, "events"), "n_name", F.col("event_type") == "view", entities, {"user_id": "c_custkey"}
    )


def fetch_errors(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.failures_by(read(spark, d, "events"), "user_id", F.col("event_type") == "error")


def versions_per_entity(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.versions_by(read(spark, d, "events"), ENTITY_KEY, "ts")


def dedup_counts(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.dedup_counts(read(spark, d, "events"), ENTITY_KEY)


def batch_summary(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.batch_summary(read(spark, d, "events"), F.col("ts").cast("date"), "user_id", "ts")


def park_ids(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.known_keys(read(spark, d, "customer"), "c_nationkey", "park_id")


# --- nested payloads ---------------------------------------------------------------------


def _companies(spark: SparkSession, d: str) -> DataFrame:
    """Every customer as a destination with three parks, one of them with the falsy id 0."""

    def park(id_, name):
        nothing = F.lit(None).cast("string")
        return F.struct(
            id_.cast("bigint").alias("id"), name.alias("name"), F.col("c_mktsegment").alias("country"),
            nothing.alias("continent"), F.col("c_acctbal").cast("string").alias("latitude"),
            nothing.alias("longitude"), F.lit("UTC").alias("timezone"),
        )

    own = park(F.col("c_nationkey"), F.concat(F.lit("Park "), F.col("c_nationkey")))
    second = park(F.col("c_custkey") + 1000, F.concat(F.lit("Second of "), F.col("c_name")))
    nameless = park(F.lit(None), F.lit("no id"))
    return read(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.array(own, second, nameless).alias("parks"),
        F.lit("2024-02-01T03:00:00+00:00").alias("ingest_timestamp"),
    )


def explode_parks(spark: SparkSession, d: str) -> DataFrame:
    return flatten.explode_parks(_companies(spark, d)).drop("latitude", "longitude", "continent")


def destinations_flat(spark: SparkSession, d: str) -> DataFrame:
    return _companies(spark, d).drop("parks")


def land_flatten(spark: SparkSession, d: str) -> DataFrame:
    ride = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        (F.col("c_acctbal") > 0).alias("is_open"), F.col("c_acctbal").alias("wait_time"),
    )
    outside = F.struct((-F.col("c_custkey")).alias("id"), F.concat(F.lit("Outside "), F.col("c_name")).alias("name"))
    land = F.struct(F.length("c_mktsegment").alias("id"), F.col("c_mktsegment").alias("name"), F.array(ride).alias("rides"))
    no_rides = F.filter(F.array(ride), lambda _: F.lit(False))
    empty = F.struct(F.lit(0).alias("id"), F.lit("no rides").alias("name"), no_rides.alias("rides"))
    payloads = read(spark, d, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("park_id"),
        F.to_json(F.struct(F.array(land, empty).alias("lands"), F.array(outside).alias("rides"))).alias("body"),
    )
    return flatten.extract_rides(payloads)


def error_split(spark: SparkSession, d: str) -> DataFrame:
    failed = F.when(F.col("event_type") == "error", F.concat(F.lit("HTTP "), F.get_json_object("props", "$.k")))
    payloads = read(spark, d, "events").select("event_id", "user_id", "props", failed.alias("error"))
    return flatten.outcomes(payloads, body="props").drop("props")


def quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Failed payloads: reported errors, unreadable bodies, and values that do not fit."""
    kind = F.col("event_type")
    body = (
        F.when(kind == "view", F.format_string('{"rides": [{"id": %d, "wait_time": 5}]}', F.col("event_id")))
        .when(kind == "click", F.lit("<html>busy</html>"))
        .when((kind != "error") & (F.col("event_id") % 2 == 0), F.lit('{"rides": [{"id": "none"}]}'))
        .when(kind != "error", F.lit('{"lands": [{"rides": [{"id": 1, "wait_time": "n/a"}]}]}'))
    )
    error = F.when(kind == "error", F.concat(F.lit("HTTP "), F.get_json_object("props", "$.k")))
    payloads = read(spark, d, "events").select("event_id", body.alias("body"), error.alias("error"))
    return flatten.split_outcomes(payloads)[1]


def landing_report(spark: SparkSession, d: str) -> DataFrame:
    """One run of landing: attempts, failures and rides, from one pass over the payloads, and what was landed of each."""
    root = scratch_path(spark, "landing")
    kind = F.col("event_type")
    body = F.when(kind != "error", F.format_string('{"rides": [{"id": %d, "wait_time": %s}]}', F.col("event_id"), F.col("value")))
    body = F.when(kind == "click", F.lit("<html>busy</html>")).otherwise(body)
    error = F.when(kind == "error", F.concat(F.lit("HTTP "), F.get_json_object("props", "$.k")))
    payloads = read(spark, d, "events").select(F.col("user_id").alias("park_id"), body.alias("body"), error.alias("error"))
    landed = medallion.land_entities(payloads, root, BATCH_TIME)
    rides = bronze.read_bronze(spark, landed["path"], ENTITY).select("park_id", F.lit("ride").alias("what"))
    failed = bronze.read_bronze(spark, landed["failed_path"], PAYLOAD).select("park_id", F.col("error").alias("what"))
    counts = rides.union(failed).groupBy("park_id", "what").agg(F.count(F.lit(1)).alias("rows"))
    told = {name: F.lit(landed[key]).cast("bigint") for name, key in (("attempts", "attempts"), ("failures", "failed"))}
    return counts.withColumns(told)


def good_rides(spark: SparkSession, d: str) -> DataFrame:
    """Rides of the payloads that did not fail."""
    kind = F.col("event_type")
    body = F.when(kind != "error", F.format_string('{"rides": [{"id": %d, "wait_time": %s}]}', F.col("event_id"), F.col("value")))
    payloads = read(spark, d, "events").select("user_id", body.alias("body"), F.lit(None).cast("string").alias("error"))
    return flatten.extract_rides(flatten.split_outcomes(payloads)[0]).select("user_id", "land_id", "id", "wait_time")


def normalize_live(spark: SparkSession, d: str) -> DataFrame:
    is_view = F.col("event_type") == "view"
    rides = read(spark, d, "events").select(
        F.col("user_id").alias("park_id"), F.lit(None).cast("bigint").alias("land_id"),
        F.lit(None).cast("string").alias("land_name"), F.col("event_id").alias("id"),
        F.col("event_type").alias("name"), F.when(F.col("event_type") != "error", is_view).alias("is_open"),
        F.col("value").alias("wait_time"), clock_text(F.col("ts")).alias("last_updated"),
    )
    silver = flatten.normalize_live(flatten.live_rows(rides, "2024-02-01T05:00:00+02:00"))
    return silver.withColumns({c: utc_clock(F.col(c)) for c in ("last_updated", "ingest_timestamp")})


def queue_flatten(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    queue = F.struct(
        F.struct(k.alias("waitTime")).alias("STANDBY"),
        F.struct((k + 1).alias("waitTime")).alias("PAID_STANDBY"),
        F.struct(F.col("event_type").alias("state"), clock_text(F.col("ts")).alias("returnStart")).alias("RETURN_TIME"),
        F.when(F.col("event_type") == "view", F.struct(F.lit("AVAILABLE").alias("allocationStatus"))).alias("BOARDING_GROUP"),
    )
    return flatten.flatten_queue(read(spark, d, "events").select("event_id", F.to_json(queue).alias("queue")))


def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def payload_rows(spark: SparkSession, d: str) -> DataFrame:
    """A body per customer, whose shape depends on the segment."""
    own = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    other = F.to_json(F.struct((F.col("c_custkey") + 1000).alias("id"), F.lit("other").alias("name")))
    segment = F.col("c_mktsegment")
    body = (
        F.when(segment == "BUILDING", F.format_string('{"destinations": [%s, 5]}', own))
        .when(segment == "AUTOMOBILE", F.format_string('[%s, "x", %s]', own, other))
        .when(segment == "MACHINERY", F.format_string("[[%s, 7], [%s]]", own, other))
        .when(segment == "HOUSEHOLD", F.lit('{"other": 1}'))
        .otherwise(F.lit("42"))
    )
    records = flatten.payload_records(read(spark, d, "customer").select(F.col("c_custkey").alias("body_id"), body.alias("body")))
    return records.select(
        "body_id",
        F.variant_get("record", "$.id", "bigint").alias("id"),
        F.variant_get("record", "$.name", "string").alias("name"),
    )


# --- functions ---------------------------------------------------------------------------


def mixed_bodies(spark: SparkSession, d: str) -> DataFrame:
    """The kinds of values at every path of bodies that do not agree, and the one schema they have together."""
    kind, number = F.col("event_type"), F.col("event_id")
    body = (
        F.when(kind == "view", F.format_string('{"id": %d, "wait": 5, "tags": ["a", 1]}', number))
        .when(kind == "click", F.format_string('{"id": "n%d", "wait": null, "at": {"x": 0.5}}', number))
        .when(kind == "error", F.lit("<html>busy</html>"))
        .otherwise(F.format_string('{"id": %d, "wait": "n/a", "at": {"x": true}}', number))
    )
    bodies = read(spark, d, "events").select(body.alias("body"))
    return bronze.value_types(bodies, depth=2).withColumn("merged", F.lit(bronze.merged_schema(bodies)))


def parse_ts(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events")
    text = clock_text(F.col("ts"))
    shifted = F.concat(F.translate((F.col("ts") + F.expr("interval 2 hours")).cast("string"), " ", "T"), F.lit("+02:00"))
    source = F.when(F.col("event_type") == "view", shifted).otherwise(text)
    return events.select("event_id", utc_clock(parse_iso(source)).alias("t"))


def cast_times(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select("event_id", clock_text(F.col("ts")).alias("seen_at"))
    return cast_timestamps(rows, ["seen_at", "not_there"]).withColumn("seen_at", utc_clock(F.col("seen_at")))


def iso_times(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", iso_text(parse_iso(clock_text(F.col("ts")))).alias("iso"))


def default_missing_key(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    body = (
        F.when(kind == "view", F.lit("{}"))
        .when(kind == "click", F.lit('{"entityType": null}'))
        .otherwise(F.to_json(F.struct(kind.alias("entityType"))))
    )
    return read(spark, d, "events").select("event_id", default_if_absent(body, "entityType", "ATTRACTION").alias("entity_type"))


def void_columns(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select(
        "event_id", F.lit(None).alias("note"),
        F.array(F.struct(F.col("user_id").alias("id"), F.lit(None).alias("tag"))).alias("items"),
    )
    return void_to_string(rows).select("event_id", "note", F.inline("items"))


def json_encode(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment")
    )
    return flatten.to_messages(rows)


def landing_paths(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", landing_path(F.col("event_type"), F.col("ts")).alias("path"))


def union_of_sources(spark: SparkSession, d: str) -> DataFrame:
    customers = read(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
    )
    parts = read(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size")
    )
    return union_missing([customers, parts])


# --- history and retention ---------------------------------------------------------------


def latest_batch(spark: SparkSession, d: str) -> DataFrame:
    rows = versions.latest_batch(read(spark, d, "events"), "ts", date(2024, 1, 15))
    return rows.select("event_id", "user_id", F.col("ts").cast("date").alias("batch"))


def pick_snapshot_rows(spark: SparkSession, d: str) -> DataFrame:
    return versions.as_of_nth_batch(read(spark, d, "events"), "ts", 5).select("event_id", "user_id")


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    return versions.version_list(read(spark, d, "events"), F.col("ts").cast("date"))


def snapshots_per_table(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").select("l_returnflag", "l_shipdate")
    return versions.version_list(rows, F.col("l_shipdate").cast("date"), by=["l_returnflag"])


SEGMENT_POLICY = (
    retention.Retention("BUILDING", 30, 5),
    retention.Retention("AUTOMOBILE", 7, 2),
    retention.Retention("MACHINERY", 7, 1),
    retention.Retention("HOUSEHOLD", 7, 1),
    retention.Retention("FURNITURE", 7, 1),
    retention.Retention("ABSENT", 7, 1),
)


def _segment_versions(spark: SparkSession, d: str) -> tuple[DataFrame, object]:
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = orders.join(
        read(spark, d, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        F.col("c_mktsegment").alias("table"), F.col("o_orderkey").alias("snapshot_id"),
        F.col("o_orderdate").alias("committed_at"),
    )
    return rows, orders.agg(F.max("o_orderdate").alias("now")).scalar()


def expire_report(spark: SparkSession, d: str) -> DataFrame:
    rows, now = _segment_versions(spark, d)
    return retention.expire_report(rows, SEGMENT_POLICY, now).withColumnRenamed("table", "tbl")


def expire_plan(spark: SparkSession, d: str) -> DataFrame:
    rows, now = _segment_versions(spark, d)
    return retention.expire_plan(rows, SEGMENT_POLICY, now).withColumnRenamed("table", "tbl")


def bronze_retention(spark: SparkSession, d: str) -> DataFrame:
    batches = read(spark, d, "events").select("event_type", F.col("ts").cast("date").alias("batch"))
    plan = retention.batch_retention(batches, "event_type", "batch", {"view": 30}, 7)
    return retention.batch_retention_report(plan)


# --- sinks and streams -------------------------------------------------------------------


def _bronze_events(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").withColumn("ts", clock_text(F.col("ts")))


BRONZE_EVENTS = struct(event_id=LONG, ts=TEXT, user_id=LONG, event_type=TEXT, value=T.DoubleType(), props=TEXT)


def bronze_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "bronze-roundtrip")
    bronze.write_bronze(_bronze_events(spark, d), root, "live", BATCH_TIME)
    path = bronze.latest_bronze(spark, root, "live", BATCH_TIME)
    rows = bronze.read_bronze(spark, path, BRONZE_EVENTS)
    return rows.withColumn("ts", utc_clock(parse_iso(F.col("ts"))))


def live_files(spark: SparkSession, d: str) -> DataFrame:
    """Landed lines with fractional waits and, for some, no entityType key, to the silver schema."""
    path = scratch_path(spark, "live-files")
    line = F.struct(
        F.col("event_id").alias("id"), F.col("value").alias("wait_time"), clock_text(F.col("ts")).alias("ingest_timestamp"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("entityType"),
    )
    read(spark, d, "events").select(F.to_json(line)).write.option("compression", "gzip").text(path)
    silver = flatten.normalize_live(bronze.read_bronze(spark, path, LIVE_FILE))
    return silver.select("id", "entityType", "wait_time", utc_clock(F.col("ingest_timestamp")).alias("ingest_timestamp"))


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv-roundtrip")
    merged = union_of_sources(spark, d)
    files.write_csv([merged.drop("size"), merged.select("id", "size").where("size is not null")], path)
    schema = "acctbal double, id bigint, name string, segment string, size int"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def partitioned_parquet(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "partitioned")
    summary = files.write_parquet(read(spark, d, "lineitem"), path, partition_by=["l_returnflag", "l_linestatus"])
    return files.read_summary(spark, summary)


def table_append(spark: SparkSession, d: str) -> DataFrame:
    """Two appends to one table; the second brings a new column and lacks another."""
    root = scratch_path(spark, "tables")
    name = f"silver_{root[-12:]}.events"
    events = read(spark, d, "events")
    cut = moment(CUT, T.TimestampNTZType())
    tables.write_table(events.where(F.col("ts") <= cut).drop("props"), name, root=root)
    tables.write_table(events.where(F.col("ts") > cut).drop("value"), name, on_drift="merge", root=root)
    return tables.read_table(spark, name)


def table_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Gold as a table that is replaced from itself and newer rows."""
    root = scratch_path(spark, "tables")
    name = f"gold_{root[-12:]}.current"
    events = read(spark, d, "events")
    cut = moment(CUT, T.TimestampNTZType())
    first = newest_rows.latest(events.where(F.col("ts") <= cut), ENTITY_KEY, TIME, TIE)
    tables.write_table(first, name, "overwrite", root=root)
    changes = events.where(F.col("ts") > cut)
    tables.write_table(newest_rows.upsert(spark.table(name), changes, ENTITY_KEY, TIME, TIE), name, "overwrite", root=root)
    return tables.read_table(spark, name)


def table_history(spark: SparkSession, d: str) -> DataFrame:
    """What its files say of two appends, an overwrite and an input without rows."""
    root = scratch_path(spark, "tables")
    name = f"silver_{root[-12:]}.history"
    events = read(spark, d, "events")
    cut = moment(CUT, T.TimestampNTZType())
    tables.write_table(events.where(F.col("ts") <= cut), name, root=root)
    tables.write_table(events.where(F.col("ts") > cut), name, root=root)
    tables.write_table(newest_rows.latest(events, ENTITY_KEY, TIME, TIE), name, "overwrite", root=root)
    tables.write_table(events.where(F.col("ts").isNull()), name, "overwrite", root=root)
    return tables.table_history(spark, name).select("operation", "rows")


def table_as_of(spark: SparkSession, d: str) -> DataFrame:
    """A table as it was between two appends and before it was replaced, told by its files alone."""
    root = scratch_path(spark, "tables")
    name = f"silver_{root[-12:]}.past"
    events = read(spark, d, "events")
    cut = moment(CUT, T.TimestampNTZType())
    then = tables.write_table(events.where(F.col("ts") <= cut), name, root=root)["written_at"]
    tables.write_table(events.where(F.col("ts") > cut), name, root=root)
    tables.write_table(newest_rows.latest(events, ENTITY_KEY, TIME, TIE), name, "overwrite", root=root)
    return tables.read_as_of(spark, name, datetime.fromisoformat(then))


def table_widened(spark: SparkSession, d: str) -> DataFrame:
    """Appends whose types do not agree: numbers widen and structs get the fields of both, without a rewrite."""
    root = scratch_path(spark, "tables")
    name = f"silver_{root[-12:]}.widened"
    events = read(spark, d, "events")
    cut = moment(CUT, T.TimestampNTZType())
    first = events.where(F.col("ts") <= cut).select(
        F.col("event_id").cast("int").alias("event_id"), F.struct(F.col("user_id").cast("int").alias("user"), F.col("event_type").alias("kind")).alias("about")
    )
    second = events.where(F.col("ts") > cut).select("event_id", F.struct(F.col("value").alias("value"), F.col("user_id").alias("user")).alias("about"))
    tables.write_table(first, name, root=root)
    tables.write_table(second, name, on_drift="merge", root=root)
    return tables.read_table(spark, name).select("event_id", "about.user", "about.kind", "about.value")


def clustered_as_of(spark: SparkSession, d: str) -> DataFrame:
    """The state at a moment, from a table that lies in ranges of time: later files are opened for their statistics alone."""
    root = scratch_path(spark, "tables")
    name = f"silver_{root[-12:]}.clustered"
    events = read(spark, d, "events").withColumn("ts", parse_iso(clock_text(F.col("ts"))))
    tables.write_table(events, name, root=root, cluster_by=TIME)
    past = newest_rows.latest_as_of(tables.read_table(spark, name), ENTITY_KEY, "ts", CUT, TIE)
    return past.withColumn("ts", utc_clock(F.col("ts")))


def colocated_board(spark: SparkSession, d: str) -> DataFrame:
    """Events and entities stored in equal buckets by entity: the newest events of entities in a segment, without a shuffle."""
    root = scratch_path(spark, "tables")
    space = f"silver_{root[-12:]}"
    tables.write_table(read(spark, d, "events"), f"{space}.events", "overwrite", root=root, buckets=(8, ENTITY_KEY))
    entities = read(spark, d, "customer").withColumnRenamed("c_custkey", "user_id")
    tables.write_table(entities, f"{space}.entities", "overwrite", root=root, buckets=(8, ENTITY_KEY))
    current = newest_rows.latest(spark.table(f"{space}.events"), ENTITY_KEY, TIME, TIE)
    chosen = spark.table(f"{space}.entities").where(F.col("c_mktsegment") == "BUILDING").select("user_id", "c_name")
    return current.join(chosen, "user_id").select("user_id", "c_name", "event_id", "event_type", "value")


def stored_board(spark: SparkSession, d: str) -> DataFrame:
    """Stored gold, in buckets by entity: written, merged with newer rows, read, joined and put in order.

    Neither the merge nor the join moves gold: both deal their other side to its buckets.
    """
    root = scratch_path(spark, "gold")
    name, buckets = f"gold_{root[-12:]}.current", (8, ENTITY_KEY)
    events = read(spark, d, "events")
    cut = moment(CUT, T.TimestampNTZType())
    first = newest_rows.latest(events.where(F.col("ts") <= cut), ENTITY_KEY, TIME, TIE)
    tables.write_table(first, name, "overwrite", root=root, buckets=buckets)
    changes = newest_rows.latest(events.where(F.col("ts") > cut), ENTITY_KEY, TIME, TIE).repartition(buckets[0], *ENTITY_KEY)
    tables.write_table(newest_rows.upsert(spark.table(name), changes, ENTITY_KEY, TIME, TIE), name, "overwrite", root=root)
    board = boards.star_board(
        tables.read_table(spark, name), read(spark, d, "customer"), F.col("user_id") == F.col("c_custkey"),
        ["user_id", F.col("c_name").alias("entity_name"), F.col("event_type").alias("status"), F.col("value").alias("wait_time")],
    )
    return boards.positioned(board, desc=["wait_time"], asc=["user_id"])


def stream_progress(spark: SparkSession, d: str) -> DataFrame:
    """What a stream's own events tell of its batches: how many failed, and how many rows they brought."""
    root = scratch_path(spark, "stream-progress")
    bronze.write_bronze(_bronze_events(spark, d), root, "live", BATCH_TIME)
    log = progress.BatchLog(spark, f"{root}/log")
    spark.streams.addListener(log)
    try:
        query = live.bronze_to_silver(
            live.bronze_stream(spark, f"{root}/bronze/live", BRONZE_EVENTS, max_files=2), f"{root}/silver",
            f"{root}/checkpoint", time_column="ts",
            normalize=lambda rows: rows.withColumn("ts", utc_clock(parse_iso(F.col("ts")))),
        )
        query.awaitTermination()
        log.wait(query)
    finally:
        spark.streams.removeListener(log)
    return progress.batch_report(spark, f"{root}/log").agg(
        F.sum("failures").alias("failures"), F.sum("rows").alias("rows"), F.sum("without_time").alias("without_time")
    )


def silver_stream(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "silver-stream")
    bronze.write_bronze(_bronze_events(spark, d), root, "live", BATCH_TIME)
    source = live.bronze_stream(spark, f"{root}/bronze/live", BRONZE_EVENTS)
    query = live.bronze_to_silver(
        source, f"{root}/silver", f"{root}/checkpoint", time_column="ts",
        normalize=lambda rows: rows.withColumn("ts", utc_clock(parse_iso(F.col("ts")))),
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/silver").drop("ingest_date")


def gold_stream(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "gold-stream")
    schema = read(spark, d, "events").schema
    # A pattern, as a stream takes a plain path for a folder; this table may be a folder or a file.
    source = spark.readStream.schema(schema).parquet(f"{d}/events[.]parquet")
    query = live.silver_to_gold(source, f"{root}/gold", f"{root}/checkpoint", ENTITY_KEY, TIME, TIE)
    query.awaitTermination()
    return live.read_gold(spark, f"{root}/gold", schema)


QUERIES: dict[str, Query] = {
    "latest_per_entity": latest_per_entity,
    "latest_as_of": latest_as_of,
    "filter_then_latest": filter_then_latest,
    "latest_then_filter": latest_then_filter,
    "last_known_nonnull": last_known_nonnull,
    "latest_line_per_part": latest_line_per_part,
    "upsert_current": upsert_current,
    "star_board": star_board,
    "current_board": current_board,
    "star_repeated": star_repeated,
    "catalogued_only": catalogued_only,
    "top_n": top_n,
    "where_text": where_text,
    "board_positions": board_positions,
    "status_counts": status_counts,
    "operating_ratio": operating_ratio,
    "fetch_errors": fetch_errors,
    "versions_per_entity": versions_per_entity,
    "dedup_counts": dedup_counts,
    "batch_summary": batch_summary,
    "park_ids": park_ids,
    "explode_parks": explode_parks,
    "destinations_flat": destinations_flat,
    "land_flatten": land_flatten,
    "error_split": error_split,
    "quarantine": quarantine,
    "good_rides": good_rides,
    "landing_report": landing_report,
    "normalize_live": normalize_live,
    "queue_flatten": queue_flatten,
    "json_flatten": json_flatten,
    "payload_rows": payload_rows,
    "mixed_bodies": mixed_bodies,
    "parse_ts": parse_ts,
    "cast_times": cast_times,
    "iso_times": iso_times,
    "default_missing_key": default_missing_key,
    "void_columns": void_columns,
    "json_encode": json_encode,
    "landing_path": landing_paths,
    "union_missing": union_of_sources,
    "latest_batch": latest_batch,
    "pick_snapshot_rows": pick_snapshot_rows,
    "snapshots": snapshots,
    "snapshots_per_table": snapshots_per_table,
    "expire_report": expire_report,
    "expire_plan": expire_plan,
    "bronze_retention": bronze_retention,
    "bronze_roundtrip": bronze_roundtrip,
    "live_files": live_files,
    "csv_roundtrip": csv_roundtrip,
    "partitioned_parquet": partitioned_parquet,
    "table_append": table_append,
    "table_overwrite": table_overwrite,
    "table_history": table_history,
    "table_as_of": table_as_of,
    "stored_board": stored_board,
    "table_widened": table_widened,
    "clustered_as_of": clustered_as_of,
    "colocated_board": colocated_board,
    "stream_progress": stream_progress,
    "silver_stream": silver_stream,
    "gold_stream": gold_stream,
}
