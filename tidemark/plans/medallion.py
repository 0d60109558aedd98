"""The batch jobs of the pipeline: each reads one layer and writes the next."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.columns import moment, utc_date
from tidemark.functions.schemas import DESTINATION_BRONZE, ENTITY, LIVE_BRONZE, LIVE_FILE, conform
from tidemark.operators.aggregates import known_keys
from tidemark.operators.flatten import (
    entity_rows,
    explode_parks,
    extract_rides,
    live_rows,
    normalize_live,
    route_outcomes,
)
from tidemark.operators.latest import having_partner, latest, upsert
from tidemark.operators.retention import BRONZE_DAYS, TABLE_POLICY, Retention, batch_retention, expire_plan, expire_report
from tidemark.session import scratch_path
from tidemark.sources.bronze import committed, landed_batches, latest_bronze, read_bronze, write_bronze
from tidemark.sources.tables import snapshot_log, table_buckets, write_table


#: Which landed batches were taken.
TAKEN = "silver.taken_batches"


def batch_stamp(at: datetime | None = None) -> str:
    """The one ingest time of a batch, fixed by the caller and never taken again downstream."""
    return (at or datetime.now(timezone.utc)).astimezone(timezone.utc).isoformat()


def park_ids(destinations: DataFrame) -> DataFrame:
    """Ids of all parks of all destinations."""
    return known_keys(explode_parks(destinations), "id", "park_id")


def land_destinations(companies: DataFrame, root: str, at: datetime) -> dict:
    """Raw companies with their nested parks, stamped, to bronze."""
    stamped = companies.withColumn("ingest_timestamp", F.lit(batch_stamp(at)))
    return write_bronze(conform(stamped, DESTINATION_BRONZE), root, "destinations", at)


def _land_rides(
    payloads: DataFrame, root: str, prefix: str, at: datetime, schema: T.StructType, rows_of: Callable
) -> dict:
    """Rides of the good payloads to ``prefix``, failed payloads to ``prefix_failed``.

    The payloads are read and parsed once, and counted with that.
    """
    routed = route_outcomes(payloads, scratch_path(payloads.sparkSession, f"{prefix}-routed"))
    rides = rows_of(extract_rides(routed.good), batch_stamp(at))
    landed = write_bronze(conform(rides, schema), root, prefix, at)
    quarantined = write_bronze(routed.failed, root, f"{prefix}_failed", at)
    return landed | {"attempts": routed.attempts, "failed": routed.failures, "failed_path": quarantined["path"]}


def land_entities(payloads: DataFrame, root: str, at: datetime) -> dict:
    """Ride catalogue of the readable payloads to bronze; the others to ``entities_failed``."""
    return _land_rides(payloads, root, "entities", at, ENTITY, entity_rows)


def land_live(payloads: DataFrame, entities: DataFrame, root: str, at: datetime) -> dict:
    """Live observations of catalogued parks to bronze; failed payloads to ``live_failed``."""
    wanted = having_partner(payloads, entities.where("park_id is not null and park_id != 0"), {"park_id": "park_id"})
    return _land_rides(wanted, root, "live", at, LIVE_BRONZE, live_rows)


def refresh_destinations(spark: SparkSession, path: str, root: str | None = None) -> tuple[dict, dict]:
    """Bronze destinations to ``silver.destinations`` and ``silver.parks``, both replaced."""
    bronze = read_bronze(spark, path, DESTINATION_BRONZE)
    flat = write_table(bronze.drop("parks"), "silver.destinations", "overwrite", "recreate", root=root)
    parks = write_table(explode_parks(bronze), "silver.parks", "overwrite", "recreate", root=root)
    return flat, parks


def refresh_entities(spark: SparkSession, path: str, root: str | None = None) -> dict:
    """Bronze entities to ``silver.entities``, replaced."""
    return write_table(read_bronze(spark, path, ENTITY), "silver.entities", "overwrite", "recreate", root=root)


def live_batch(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One landed live batch, or several, as rows of silver."""
    rows = normalize_live(read_bronze(spark, path, LIVE_FILE))
    return rows.withColumn("ingest_date", utc_date(rows, "ingest_timestamp"))


def append_live(
    spark: SparkSession, path: str, root: str | None = None, on_drift: str = "fail", again: bool = False
) -> dict:
    """One landed live batch to ``silver.live_data``, added, in folders per ingest date.

    With ``again`` a run before this one may have added the batch: rows that are there, equal in all columns, are not
    added a second time. Silver is looked up on the batch's days alone.
    """
    rows, silver = live_batch(spark, path), "silver.live_data"
    if again and spark.catalog.tableExists(silver):
        there = spark.table(silver)
        same = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in rows.columns if c in there.columns]
        rows = rows.alias("new").join(there.alias("old"), same, "left_anti")
    return write_table(rows, silver, "append", on_drift, partition_by=["ingest_date"], root=root)


def refresh_gold(
    spark: SparkSession,
    silver: str = "silver.live_data",
    gold: str = "gold.live_data_current",
    root: str | None = None,
    added: DataFrame | None = None,
) -> dict:
    """``silver.live_data`` to one current row per entity, with the row count before and after.

    Gold lies in buckets by id. With ``added`` only these rows, which silver already has, are merged into the gold there
    is: the newest of both is the newest of all, whatever their times, and merging them again changes nothing. They are
    dealt to gold's buckets, and gold itself is not shuffled. Without it, or without gold, the whole history is read.
    """
    seen = Observation()
    merge = added is not None and spark.catalog.tableExists(gold)
    rows = (added if merge else spark.table(silver)).drop("ingest_date")
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    keys, order = ["id"], ["ingest_timestamp"]
    current, buckets = latest(rows, keys, order), None
    if merge:
        buckets = table_buckets(spark, gold)
        if buckets:
            current = current.repartition(buckets[0], *keys)
        current = upsert(spark.table(gold), current, keys, order)
    buckets = buckets or (int(spark.conf.get("spark.sql.shuffle.partitions")), keys)
    summary = write_table(current, gold, "overwrite", "recreate", root=root, buckets=buckets)
    return summary | {"rows_before": seen.get["rows"]}


def table_expiry(
    spark: SparkSession, now: datetime, policy: Sequence[Retention] = TABLE_POLICY
) -> tuple[DataFrame, DataFrame]:
    """The daily maintenance: versions of the policy's tables that are due, and its report."""
    log = snapshot_log(spark, [rule.table for rule in policy])
    return expire_plan(log, policy, now), expire_report(log, policy, now)


def bronze_expiry(
    spark: SparkSession, root: str, now: datetime, days: Mapping[str, int] = BRONZE_DAYS, default_days: int = 30
) -> DataFrame:
    """Landed batches of every prefix, with their files and whether they are past its days."""
    landed = landed_batches(spark, root).withColumn("day", F.col("landed_at").cast("date"))
    return batch_retention(landed, "prefix", "day", days, default_days, F.lit(now.astimezone(timezone.utc).date()))


def _named(batch: Column) -> Column:
    """A batch's path as it is noted: the same however a local path is written."""
    return F.regexp_replace(batch, "^file:/*", "/")


def pending_batches(spark: SparkSession, landed: DataFrame) -> DataFrame:
    """Landed batches that no run has taken whole, with ``again``: whether one has begun with it."""
    named = landed.withColumn("name", _named(F.col("batch")))
    if not spark.catalog.tableExists(TAKEN):
        return named.withColumn("again", F.lit(False)).drop("name")
    last = spark.table(TAKEN).groupBy(F.col("batch").alias("name")).agg(F.max("state").alias("state"))
    known = named.join(last, "name", "left").where("state is null or state <> 'done'")  # "done" is the greater
    return known.withColumn("again", F.col("state").isNotNull()).drop("name", "state")


def _note(spark: SparkSession, batches: Sequence[str], state: str, root: str | None) -> None:
    lines = spark.createDataFrame([(b,) for b in batches], "batch string")
    write_table(lines.select(_named(F.col("batch")).alias("batch"), F.lit(state).alias("state")), TAKEN, "append", "fail", root=root)


def run_once(spark: SparkSession, root: str, run_at: datetime | None = None, tables: str | None = None) -> dict:
    """Take the landed batches at or before a run that no run has taken yet through silver to gold.

    Reference data is replaced by its newest batch. Every live batch is added, in the order of landing, and then exactly
    their rows are merged into gold, in one write. Batches are noted before and after; one that was begun and not done
    is added again without the rows that are there. Only the names of batches still to take come to the driver.
    """
    done: dict = {}
    for prefix, names, refresh in (
        ("destinations", ("destinations", "parks"), refresh_destinations),
        ("entities", ("entities",), refresh_entities),
    ):
        path = latest_bronze(spark, root, prefix, run_at)
        if path and not pending_batches(spark, spark.createDataFrame([(path,)], "batch string")).isEmpty():
            result = refresh(spark, path, tables)
            done |= dict(zip(names, result if isinstance(result, tuple) else (result,), strict=True))
            _note(spark, [path], "done", tables)
    landed = landed_batches(spark, root, "live")
    if run_at is not None:
        landed = landed.where(F.col("landed_at") <= moment(run_at, landed.schema["landed_at"].dataType))
    found = pending_batches(spark, landed).orderBy("landed_at", "batch").select("batch", "again").collect()
    todo = [(r["batch"], r["again"]) for r in found if committed(spark, r["batch"])]
    if not todo:
        return done
    paths = [path for path, _ in todo]
    if new := [path for path, again in todo if not again]:
        _note(spark, new, "begun", tables)
    for path, again in todo:
        done["live"] = append_live(spark, path, tables, again=again)
    done["gold"] = refresh_gold(spark, root=tables, added=live_batch(spark, paths))
    _note(spark, paths, "done", tables)
    return done | {"batches": paths}
