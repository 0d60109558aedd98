"""Retention plans: which versions and which landed batches are due to go. Nothing is deleted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import moment
from tidemark.operators.latest import newest


class Retention(NamedTuple):
    """Keep versions younger than ``retain_days``, and the newest ``min_snapshots`` of any age."""

    table: str
    retain_days: int
    min_snapshots: int


# The policy of the five pipeline tables, and days per bronze prefix.
TABLE_POLICY = (
    Retention("silver.live_data", 30, 5),
    Retention("gold.live_data_current", 7, 2),
    Retention("silver.destinations", 7, 1),
    Retention("silver.parks", 7, 1),
    Retention("silver.entities", 7, 1),
)
BRONZE_DAYS = {"destinations": 7, "entities": 7, "live": 30}


def _rules(spark: SparkSession, policy: Sequence[Retention]) -> DataFrame:
    """The policy as a literal relation."""
    return spark.createDataFrame(
        pa.table(
            {
                "table": pa.array([rule.table for rule in policy], pa.string()),
                "retain_days": pa.array([rule.retain_days for rule in policy], pa.int32()),
                "min_snapshots": pa.array([rule.min_snapshots for rule in policy], pa.int32()),
            }
        )
    )


def _governed(versions: DataFrame, policy: Sequence[Retention], now: datetime | Column) -> DataFrame:
    """Versions of the policy's tables, with the age test as ``_old``."""
    today = now if isinstance(now, Column) else moment(now, versions.schema["committed_at"].dataType)
    rules = _rules(versions.sparkSession, policy).select(
        "table", "min_snapshots", (today - F.make_dt_interval(F.col("retain_days"))).alias("_cutoff")
    )
    return versions.join(rules, "table").select(
        "table", "snapshot_id", "committed_at", "min_snapshots", (F.col("committed_at") < F.col("_cutoff")).alias("_old")
    )


def _always_kept(governed: DataFrame, policy: Sequence[Retention]) -> DataFrame:
    """The newest ``min_snapshots`` versions per table; each task sends no more than that many of a table."""
    most = max((rule.min_snapshots for rule in policy), default=0)
    return newest(governed, ["table"], ["committed_at", "snapshot_id"], most).where("rn <= min_snapshots")


def expire_plan(versions: DataFrame, policy: Sequence[Retention], now: datetime | Column) -> DataFrame:
    """The versions to expire: old, and older than the last one that is always kept.

    ``versions`` has ``table``, ``snapshot_id`` and ``committed_at``. They are read twice: for the last kept one of each
    table, and to compare each with it.
    """
    governed = _governed(versions, policy, now)
    floors = _always_kept(governed, policy).groupBy("table").agg(
        F.min(F.struct("committed_at", "snapshot_id")).alias("_floor")
    )
    marked = governed.where("_old").join(floors, "table", "left")
    due = F.col("_floor").isNull() | (F.struct("committed_at", "snapshot_id") < F.col("_floor"))
    return marked.where(due).select("table", "snapshot_id", "committed_at")


def expire_report(versions: DataFrame, policy: Sequence[Retention], now: datetime | Column) -> DataFrame:
    """Per table of the policy: versions before and after, expired, and ``skipped`` if it has none."""
    governed = _governed(versions, policy, now)
    counts = governed.groupBy("table").agg(F.count(F.lit(1)).alias("_all"), F.count_if("_old").alias("_old_all"))
    kept = _always_kept(governed, policy).groupBy("table").agg(F.count_if("_old").alias("_old_kept"))
    named = _rules(versions.sparkSession, policy).select("table").join(counts, "table", "left").join(kept, "table", "left")
    expired = F.col("_old_all") - F.coalesce("_old_kept", F.lit(0))
    return named.select(
        "table",
        F.col("_all").alias("snapshots_before"),
        (F.col("_all") - expired).alias("snapshots_after"),
        expired.alias("expired"),
        F.when(F.col("_all").isNull(), "skipped").otherwise("ok").alias("status"),
    )


def batch_retention(
    batches: DataFrame, prefix: str, batch: str, keep_days: Mapping[str, int], default_days: int,
    today: Column | None = None,
) -> DataFrame:
    """Per prefix and batch: rows, and whether the batch is past its prefix's days.

    Without ``today`` the newest batch of all prefixes is taken for it.
    """
    counts = batches.groupBy(F.col(prefix).alias("prefix"), F.col(batch).alias("batch")).agg(
        F.count(F.lit(1)).alias("files")
    )
    days = F.lit(default_days)
    for name, keep in keep_days.items():
        days = F.when(F.col("prefix") == name, F.lit(keep)).otherwise(days)
    reference = today if today is not None else batches.agg(F.max(batch).alias("m")).scalar()
    return counts.withColumn("expired", F.col("batch") < F.date_sub(reference, days))


def batch_retention_report(plan: DataFrame) -> DataFrame:
    """Per prefix: files, and files in expired batches."""
    return plan.groupBy("prefix").agg(
        F.sum("files").alias("files"),
        F.coalesce(F.sum(F.when(F.col("expired"), F.col("files"))), F.lit(0)).alias("expired"),
    )
