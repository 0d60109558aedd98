"""Reads over the history of a table that grows by batches."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tidemark.functions.columns import moment, utc_date


def day_start(df: DataFrame, name: str) -> Column:
    """Start of a time column's day in UTC, in the column's own type."""
    day = utc_date(df, name)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86400)
    return day.cast("timestamp_ntz")


def latest_batch(df: DataFrame, order: str, at: date | datetime) -> DataFrame:
    """Rows of the newest UTC day at or before the day of ``at``, found by one narrow aggregate.

    There are no rows between that day and the limit, so both bounds are plain values that
    reach the scan, and files outside them are skipped.
    """
    day = at if isinstance(at, date) and not isinstance(at, datetime) else at.date()
    limit = moment(datetime.combine(day, time()) + timedelta(days=1), df.schema[order].dataType)
    landed = df.where(F.col(order) < limit)
    return landed.where(F.col(order) >= landed.agg(F.max(day_start(df, order)).alias("start")).scalar())


def as_of_nth_batch(df: DataFrame, order: str, n: int) -> DataFrame:
    """Rows present after the n-th newest day was written: that day and all before it."""
    days = df.select(day_start(df, order).alias("day")).distinct()
    newest_days = days.orderBy(F.col("day").desc_nulls_last()).limit(n)
    end = newest_days.agg((F.min("day") + F.expr("interval 1 day")).alias("end"))
    return df.where(F.col(order) < end.scalar())


def version_list(df: DataFrame, batch: Column, by: Sequence[str] = (), period: str = "month") -> DataFrame:
    """Per batch: the batch before it, the rows it added, and the rows there were after it.

    Rows are first counted per batch. Batches are then chained inside a calendar period, and
    the periods among themselves, so no task orders the whole list.
    """
    counts = df.groupBy(*by, batch.alias("batch")).agg(F.count(F.lit(1)).alias("added"))
    counts = counts.withColumn("_period", F.trunc(utc_date(counts, "batch"), period))
    inside = W.partitionBy(*by, "_period").orderBy(F.col("batch").asc_nulls_last())
    # Without ``by`` this window takes one row per calendar period.
    across = W.partitionBy(*by).orderBy(F.col("_period").asc_nulls_last())
    chained = counts.withColumns(
        {
            "_previous": F.lag("batch").over(inside),
            "_running": F.sum("added").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)),
        }
    )
    periods = counts.groupBy(*by, "_period").agg(F.sum("added").alias("_sum"), F.max("batch").alias("_last"))
    keys = [*by, "_period"]
    offsets = periods.select(
        *[F.col(c).alias(f"_of_{c}") for c in keys],
        F.lag("_last").over(across).alias("_before_batch"),
        (F.sum("_sum").over(across.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_sum")).alias("_before"),
    )
    # Null-safe, so that rows without a time stay and both sides share one scan.
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys]
    return chained.join(offsets, same).select(
        *by,
        "batch",
        F.coalesce("_previous", "_before_batch").alias("parent"),
        "added",
        (F.col("_before") + F.col("_running")).alias("total"),
    )
