"""Counts and summaries. Each one reduces inside the map tasks before it shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import has_value
from tidemark.operators.boards import ordered


def count_by(df: DataFrame, key: str, name: str = "cnt") -> DataFrame:
    """Rows per value, most frequent first."""
    return ordered(df.groupBy(key).agg(F.count(F.lit(1)).alias(name)), desc=[name], asc=[key])


def share_by(
    df: DataFrame,
    key: str,
    flag: Column,
    members: DataFrame,
    on: dict[str, str],
    part: str = "operating",
    total: str = "total",
) -> DataFrame:
    """Flagged rows and all rows per group of a dimension.

    ``key`` is a column of ``members``; ``on`` maps the one join column of ``df`` to it.
    Rows are counted per join value before the join, so the join meets one row per value.
    """
    (left, right), = on.items()
    counts = df.groupBy(F.col(left).alias("_left")).agg(
        F.count_if(flag).alias("_part"), F.count(F.lit(1)).alias("_total")
    )
    return (
        counts.join(members.select(F.col(right).alias("_right"), key), F.col("_left") == F.col("_right"))
        .groupBy(key)
        .agg(F.sum("_part").alias(part), F.sum("_total").alias(total))
    )


def failures_by(df: DataFrame, key: str, failed: Column) -> DataFrame:
    """Failed and attempted rows per key."""
    return df.groupBy(key).agg(
        F.count_if(failed).alias("errors"),
        F.count(F.lit(1)).alias("attempts"),
        (F.count_if(failed) == 0).alias("all_ok"),
    )


def known_keys(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Distinct keys in order, without NULL, zero and empty ones."""
    name = name or key
    return ordered(df.where(has_value(df, key)).select(F.col(key).alias(name)).distinct(), asc=[name])


def versions_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keys seen more than once, with the number of versions and their time span."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("versions"), F.max(order).alias("newest"), F.min(order).alias("oldest"))
        .where(F.col("versions") > 1)
    )


def dedup_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows there are, and how many are left with one per key."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
    )


def batch_summary(df: DataFrame, batch: Column, entity: str, order: str) -> DataFrame:
    """Per batch: rows, distinct entities, first and last time."""
    return df.groupBy(batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("rows_written"),
        F.count_distinct(entity).alias("entities"),
        F.min(order).alias("first_ts"),
        F.max(order).alias("last_ts"),
    )
