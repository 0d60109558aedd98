"""Boards: events joined to their dimensions, and the orders they are shown in.

No join is hinted. Spark broadcasts a dimension only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``; past that it sort-merges and adaptive execution
splits a hot key over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import scratch_path


def star_board(
    facts: DataFrame,
    dimensions: DataFrame,
    on: Column | list[Column],
    columns: Sequence[Column | str],
    desc: Sequence[str] = (),
    asc: Sequence[str] = (),
) -> DataFrame:
    """Facts with the attributes of their dimension row, sorted, then projected.

    Join and filter the dimensions among themselves first, so the facts meet one small table.
    """
    return ordered(facts.join(dimensions, on, "inner"), desc, asc).select(*columns)


def leading(df: DataFrame, names: Sequence[str], suffix: str = "_first") -> DataFrame:
    """Some columns first and then all of them: the first ones under a name of their own, so that the rows can be written."""
    return df.select(*[F.col(f"`{c}`").alias(c + suffix) for c in names], "*")


def ordered(df: DataFrame, desc: Sequence[str] = (), asc: Sequence[str] = ()) -> DataFrame:
    """Descending columns first, then ascending, NULL last in both.

    End with a unique column: it fixes the order, and lets the range split cut through a
    value that many rows share.
    """
    keys = [F.col(c).desc_nulls_last() for c in desc] + [F.col(c).asc_nulls_last() for c in asc]
    return df.orderBy(*keys) if keys else df


def positioned(df: DataFrame, desc: Sequence[str] = (), asc: Sequence[str] = (), name: str = "position") -> DataFrame:
    """The rows of ``ordered`` with their place in the order, from 1; no task numbers them all.

    A sort deals the rows in ranges, and a task counts its own. The sorted rows are stored, as another sort may deal them
    otherwise. One count for each range comes to the driver; a row's place is its place in the range after all
    ranges before.
    """
    spark = df.sparkSession
    at = F.monotonically_increasing_id()  # the range in its high bits, the place in it in the low 33
    numbered = ordered(df, desc, asc).select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.shiftright(at, 33).alias("range"),
        at.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
    )
    path = scratch_path(spark, "positioned")
    numbered.write.parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    sizes = {r["range"]: r["n"] for r in stored.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = list(zip(sorted(sizes), accumulate([sizes[k] for k in sorted(sizes)], initial=0), strict=False))
    offsets = spark.createDataFrame(before, "range long, before long")
    return stored.join(offsets, "range").select("row.*", (F.col("before") + F.col("at") + 1).alias(name))


def top_n(df: DataFrame, n: int | None, desc: Sequence[str] = (), asc: Sequence[str] = ()) -> DataFrame:
    """The first n rows of the order; every task sends at most n. No n means all rows."""
    rows = ordered(df, desc, asc)
    return rows.limit(n) if n else rows
