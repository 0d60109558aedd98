"""Newest row per key, and queries built on it.

``latest`` is one aggregate with a map-side part: each task keeps one row per key before
anything is shuffled, so a key with a third of all rows sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tidemark.functions.columns import moment


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind)
    return True


def _ref(name: str) -> Column:
    return F.col(f"`{name}`")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order``, then ``ties``, then all other columns.

    NULL in ``order`` loses to any value, NULL keys form one group. Works on streams too.
    The result does not depend on how the rows were split or in which order they came.
    """
    lead = [c for c in (*order, *ties) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    # Order columns first makes the row itself the sort key, so it is carried once.
    comparable = [c for c in rest if _sortable(df.schema[c].dataType)]
    opaque = [c for c in rest if c not in comparable]
    key = F.struct(*map(_ref, lead + comparable))
    if opaque:
        winner = F.max_by(F.struct(*map(_ref, lead + rest)), key)
    else:
        winner = F.max(key)
    best = df.groupBy(*map(_ref, keys)).agg(winner.alias("_best"))
    return best.select(*[_ref(c) if c in keys else F.col(f"_best.`{c}`").alias(c) for c in df.columns])


def newest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, ties: Sequence[str] = (), rank: str = "rn"
) -> DataFrame:
    """The n newest rows per key with their rank. Each task sends at most n rows per key."""
    window = W.partitionBy(*map(_ref, keys)).orderBy(*[_ref(c).desc_nulls_last() for c in (*order, *ties)])
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def latest_as_of(
    df: DataFrame, keys: Sequence[str], order: str, at: datetime | Column, ties: Sequence[str] = ()
) -> DataFrame:
    """State at a moment: later rows are cut at the scan."""
    limit = at if isinstance(at, Column) else moment(at, df.schema[order].dataType)
    return latest(df.where(_ref(order) <= limit), keys, [order], ties)


def filter_then_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    where: Column | None,
    members: DataFrame,
    on: dict[str, str],
) -> DataFrame:
    """Newest row per key among the rows that pass ``where`` and have a partner in ``members``.

    ``on`` maps columns of ``df`` to columns of ``members``. Rows are first reduced to one per key and join value: max of
    maxima is the same row, and the join then meets no hot key. How to join is left to Spark.
    """
    rows = df if where is None else df.where(where)
    extra = [c for c in on if c not in keys]
    candidates = latest(rows, [*keys, *extra], order, ties)
    kept = having_partner(candidates, members, on)
    return latest(kept, keys, order, ties) if extra else kept


def latest_then_filter(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    where: Column | None,
    members: DataFrame,
    on: dict[str, str],
) -> DataFrame:
    """Current rows that pass ``where`` and have a partner: an older match does not count."""
    current = latest(df, keys, order, ties)
    return having_partner(current if where is None else current.where(where), members, on)


def last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key whose ``value`` is known, which may be older than the newest row."""
    return latest(df.where(_ref(value).isNotNull()), keys, order, ties)


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """``current`` with the rows of ``changes`` put in by key; of two rows the newer stays."""
    return latest(current.unionByName(changes, allowMissingColumns=True), keys, order, ties)


def having_partner(df: DataFrame, members: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` with at least one partner in ``members``; no row is repeated."""
    names = {right: f"_member_{i}" for i, right in enumerate(on.values())}
    slim = members.select(*[_ref(right).alias(name) for right, name in names.items()])
    condition = [_ref(left) == F.col(names[right]) for left, right in on.items()]
    return df.join(slim, condition, "left_semi")
