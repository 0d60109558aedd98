"""Unions of inputs that do not have the same columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_missing(frames: Iterable[DataFrame], sort_columns: bool = False) -> DataFrame:
    """All rows of all inputs; a column an input lacks is NULL there."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.select(*sorted(merged.columns)) if sort_columns else merged
