"""Vectors as the two searches need them: which rows take part, and classes of equal vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship, two_keys


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v, ok, k1, k2): ``ok`` unless the vector is null, empty, zero, or holds nulls or non-finite numbers.

    Vectors are compared with vectors of their length only: the length is part of the keys.
    """
    ship(vectors.sparkSession)
    v = F.col(vector_col).cast("array<double>").alias("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v)
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0.0)
    clean = F.transform("v", lambda x: x + F.lit(0.0))  # -0.0 and 0.0 are equal
    return rows.select("vec_id", "v", F.coalesce(ok, F.lit(False)).alias("ok"), *two_keys(F.size("v"), clean))


def main_length(rows: DataFrame) -> int:
    """The most frequent length of the usable vectors; 0 if there are none. One aggregate, one row to the driver."""
    sizes = rows.where("ok").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n")
    first = sizes.first()
    return first["n"] if first else 0


def first_of_each(rows: DataFrame, n: int) -> DataFrame:
    """(k1, k2, v, ids): each distinct vector with its ``n`` smallest ids, nulls last; taken per task before the shuffle."""
    nth = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.col("vec_id").asc_nulls_last()))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= n)
    return few.groupBy("k1", "k2").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("vec_id")).alias("ids"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as a matrix of doubles."""
    if not len(column):
        return np.empty((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1), np.float64)


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``, added from the first component on, so that equal vectors tie."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out
