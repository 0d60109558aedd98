"""What the operators of this package share: the shared folder, stored tables, stable keys."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="tidemark-")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder of ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a temporary folder; any other session is refused, since
    executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/tidemark-llm/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Gives this library to the executors' Python, as ``--py-files`` would; once for each Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._tidemark_shipped = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back: cuts the lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def even_labels(spark: SparkSession, parts: int) -> list[int]:
    """A whole number for each of ``parts`` partitions that lands there when rows are dealt by it.

    Dealing rows by the numbers 0, 1, ... themselves puts several in one partition and leaves others empty.
    """
    found: dict[int, int] = {}
    at = 0
    while len(found) < parts:
        one = F.col("id").cast("int")
        some = spark.range(at, at + 8 * parts).groupBy(F.pmod(F.hash(one), F.lit(parts)).alias("part")).agg(F.min("id").alias("id"))
        found = {r["part"]: r["id"] for r in some.collect()} | found
        at += 8 * parts
    return [found[k] for k in range(parts)]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release() -> None:
    """Gives a worker's free memory back to the machine, where the C library can: workers outlive their tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def two_keys(*cols: Column | str) -> list[Column]:
    """Two independent 64-bit hashes of the columns: together a 128-bit key for equal content."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    return [F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit(7), *cols).alias("k2")]


def documents(df: DataFrame, carry: bool = False) -> DataFrame:
    """What an operator reads, so that other columns cannot clash; with ``carry`` the whole row goes along in ``row``,
    without the text.

    ``k1`` and ``k2`` name a row where its id cannot: ids may be null or repeated. Only rows equal in both columns
    share them.
    """
    ship(df.sparkSession)
    row = [F.struct(*[c for c in df.columns if c != "text"]).alias("row")] if carry else []
    own = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *row)
    return own.select("*", *two_keys("doc_id", F.coalesce("text", F.lit(""))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
