"""File and message sinks, each with a summary of what was written."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.operators.flatten import to_messages
from tidemark.operators.unions import union_missing
from tidemark.sources.bronze import write_bronze
from tidemark.sources.tables import rebalanced, write_table


def dated_path(root: str, *names: str, at: datetime) -> str:
    """``root/name/.../YYYY-MM-DD/YYYY-MM-DDTHH-MM-SS.parquet``."""
    return "/".join([root.rstrip("/"), *names, at.strftime("%Y-%m-%d"), at.strftime("%Y-%m-%dT%H-%M-%S") + ".parquet"])


def from_records(spark: SparkSession, records: Sequence[dict], schema: T.StructType | str) -> DataFrame:
    """Rows from memory. The schema is required: a column of NULLs has no type to infer."""
    return spark.createDataFrame(list(records), schema)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists",
    at: datetime | None = None, sizes: bool = False,
) -> dict:
    """Snappy parquet, optionally partitioned. With ``sizes`` the files are listed and added up.

    Whether there are rows is found out before anything is replaced: an input without rows writes nothing.
    """
    counted = Observation()
    df = rebalanced(df, partition_by)
    writer = (
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy").mode(mode)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    some = not df.isEmpty()
    if some:
        writer.parquet(path)
    rows = counted.get["rows"] if some else 0
    summary = {
        "status": "loaded" if rows else "skipped",
        "reason": None if rows else "no rows",
        "path": path,
        "row_count": rows,
        "columns": df.columns,
        "schema": df.schema.json(),
        "column_count": len(df.columns),
        "timestamp": (at or datetime.now(timezone.utc)).isoformat(),
    }
    if sizes and some:
        summary["size_bytes"] = file_bytes(df.sparkSession, path)
    return summary


def file_bytes(spark: SparkSession, path: str) -> int:
    """Size of all parquet files below a path; their content is not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    )
    return files.load(path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]


def read_summary(spark: SparkSession, summary: dict, root: str | None = None) -> DataFrame:
    """The batch a write summary describes, by its object name under ``root`` or its path.

    With a schema in the summary columns keep their types, partition columns too.
    """
    reader = spark.read
    if summary.get("schema"):
        reader = reader.schema(T.StructType.fromJson(json.loads(summary["schema"])))
    if summary.get("object_name") and root:
        return reader.parquet(f"{root.rstrip('/')}/{summary['object_name']}")
    if summary.get("path"):
        return reader.parquet(summary["path"])
    raise ValueError(f"summary names no object and no path: {summary}")


def write_csv(data: DataFrame | Sequence[DataFrame], path: str, mode: str = "errorifexists") -> bool:
    """CSV with a header; NULL is the empty field and a quote is doubled. Returns whether it wrote.

    One table keeps its column order. Several are unioned over the sorted union of their
    columns, and nothing is written if they hold no rows.
    """
    if isinstance(data, DataFrame):
        rows = data
    else:
        if not data:
            return False
        rows = union_missing(data, sort_columns=True)
        if rows.isEmpty():
            return False
    rows.write.option("header", True).option("nullValue", "").option("escape", '"').mode(mode).csv(path)
    return True


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Send each row as a JSON message without key. Needs Spark's Kafka connector."""
    to_messages(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def load(data: DataFrame, target: str, kind: str, **options):
    """One entry for every sink: ``table``, ``parquet``, ``csv``, ``bronze`` or ``messages``.

    ``target`` is the table name, the path, the bronze root, or the topic.
    """
    sinks = {
        "table": lambda: write_table(data, target, **options),
        "parquet": lambda: write_parquet(data, target, **options),
        "csv": lambda: write_csv(data, target, **options),
        "bronze": lambda: write_bronze(data, target, **options),
        "messages": lambda: publish(data, topic=target, **options),
    }
    if kind not in sinks:
        raise ValueError(f"unknown sink {kind!r}, use one of {sorted(sinks)}")
    return sinks[kind]()
