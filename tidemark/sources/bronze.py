"""Bronze layer: one folder of gzip JSON lines per landed batch."""

from __future__ import annotations

import re
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.columns import moment

# Fixed value: a batch folder is <root>/bronze/<prefix>/YYYY/MM/DD/HHMMSS.
BATCH = "%Y/%m/%d/%H%M%S"
FILES = "{part-*,*.jsonl,*.jsonl.gz}"
LANDED = r"^(.*/bronze/([^/]+)/(\d{4}/\d{2}/\d{2}/\d{6})(?:\.jsonl(?:\.gz)?)?)(?:/part-[^/]+)?$"


def batch_path(root: str, prefix: str, at: datetime) -> str:
    return f"{root.rstrip('/')}/bronze/{prefix}/{at.astimezone(timezone.utc).strftime(BATCH)}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of the store it lies in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def committed(spark: SparkSession, batch: str) -> bool:
    """Whether a batch has landed whole: a folder by Spark's mark in it, a single file as it is."""
    return batch.endswith((".jsonl", ".jsonl.gz")) or path_exists(spark, f"{batch}/_SUCCESS")


def write_bronze(
    df: DataFrame, root: str, prefix: str, at: datetime | None = None, rows_per_file: int = 1_000_000
) -> dict:
    """Land a batch and return its summary with ``path``. NULL fields are written out.

    Gzip cannot be split on reading, so files are kept to ``rows_per_file`` rows. A batch that has landed whole is never
    replaced, that is an error; what a failed job left of one is.
    """
    path = batch_path(root, prefix, at or datetime.now(timezone.utc))
    mode = "errorifexists" if committed(df.sparkSession, path) else "overwrite"
    counted = Observation()
    (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.option("compression", "gzip")
        .option("ignoreNullFields", "false")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("maxRecordsPerFile", rows_per_file)
        .mode(mode)
        .json(path)
    )
    return {"path": path, "rows_written": counted.get["rows"], "columns": df.columns}


def read_bronze(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A landed batch, a single file, a glob of either, or a list of these; gzip is recognised by suffix.

    Blank lines are skipped. A line that does not fit the schema is an error.
    """
    if not isinstance(path, str) and not (isinstance(path, list) and path and all(isinstance(p, str) for p in path)):
        raise TypeError(f"a path text is needed, not {type(path).__name__}: {path!r}")
    return spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", "true").json(path)


def explore_json(spark: SparkSession, path: str, sampling: float = 1.0) -> DataFrame:
    """JSON lines with inferred types, for looking around. Pipelines state their schema."""
    return spark.read.option("samplingRatio", sampling).option("recursiveFileLookup", "true").json(path)


def merged_schema(bodies: DataFrame, body: str = "body") -> str:
    """One schema for all JSON texts of a batch, as Spark writes it: a value of several types is a VARIANT there.

    Merged where the texts are; texts that are no JSON have no say.
    """
    return bodies.agg(F.schema_of_variant_agg(F.try_parse_json(body)).alias("schema")).first()["schema"]


def value_types(bodies: DataFrame, body: str = "body", depth: int = 8) -> DataFrame:
    """(path, kind, rows): every path in the JSON texts of a batch, and how often it has a value of each kind.

    ``$`` is the text itself, ``.name`` a field and ``[]`` any element. A path with several kinds but ``VOID`` is a
    conflict that an explicit schema must decide. What is nested deeper than ``depth`` counts as its outermost part. Each
    level is counted where it is before anything is shuffled.
    """
    level = bodies.select(F.lit("$").alias("path"), F.try_parse_json(body).alias("held")).where("held is not null")
    levels = [level]
    for _ in range(depth):
        inner = level.lateralJoin(level.sparkSession.tvf.variant_explode(F.col("held").outer()))
        element = F.when(F.col("key").isNull(), F.lit("[]")).otherwise(F.concat(F.lit("."), F.col("key")))
        level = inner.select(F.concat("path", element).alias("path"), F.col("value").alias("held"))
        levels.append(level)
    kind = F.regexp_extract(F.schema_of_variant("held"), r"^\w+", 0)
    counted = [one.groupBy("path", kind.alias("kind")).agg(F.count(F.lit(1)).alias("rows")) for one in levels]
    return reduce(DataFrame.union, counted)


def landed_batches(spark: SparkSession, root: str, prefix: str = "*") -> DataFrame:
    """All landed batches: ``prefix``, path ``batch``, and landing time ``landed_at`` (UTC clock).

    A batch is a folder that ``write_bronze`` made, or a single file HHMMSS.jsonl or HHMMSS.jsonl.gz. Only paths are
    listed; a folder counts by any of its files. A prefix under which nothing ever landed has no batches.
    """
    base = f"{root.rstrip('/')}/bronze"
    if not path_exists(spark, base if "*" in prefix else f"{base}/{prefix}"):
        return spark.createDataFrame([], "prefix string, batch string, landed_at timestamp_ntz")
    paths = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", FILES)
        .load(f"{base}/{prefix}")
        .select("path")
    )
    stamp = F.regexp_extract("path", LANDED, 3)
    return paths.where(F.col("path").rlike(LANDED)).select(
        F.regexp_extract("path", LANDED, 2).alias("prefix"),
        F.regexp_extract("path", LANDED, 1).alias("batch"),
        F.to_timestamp_ntz(stamp, F.lit("yyyy/MM/dd/HHmmss")).alias("landed_at"),
    ).distinct()


def latest_bronze(spark: SparkSession, root: str, prefix: str, run_at: datetime | None = None) -> str | None:
    """Newest batch that landed whole at or before a run; None if there is none.

    The one path is all that comes back, as a hand-over to the next step.
    """
    batches = landed_batches(spark, root, prefix)
    if run_at is not None:
        batches = batches.where(F.col("landed_at") <= moment(run_at, T.TimestampNTZType()))
    while row := batches.agg(F.max_by(F.struct("batch", "landed_at"), "landed_at").alias("b")).first()["b"]:
        if committed(spark, row["batch"]):
            return row["batch"]
        batches = batches.where(F.col("landed_at") < F.lit(row["landed_at"]))
    return None


def batch_time(path: str) -> datetime:
    """When a batch folder was landed."""
    found = re.search(r"(\d{4}/\d{2}/\d{2}/\d{6})", path)
    if not found:
        raise ValueError(f"not a batch folder: {path}")
    return datetime.strptime(found.group(1), BATCH).replace(tzinfo=timezone.utc)
