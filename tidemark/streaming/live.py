"""The live path as two streams.

``bronze_to_silver`` appends; the checkpoint keeps track of files, so each lands once.
``silver_to_gold`` holds one row per entity as state and passes on only the entities that an
epoch touched; gold is dealt in buckets by key, and only their buckets are written again. Which
row wins is decided by its time, not by when it came, so late rows need no watermark and the
state is bounded by the number of entities.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions.columns import utc_date
from tidemark.functions.schemas import LIVE_FILE
from tidemark.operators.flatten import normalize_live
from tidemark.operators.latest import latest
from tidemark.sources.bronze import path_exists
from tidemark.sources.tables import ensure_namespace, point_table, rebalanced, table_exists

#: Column and folder of a gold bucket, and how many there are if not told otherwise.
BUCKET, BUCKETS = "gold_bucket", 64


def _triggered(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def bronze_stream(spark: SparkSession, path: str, schema: T.StructType = LIVE_FILE, max_files: int | None = None) -> DataFrame:
    """Landed batches as a stream, oldest first. A line that does not fit the schema is an error."""
    reader = (
        spark.readStream.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", "true")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def bronze_to_silver(
    source: DataFrame,
    silver_path: str,
    checkpoint: str,
    every: str | None = None,
    normalize: Callable[[DataFrame], DataFrame] = normalize_live,
    time_column: str = "ingest_timestamp",
    table: str | None = None,
) -> StreamingQuery:
    """Normalise and append, in folders per ingest date. Without ``every`` it runs until caught up.

    With ``table``, ``namespace.table``, the folder is that of a table of the catalog, which is made if there is none and is
    told of the days that came when a batch is done.

    The rows of every batch are observed as ``silver``: how many, and how many lack a time.
    """
    rows = normalize(source)
    rows = rows.observe(
        "silver", F.count(F.lit(1)).alias("rows"), F.count_if(F.col(time_column).isNull()).alias("without_time")
    )
    rows = rows.withColumn("ingest_date", utc_date(rows, time_column))
    if table:
        return _triggered(_into_table(rows, table, silver_path, checkpoint), every).start()
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy("ingest_date")
        .option("path", silver_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _triggered(writer, every).start()


def _into_table(rows: DataFrame, table: str, path: str, checkpoint: str):
    """A writer that puts each batch into folders ``ingest_date/batch`` of a table.

    A batch's own folders are replaced where it is tried again, so its rows are there once.
    """
    spark = rows.sparkSession
    namespace = table.split(".")[0]

    def add(batch: DataFrame, epoch: int) -> None:
        ensure_namespace(spark, namespace)
        numbered = batch.withColumn("batch", F.lit(epoch).cast("bigint"))
        rebalanced(numbered, ["ingest_date"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "ingest_date", "batch"
        ).parquet(path)
        if not table_exists(spark, table):
            point_table(spark, table, path, numbered.schema, ["ingest_date", "batch"])
        spark.sql(f"MSCK REPAIR TABLE {table}")

    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add)


def gold_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_into_gold(
    changes: DataFrame,
    gold_path: str,
    aside: str,
    epoch: int,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> list[int]:
    """Put an epoch's rows into gold and return the buckets that were written; no others are read.

    The new content of these buckets is first written to ``aside``, as a whole, and then takes their place. A retried
    epoch finds it there and only does the second part again, so a run that died between the two loses nothing.
    Two places there are used in turn.
    """
    spark = changes.sparkSession
    aside = f"{aside.rstrip('/')}/{epoch % 2}"
    gold_schema = T.StructType([*changes.schema, T.StructField(BUCKET, T.IntegerType())])
    staged_schema = T.StructType([*gold_schema, T.StructField("_epoch", T.LongType())])
    done = path_exists(spark, f"{aside}/_SUCCESS")
    done = done and bool(spark.read.schema(staged_schema).parquet(aside).where(F.col("_epoch") == epoch).take(1))
    if not done:
        new = f"{aside}.changes"  # computed once, as a stream's state is stepped on by it
        changes.withColumn(BUCKET, gold_bucket(keys, buckets)).write.mode("overwrite").parquet(new)
        changed = spark.read.schema(gold_schema).parquet(new)
        touched = [r[BUCKET] for r in changed.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
        if not touched:
            return []
        rows = changed
        if path_exists(spark, gold_path):
            rows = rows.unionByName(spark.read.schema(gold_schema).parquet(gold_path).where(F.col(BUCKET).isin(touched)))
        merged = latest(rows, [BUCKET, *keys], order, ties).withColumn("_epoch", F.lit(epoch).cast("long"))
        rebalanced(merged, [BUCKET]).write.mode("overwrite").parquet(aside)
    staged = spark.read.schema(staged_schema).parquet(aside).drop("_epoch")
    rebalanced(staged, [BUCKET]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(gold_path)
    return sorted(r[BUCKET] for r in staged.select(BUCKET).distinct().collect())


def silver_to_gold(
    source: DataFrame,
    gold_path: str,
    checkpoint: str,
    keys: Sequence[str] = ("id",),
    order: Sequence[str] = ("ingest_timestamp",),
    ties: Sequence[str] = (),
    every: str | None = None,
    buckets: int = BUCKETS,
    on_commit: Callable[[int, list[int]], None] | None = None,
) -> StreamingQuery:
    """Keep one current row per key in ``gold_path``, in folders ``gold_bucket=<n>`` by a hash of the keys.

    An epoch costs the new rows and the buckets of the keys that they touch. A restart without new rows writes none.
    One checkpoint belongs to one ``gold_path``, and ``buckets`` to both: choose it for the final number of entities.
    ``on_commit`` gets the epoch and the buckets after each complete write, for instance to tell a table of new folders.
    """

    def commit(changes: DataFrame, epoch: int) -> None:
        touched = merge_into_gold(changes, gold_path, f"{checkpoint.rstrip('/')}/gold", epoch, keys, order, ties, buckets)
        if touched and on_commit:
            on_commit(epoch, touched)

    writer = (
        latest(source, keys, order, ties)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(commit)
    )
    return _triggered(writer, every).start()


def read_gold(spark: SparkSession, gold_path: str, schema: T.StructType) -> DataFrame:
    """Current state; no rows before the first."""
    bucket = T.StructField(BUCKET, T.IntegerType())
    try:
        return spark.read.schema(T.StructType([*schema, bucket])).parquet(gold_path).drop(BUCKET)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
