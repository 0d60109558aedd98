"""What the runs of a stream did, batch by batch: a table made of Spark's own events."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions.schemas import FLAG, LONG, TEXT, struct

# A line for each batch that ended, and for each run that ended.
EVENTS = struct(at=TEXT, query=TEXT, run=TEXT, batch=LONG, rows_in=LONG, millis=LONG, observed=TEXT, ended=FLAG, error=TEXT)


class BatchLog(StreamingQueryListener):
    """Notes every batch and every end of all streams of a session, as lines under ``path``.

    Register it with ``spark.streams.addListener``. A line is a small file, written when Spark tells of the event.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ended = spark, path, set()

    def _note(self, **line) -> None:
        row = self.spark.createDataFrame([(json.dumps(line),)], "value string").coalesce(1)
        row.write.mode("append").text(self.path)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        observed = {name: row.asDict() for name, row in p.observedMetrics.items()}
        if p.numInputRows or observed:
            self._note(
                at=p.timestamp, query=str(p.id), run=str(p.runId), batch=p.batchId, rows_in=p.numInputRows,
                millis=p.batchDuration, observed=json.dumps(observed, default=str), ended=False,
            )

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._note(query=str(event.id), run=str(event.runId), ended=True, error=event.exception)
        self.ended.add(str(event.runId))

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the end of a run was noted: events come some time after what they tell of."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self.ended and time.monotonic() < until:
            time.sleep(0.05)


def batch_report(spark: SparkSession, path: str, metrics: str = "silver") -> DataFrame:
    """(query, batch, attempts, failures, rows_in, rows, without_time, millis) of the batches under ``path``.

    A run that failed did so in the batch after the last one that had ended; a batch is attempted once more than
    it failed. One that never ended has no rows. ``rows`` and ``without_time`` are what the stream observed as ``metrics``.
    """
    lines = spark.read.schema(EVENTS).json(path).withColumn("noted", F.col("_metadata.file_modification_time"))
    order = Window.partitionBy("query").orderBy("noted", "batch").rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.max("batch").over(order), F.lit(-1))
    told = lines.withColumn("batch", F.when(F.col("error").isNotNull(), done + 1).otherwise(F.col("batch")))
    seen = F.from_json("observed", f"`{metrics}` struct<rows: bigint, without_time: bigint>")[metrics]
    return (
        told.where("batch is not null")
        .groupBy("query", "batch")
        .agg(
            F.count(F.lit(1)).alias("attempts"),
            F.count("error").alias("failures"),
            F.max("rows_in").alias("rows_in"),
            F.max(seen["rows"]).alias("rows"),
            F.max(seen["without_time"]).alias("without_time"),
            F.max("millis").alias("millis"),
        )
    )
