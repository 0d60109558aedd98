"""Silver and gold tables: parquet in the session catalog.

Every full write goes to a new folder ``<root>/<namespace>.db/<table>/version=<n>``; the
table is pointed at it only when the write is complete. A lost executor or a failed job
leaves readers on the old version, a table may be rewritten from itself, and the versions
that remain on disk can be listed and read: what their files tell is all that is known of them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.columns import moment
from tidemark.functions.schemas import LONG, TEXT, TIME, cast_timestamps, common_type, fitted, struct, void_to_string

MODES = ("append", "overwrite")
DRIFT = ("fail", "merge", "recreate")


class Drift(NamedTuple):
    added: list[str]
    removed: list[str]
    changed: list[str]

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.changed)


def column_drift(existing: T.StructType, incoming: T.StructType) -> Drift:
    """Columns that came, went, or changed type. Order does not count."""
    old = {f.name: f.dataType.simpleString() for f in existing}
    new = {f.name: f.dataType.simpleString() for f in incoming}
    return Drift(
        sorted(new.keys() - old.keys()),
        sorted(old.keys() - new.keys()),
        sorted(c for c in old.keys() & new.keys() if old[c] != new[c]),
    )


def list_tables(spark: SparkSession) -> list[tuple[str, str]]:
    """All (namespace, table) pairs the catalog knows."""
    return [
        (db.name, table.name)
        for db in spark.catalog.listDatabases()
        for table in spark.catalog.listTables(db.name)
        if not table.isTemporary
    ]


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_namespace(spark: SparkSession, namespace: str, root: str | None = None) -> None:
    place = f" LOCATION '{root.rstrip('/')}/{namespace}.db'" if root else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`{place}")


def read_table(
    spark: SparkSession, name: str, where: str = "", limit: int | None = None, args: dict | None = None
) -> DataFrame:
    """A table or view, optionally cut by a predicate text and a row limit; a limit of None or 0 means all rows.

    The text may have markers such as ``:least``, whose values come from ``args``: a value is never read as SQL.
    """
    text = "SELECT * FROM IDENTIFIER(:the_table)" + (f" WHERE {where}" if where else "") + (" LIMIT :the_limit" if limit else "")
    bound = {"the_table": name} | ({"the_limit": limit} if limit else {})
    return spark.sql(text, args=bound | (args or {}))


def table_location(spark: SparkSession, name: str) -> str:
    """Where a table's files are: from its details, which come after its columns."""
    lines = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").collect()]
    details = lines[[line[0] for line in lines].index("# Detailed Table Information") :]
    return dict(details)["Location"]


def _versioned(spark: SparkSession, name: str) -> tuple[str, int]:
    """Base folder of a table's versions, and the version it reads: 0 for a table that was made elsewhere."""
    base, _, version = table_location(spark, name).partition("/version=")
    return base, int(version or 0)


# What Spark's file names and folders tell: the number of a full write, and the job that wrote a file.
VERSION, JOB = r"/version=(\d+)/", r"^part-\d+-([0-9a-f-]{36})"


def table_history(spark: SparkSession, name: str) -> DataFrame:
    """All writes to a table whose files remain: snapshot, version folder, operation, rows and time.

    They are read from the files themselves: a full write has a folder of its own, and all files of one job have its
    number in their names and the times at which they were written. A write that brought no rows is none.
    """
    # Only the files' hidden columns are read, and of the rows just how many there are.
    files = spark.read.schema("version bigint").parquet(_versioned(spark, name)[0])
    writes = files.groupBy(
        F.coalesce(F.regexp_extract("_metadata.file_path", VERSION, 1).try_cast("bigint"), F.lit(0)).alias("version"),
        F.regexp_extract("_metadata.file_name", JOB, 1).alias("job"),
    ).agg(F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_modification_time").alias("committed_at"))
    # One row for each write from here on.
    first = writes.groupBy("version").agg(F.min(F.struct("committed_at", "job")).alias("first"))
    oldest = writes.agg(F.min("version")).scalar()
    is_first = F.col("first.job") == F.col("job")
    return writes.join(first, "version").select(
        "version",
        F.when(is_first & (F.col("version") > oldest), "overwrite").otherwise("append").alias("operation"),
        "rows",
        "committed_at",
        F.when(is_first, F.col("version")).otherwise(F.unix_micros("committed_at")).alias("snapshot_id"),
    )


def table_versions(spark: SparkSession, name: str) -> DataFrame:
    """The full writes of a table, with the rows that they and the appends to them brought."""
    return table_history(spark, name).groupBy("version").agg(F.sum("rows").alias("rows"))


def snapshot_log(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """The writes to all of the tables that exist, as the input of a retention plan.

    The folder of a version may go when all of its snapshots are due and no table reads it.
    """
    columns = struct(version=LONG, operation=TEXT, rows=LONG, committed_at=TIME, snapshot_id=LONG)
    empty = spark.createDataFrame([], columns).withColumn("table", F.lit(None).cast("string"))
    logs = [table_history(spark, n).withColumn("table", F.lit(n)) for n in names if spark.catalog.tableExists(n)]
    return reduce(DataFrame.unionByName, logs, empty)


def read_version(spark: SparkSession, name: str, version: int) -> DataFrame:
    """An earlier full write and the appends to it, with the table's columns."""
    return spark.read.schema(spark.table(name).schema).parquet(f"{_versioned(spark, name)[0]}/version={version}")


def read_as_of(spark: SparkSession, name: str, at: datetime) -> DataFrame:
    """A table as it was at a moment: the newest full write that was there, and the appends up to then.

    Files are chosen by the time at which they were written, before any is opened.
    """
    limit = moment(at, T.TimestampType())
    full = table_history(spark, name).groupBy("version").agg(F.min("committed_at").alias("since"))
    version = full.where(F.col("since") <= limit).agg(F.max("version")).first()[0]
    if version is None:
        return spark.table(name).limit(0)
    rows = read_version(spark, name, version)
    return rows.where(F.col("_metadata.file_modification_time") <= limit)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "append",
    on_drift: str = "fail",
    create: bool = True,
    timestamps: Iterable[str] = (),
    partition_by: Sequence[str] = (),
    root: str | None = None,
    version: int | None = None,
    buckets: tuple[int, Sequence[str]] | None = None,
    cluster_by: Sequence[str] = (),
) -> dict:
    """Write to ``namespace.table`` and return a summary; the first write creates both.

    ``append`` adds rows and keeps history, ``overwrite`` replaces the content. Where the
    columns differ from the table's, ``on_drift`` decides: ``fail`` raises; ``merge`` widens
    the table (metadata only) and fills what is missing with NULL, also inside structs, and
    gives a column the smallest type that holds the old and the new values without loss, or
    raises; ``recreate`` starts a new version with the incoming columns, giving up the current
    content. An input without rows
    changes nothing. ``version`` numbers a full write, so that a retry replaces its own files.
    ``buckets`` (how many, by which columns) lays a full write out so that joins and groups by
    these columns read it where it is; a table keeps its buckets. ``cluster_by`` deals the rows of
    this write in ranges of these columns, sorted in each file: the statistics that Parquet keeps
    of every group of rows are then narrow, and a read for a range of them skips the others
    (numbers, texts, dates, and times with a zone stored as ``build_session`` sets it).
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, use one of {MODES}")
    if on_drift not in DRIFT:
        raise ValueError(f"unknown drift policy {on_drift!r}, use one of {DRIFT}")
    spark = df.sparkSession
    namespace, table = name.split(".")
    snapshot = version if version is not None else time.time_ns() // 1000
    rows = void_to_string(cast_timestamps(df, timestamps))

    exists = spark.catalog.tableExists(name)
    if not exists and not create:
        raise ValueError(f"table {name} does not exist; pass create=True to create it")
    drift = column_drift(spark.table(name).schema, rows.schema) if exists else Drift([], [], [])
    common = {}
    if drift.changed and on_drift == "merge":
        old = spark.table(name).schema
        common = {c: common_type(old[c].dataType, rows.schema[c].dataType) for c in drift.changed}
    if drift and (on_drift == "fail" or (on_drift == "merge" and None in common.values())):
        raise ValueError(
            f"columns of {name} differ: added={drift.added}, removed={drift.removed}, changed={drift.changed}"
        )
    rows = rows.withColumns({c: fitted(F.col(f"`{c}`"), rows.schema[c].dataType, kind) for c, kind in common.items()})
    if cluster_by:
        rows = clustered(rows, cluster_by)
    ensure_namespace(spark, namespace, root)

    if exists and mode == "append" and not (drift and on_drift == "recreate"):
        location = table_location(spark, name)
        wider = {c: kind for c, kind in common.items() if kind.simpleString() != old[c].dataType.simpleString()}
        if wider and not rows.isEmpty():
            columns = T.StructType([T.StructField(f.name, wider.get(f.name, f.dataType)) for f in old])
            point_table(spark, name, location, columns, _partition_columns(spark, name), table_buckets(spark, name))
        if drift.added and not rows.isEmpty():
            fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in drift.added)
            spark.sql(f"ALTER TABLE {_quoted(name)} ADD COLUMNS ({fields})")
        written = _append(rows, name)
    else:
        if drift and on_drift == "merge":
            rows = rows.withColumns(
                {c: F.lit(None).cast(spark.table(name).schema[c].dataType) for c in drift.removed}
            )
        if exists:
            base, _ = _versioned(spark, name)
            partition_by = partition_by or _partition_columns(spark, name)
            buckets = buckets or table_buckets(spark, name)
        else:
            base = f"{(root or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{namespace}.db/{table}"
        location = f"{base}/version={snapshot}"
        written = _write_folder(rows, location, partition_by, buckets)
        if written:
            point_table(spark, name, location, rows.schema, partition_by, buckets)

    return {
        "table": name,
        "snapshot_id": snapshot if written else None,
        "mode": mode,
        "status": "loaded" if written else "skipped",
        "reason": None if written else "no rows",
        "rows_written": written,
        "columns": rows.columns,
        "column_count": len(rows.columns),
        "added": drift.added,
        "removed": drift.removed,
        "path": location,
        "written_at": datetime.now(timezone.utc).isoformat(),
    }


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in ranges of the columns, one for each task, and sorted in it."""
    keys = [F.col(c).asc_nulls_first() for c in columns]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one folder together before a partitioned write, in files of even size.

    Adaptive execution merges small folders into one task and splits a folder that holds most
    rows over many, which a plain repartition by the same columns would not.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _write_folder(
    df: DataFrame, path: str, partition_by: Sequence[str], buckets: tuple[int, Sequence[str]] | None = None
) -> int:
    counted, seen = _counted(rebalanced(df, partition_by))
    if buckets:
        number, keys = buckets
        # Rows that already lie in these buckets, as those merged from the table do, are not moved again.
        counted, seen = _counted(df.repartition(number, *map(F.col, keys)))
        place = f"written_{uuid.uuid4().hex}"
        counted.write.mode("overwrite").format("parquet").bucketBy(number, *keys).option("path", path).saveAsTable(place)
        df.sparkSession.sql(f"DROP TABLE {place}")  # an external table: its files stay for the table that is pointed at them
        return seen.get["rows"]
    writer = counted.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def table_buckets(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """How many buckets a table has, and by which columns."""
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isBucket]
    if not keys:
        return None
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").collect()}
    return int(about["Num Buckets"]), keys


def _append(df: DataFrame, name: str) -> int:
    target = df.sparkSession.table(name).schema
    aligned = df.select(
        *[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in target]
    )
    counted, seen = _counted(rebalanced(aligned, _partition_columns(df.sparkSession, name)))
    counted.write.insertInto(name)
    return seen.get["rows"]


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def point_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    buckets: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Make the table read ``location``, a complete ``version=`` folder; create it if absent.

    Only the catalog changes. The files the table read before stay where they are. With other columns or with
    partitions the entry is made anew, and for that moment there is no table.
    """
    exists = spark.catalog.tableExists(name)
    same_buckets = exists and table_buckets(spark, name) == (buckets and (buckets[0], list(buckets[1])))
    if exists and not partition_by and same_buckets and not column_drift(spark.table(name).schema, schema):
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
        return
    if exists:
        spark.sql(f"DROP TABLE {_quoted(name)}")  # an external table: only the catalog entry goes
    data = [f for f in schema if f.name not in partition_by]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*data, *[schema[c] for c in partition_by]])
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    if buckets:
        parts += f" CLUSTERED BY ({', '.join(f'`{c}`' for c in buckets[1])}) INTO {buckets[0]} BUCKETS"
    spark.sql(f"CREATE TABLE {_quoted(name)} ({fields}) USING parquet{parts} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {_quoted(name)}")
