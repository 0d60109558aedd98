"""Nested payloads to flat rows. Every operator here is a narrow, per-row transformation."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tidemark.functions.columns import (
    QUEUE_COLUMNS,
    has_value,
    json_message,
    no_whole_number,
    parse_iso,
    status_from_flag,
    text_or_default,
    whole_number,
)
from tidemark.functions.schemas import LIVE_SILVER, PAYLOAD_BODY, QUEUE, conform


def explode_parks(destinations: DataFrame, parks: str = "parks") -> DataFrame:
    """One row per park with its destination's id and name. Parks without an id are dropped."""
    rows = destinations.select(
        F.col("id").alias("destination_id"), F.col("name").alias("destination_name"), F.inline(parks)
    )
    return rows.where(has_value(rows, "id"))


def extract_rides(payloads: DataFrame, body: str = "body") -> DataFrame:
    """One row per ride, from the rides inside lands and from those outside any land.

    ``body`` is JSON text, or the struct that ``split_outcomes`` gives. The other columns of
    ``payloads`` (its key) are kept. Missing lists give no rows, and so does text that is no
    JSON: split first, to see which payloads failed.
    """
    keep = [c for c in payloads.columns if c != body]
    is_text = isinstance(payloads.schema[body].dataType, T.StringType)
    parsed = payloads.select(*keep, (F.from_json(body, PAYLOAD_BODY) if is_text else F.col(body)).alias("_p"))

    def placed(rides: Column, land_id: Column, land_name: Column) -> Column:
        return F.transform(
            F.coalesce(rides, F.array()),
            lambda ride: F.struct(
                land_id.cast("bigint").alias("land_id"),
                land_name.cast("string").alias("land_name"),
                ride["id"].alias("id"),
                ride["name"].alias("name"),
                ride["is_open"].alias("is_open"),
                ride["wait_time"].alias("wait_time"),
                ride["last_updated"].alias("last_updated"),
            ),
        )

    lands = F.coalesce(F.col("_p.lands"), F.array())
    in_lands = F.flatten(F.transform(lands, lambda land: placed(land["rides"], land["id"], land["name"])))
    outside = placed(F.col("_p.rides"), F.lit(None), F.lit(None))
    return parsed.select(*keep, F.inline(F.concat(in_lands, outside))).withColumn(
        "wait_time", whole_number(F.col("wait_time"), T.VariantType())
    )


UNREADABLE = "body is missing or not JSON"


def outcomes(payloads: DataFrame, body: str = "body", error: str = "error") -> DataFrame:
    """Add ``success``: no error was reported and the body is JSON. A bad body gets an error text."""
    readable = F.try_parse_json(body).isNotNull()
    reported = F.col(error).isNotNull()
    return payloads.withColumns(
        {
            "success": ~reported & readable,
            error: F.when(reported, F.col(error)).when(~readable, F.lit(UNREADABLE)),
        }
    )


def misfit_waits(body: Column) -> Column:
    """Whether a ride of a parsed body, in a land or outside, has a wait that is no whole number."""

    def among(rides: Column) -> Column:
        return F.coalesce(F.exists(rides, lambda ride: no_whole_number(ride["wait_time"])), F.lit(False))

    in_lands = F.coalesce(F.exists(body["lands"], lambda land: among(land["rides"])), F.lit(False))
    return in_lands | among(body["rides"])


def _judged(payloads: DataFrame, body: str, error: str, schema: T.StructType) -> tuple[DataFrame, Column, Column]:
    """Payloads with ``_parsed``, whether each is good, and why not. Every body is parsed once."""
    misfit = T.StructField("_misfit", T.StringType())
    parsed = payloads.withColumn(
        "_parsed", F.from_json(body, T.StructType([*schema, misfit]), {"columnNameOfCorruptRecord": "_misfit"})
    )
    ok = F.col(error).isNull() & F.col("_parsed").isNotNull() & F.col("_parsed._misfit").isNull()
    if schema == PAYLOAD_BODY:
        ok = ok & ~misfit_waits(F.col("_parsed"))
    reason = (
        F.when(F.col(error).isNotNull(), F.col(error))
        .when(F.try_parse_json(body).isNull(), F.lit(UNREADABLE))
        .otherwise(F.lit("body does not fit the schema"))
    )
    return parsed, ok, reason


def split_outcomes(
    payloads: DataFrame, body: str = "body", error: str = "error", schema: T.StructType = PAYLOAD_BODY
) -> tuple[DataFrame, DataFrame]:
    """Good payloads with their body parsed, and failed ones as they came, for quarantine.

    A payload fails if an error was reported, if its body is no JSON, or if a value in it does
    not fit the schema, which would otherwise be read as NULL; a wait must be a whole number.
    Together they are all input rows. Each of the two reads and parses the payloads; where both
    are wanted, ``route_outcomes`` does that once.
    """
    keep = [c for c in payloads.columns if c not in (body, error)]
    parsed, ok, reason = _judged(payloads, body, error, schema)
    # Exploding a list of one or none keeps the rows wanted and parses each body once; a filter
    # would be moved below the parsing and repeat it.
    good = parsed.select(
        *keep, F.explode(F.when(ok, F.array(F.col("_parsed").dropFields("_misfit")))).alias(body)
    )
    failed = parsed.select(*keep, F.inline(F.when(~ok, F.array(F.struct(F.col(body), reason.alias(error))))))
    return good, failed


#: Folders of the two outcomes.
OUTCOME, GOOD, FAILED = "outcome", "good", "failed"


class Routed(NamedTuple):
    """Both outcomes of payloads that were read and parsed once, and how many there were of each."""

    good: DataFrame
    failed: DataFrame
    attempts: int
    failures: int


def route_outcomes(
    payloads: DataFrame, path: str, body: str = "body", error: str = "error", schema: T.StructType = PAYLOAD_BODY
) -> Routed:
    """As ``split_outcomes``, by one write to ``path`` in a folder for each outcome, which both are read from.

    Payloads may be what a slow or changing source gives: whatever they were when they were read is what both
    outcomes and the counts tell.
    """
    rows, seen = _by_outcome(payloads, body, error, schema), Observation()
    counted = rows.observe(
        seen, F.count(F.lit(1)).alias("attempts"), F.count_if(F.col(OUTCOME) == FAILED).alias("failures")
    )
    counted.write.partitionBy(OUTCOME).parquet(path)
    routed = payloads.sparkSession.read.schema(rows.schema).parquet(path)
    keep = [F.col(f"row.`{c}`") for c in payloads.columns if c not in (body, error)]
    good = routed.where(F.col(OUTCOME) == GOOD).select(*keep, F.col("row._parsed").alias(body))
    failed = routed.where(F.col(OUTCOME) == FAILED).select(*keep, F.col(f"row.`{body}`"), F.col(f"row.`{error}`"))
    return Routed(good, failed, seen.get["attempts"], seen.get["failures"])


def _by_outcome(payloads: DataFrame, body: str, error: str, schema: T.StructType) -> DataFrame:
    """(outcome, row): a good payload's row has what was parsed, a failed one's the body as it came and why it failed."""
    parsed, ok, reason = _judged(payloads, body, error, schema)
    return parsed.select(
        F.when(ok, GOOD).otherwise(FAILED).alias(OUTCOME),
        F.struct(
            *[F.col(f"`{c}`") for c in payloads.columns if c not in (body, error)],
            F.when(ok, F.col("_parsed").dropFields("_misfit")).alias("_parsed"),
            F.when(~ok, F.col(body)).alias(body),
            F.when(~ok, reason).alias(error),
        ).alias("row"),
    )


def entity_rows(rides: DataFrame, ingest_timestamp: str, entity_type: str = "ATTRACTION") -> DataFrame:
    """Catalogue rows of rides, all stamped with the one time of their batch."""
    return rides.select(
        "park_id", "land_id", "land_name", "id", "name",
        F.lit(entity_type).alias("entityType"),
        F.lit(ingest_timestamp).alias("ingest_timestamp"),
    )


def live_rows(rides: DataFrame, ingest_timestamp: str | Column, entity_type: str = "ATTRACTION") -> DataFrame:
    """Observations of rides: status from the open flag, one ingest time per batch."""
    stamp = ingest_timestamp if isinstance(ingest_timestamp, Column) else F.lit(ingest_timestamp)
    return rides.select(
        "park_id", "land_id", "land_name", "id", "name",
        F.lit(entity_type).alias("entityType"),
        "is_open",
        status_from_flag(F.col("is_open")).alias("status"),
        "wait_time", "last_updated",
        stamp.alias("ingest_timestamp"),
    )


def normalize_live(bronze: DataFrame, entity_type: str = "ATTRACTION") -> DataFrame:
    """Bronze observations to the silver schema: whole waits, UTC timestamps, fixed columns.

    Accepts any subset of the columns; numbers may be text or variants, times may be text. An
    entity type that is absent gets the default, one that is null stays NULL.
    """
    casts = {}
    if "entityType" not in bronze.columns:
        casts["entityType"] = F.lit(entity_type)
    elif isinstance(bronze.schema["entityType"].dataType, T.VariantType):
        casts["entityType"] = text_or_default(F.col("entityType"), entity_type)
    for field in LIVE_SILVER:
        if field.name not in bronze.columns:
            continue
        kind = bronze.schema[field.name].dataType
        if field.dataType == T.LongType():
            casts[field.name] = whole_number(F.col(field.name), kind)
        elif field.dataType == T.TimestampType() and isinstance(kind, T.StringType):
            casts[field.name] = parse_iso(F.col(field.name))
    return conform(bronze.withColumns(casts) if casts else bronze, LIVE_SILVER)


def flatten_queue(df: DataFrame, queue: str = "queue") -> DataFrame:
    """Replace the nested queue (struct or JSON text) by its flat columns; absent parts are NULL."""
    if isinstance(df.schema[queue].dataType, T.StringType):
        df = df.withColumn(queue, F.from_json(queue, QUEUE))
    flat = {name: F.col(f"{queue}.{path}") for name, path in QUEUE_COLUMNS.items()}
    return df.withColumns(flat).drop(queue)


def payload_records(df: DataFrame, body: str = "body") -> DataFrame:
    """The record objects of a JSON body of any of the accepted shapes, as variant ``record``.

    An object holds them under ``destinations``; a list holds them itself; in a list of lists
    they are in the first one. Entries that are no objects are dropped, other bodies give none.
    """
    keep = [c for c in df.columns if c != body]
    parsed = df.select(*keep, F.try_parse_json(body).alias("_v"))
    shape = F.schema_of_variant("_v")

    def part(path: str) -> Column:
        return F.try_variant_get("_v", path, "array<variant>")

    records = (
        F.when(shape.startswith("OBJECT"), part("$.destinations"))
        .when(F.schema_of_variant(F.try_variant_get("_v", "$[0]", "variant")).startswith("ARRAY"), part("$[0]"))
        .otherwise(part("$"))
    )
    rows = parsed.select(*keep, F.explode(records).alias("record"))
    return rows.where(F.schema_of_variant("record").startswith("OBJECT"))


def to_messages(df: DataFrame) -> DataFrame:
    """Each row as one JSON text in ``value``, the form a message sink takes."""
    return df.select(json_message(df.columns).alias("value"))
