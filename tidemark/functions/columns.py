"""Column expressions. All are built in Spark functions, and none depends on the session's
time zone or ANSI setting."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed value: a text time that states its own zone ends in Z or in an offset.
OFFSET = r"[+-]\d{2}:?\d{2}$"


def status_from_flag(is_open: Column) -> Column:
    """An unknown flag counts as closed."""
    return F.when(is_open, F.lit("OPERATING")).otherwise(F.lit("CLOSED"))


def _or_raise(value: Column, source: Column, what: str) -> Column:
    """``value``, or an error where ``source`` had something that did not convert."""
    problem = F.raise_error(F.concat(F.lit(f"not {what}: "), source.cast("string")))
    return F.coalesce(value, F.when(source.isNotNull(), problem))


def _variant_number(value: Column) -> Column:
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "bigint")
    return F.when(F.schema_of_variant(value) == "STRING", F.trim(text).try_cast("bigint")).otherwise(number)


def no_whole_number(value: Column) -> Column:
    """True where a variant holds something that ``whole_number`` refuses."""
    return value.isNotNull() & ~F.is_variant_null(value) & _variant_number(value).isNull()


def whole_number(value: Column, kind: T.DataType) -> Column:
    """NULL stays NULL, fractions are cut off, integer text is read, anything else is an error."""
    if isinstance(kind, T.VariantType):
        shown = F.when(~F.is_variant_null(value), F.to_json(value))
        return _or_raise(_variant_number(value), shown, "a whole number")
    if isinstance(kind, T.StringType):
        return _or_raise(F.trim(value).try_cast("bigint"), value, "a whole number")
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    return _or_raise(value.try_cast("bigint"), value, "a whole number")


def _spelled_out(text: Column) -> Column:
    """Times in basic form, without a time of day, seconds or minutes, with an offset in hours or without a zone, in the
    full form. The text is in this expression once, so that the code made of it stays small."""
    for pattern, full in (
        (r"^(\d{4})(\d\d)(\d\d)(?!\d)", "$1-$2-$3"),
        (r"^(.{10}[T ]\d\d)(\d\d)", "$1:$2"),
        (r"^(.{10}[T ]\d\d:\d\d)(\d\d)", "$1:$2"),
        (r"^(.{10}[T ]\d\d)(?=$|[Z+-])", "$1:00"),
        (r"^(.{10}[T ]\d\d:\d\d)(?=$|[Z+-])", "$1:00"),
        (r"^(.{10}[T ].*[+-]\d\d)$", "$1:00"),
        (r"^(.{10})\z", "$1T00:00:00Z"),
        (r"(?<!Z)(?<![+-]\d\d:?\d\d)\z", "Z"),
    ):
        text = F.regexp_replace(text, pattern, full)
    return text


def try_parse_iso(text: Column) -> Column:
    """ISO 8601 text to an instant, or NULL. Text without a zone is read as UTC."""

    zoned = (
        F.when(text.endswith("Z"), text)
        .when(F.length(text) == len("2026-03-03"), F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike(OFFSET), text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    # The rarer forms are looked at only where the usual one does not fit.
    return F.coalesce(zoned.try_cast("timestamp"), _spelled_out(text).try_cast("timestamp"))


def parse_iso(text: Column) -> Column:
    """As ``try_parse_iso``, but text that is no time is an error."""
    return _or_raise(try_parse_iso(text), text, "an ISO time")


def utc_clock(instant: Column) -> Column:
    """What a UTC clock showed at an instant, as a time without zone."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), start)


def utc_date(df: DataFrame, name: str) -> Column:
    """The UTC date of a time column, with or without zone."""
    zoned = isinstance(df.schema[name].dataType, T.TimestampType)
    return (utc_clock(F.col(name)) if zoned else F.col(name)).cast("date")


def moment(at: datetime, kind: T.DataType) -> Column:
    """A literal to compare with a time column of either type. A naive ``at`` is UTC."""
    aware = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(aware.astimezone(timezone.utc).replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")
    return F.lit(aware.isoformat()).cast("timestamp")


def clock_text(clock: Column) -> Column:
    """A time without zone as ``YYYY-MM-DDTHH:MM:SS[.ffffff]Z``."""
    return F.concat(F.translate(clock.cast("string"), " ", "T"), F.lit("Z"))


def iso_text(instant: Column) -> Column:
    """An instant as ISO 8601 text in UTC."""
    return clock_text(utc_clock(instant))


def landing_path(prefix: Column, clock: Column, root: str = "bronze", suffix: str = ".jsonl.gz") -> Column:
    """``root/prefix/YYYY/MM/DD/HHMMSS`` for a time without zone."""
    text = clock.cast("string")
    day = F.translate(text.substr(1, 10), "-", "/")
    time = F.translate(text.substr(12, 8), ":", "")
    return F.concat(F.lit(f"{root}/"), prefix, F.lit("/"), day, F.lit("/"), time, F.lit(suffix))


def default_if_absent(json: Column, key: str, default: str) -> Column:
    """The key's text; the default only where the object lacks the key. A null value stays NULL."""
    absent = ~F.coalesce(F.array_contains(F.json_object_keys(json), key), F.lit(True))
    return F.when(absent, F.lit(default)).otherwise(F.get_json_object(json, f"$.{key}"))


def text_or_default(value: Column, default: str) -> Column:
    """A variant's text; the default only where its key was absent. A null value stays NULL."""
    return F.when(value.isNull(), F.lit(default)).otherwise(F.try_variant_get(value, "$", "string"))


def json_message(columns: Iterable[str]) -> Column:
    """The columns as one JSON object text. NULL fields are kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def has_value(df: DataFrame, name: str) -> Column:
    """True unless the column is NULL, zero, false or the empty text."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.StringType):
        return column.isNotNull() & (column != "")
    if isinstance(kind, T.BooleanType):
        return column.isNotNull() & column
    return column.isNotNull() & (column != 0)


# Flat column name and its place in the nested queue.
QUEUE_COLUMNS = {
    "queue_standby_wait": "STANDBY.waitTime",
    "queue_single_rider_wait": "SINGLE_RIDER.waitTime",
    "queue_paid_standby_wait": "PAID_STANDBY.waitTime",
    "queue_return_time_state": "RETURN_TIME.state",
    "queue_return_time_start": "RETURN_TIME.returnStart",
    "queue_return_time_end": "RETURN_TIME.returnEnd",
    "queue_boarding_group_wait": "BOARDING_GROUP.estimatedWait",
    "queue_boarding_group_start": "BOARDING_GROUP.currentGroupStart",
    "queue_boarding_group_end": "BOARDING_GROUP.currentGroupEnd",
    "queue_boarding_group_status": "BOARDING_GROUP.allocationStatus",
    "queue_boarding_group_next_alloc": "BOARDING_GROUP.nextAllocationTime",
}
