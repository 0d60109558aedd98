"""Explicit schemas of the pipeline tables, and repairs for schemas that were inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


LONG, TEXT, FLAG, TIME = T.LongType(), T.StringType(), T.BooleanType(), T.TimestampType()

# Field names and types of the payloads and tables.
PARK = struct(
    id=LONG, name=TEXT, country=TEXT, continent=TEXT, latitude=TEXT, longitude=TEXT, timezone=TEXT
)
DESTINATION_BRONZE = struct(id=LONG, name=TEXT, parks=T.ArrayType(PARK), ingest_timestamp=TEXT)
DESTINATION_SILVER = struct(id=LONG, name=TEXT, ingest_timestamp=TEXT)
PARK_SILVER = T.StructType([*struct(destination_id=LONG, destination_name=TEXT), *PARK])

# wait_time stays a variant until it is made whole: sources send 5, 5.0 and "5".
RIDE = struct(id=LONG, name=TEXT, is_open=FLAG, wait_time=T.VariantType(), last_updated=TEXT)
LAND = struct(id=LONG, name=TEXT, rides=T.ArrayType(RIDE))
PAYLOAD_BODY = struct(lands=T.ArrayType(LAND), rides=T.ArrayType(RIDE))
PAYLOAD = struct(park_id=LONG, body=TEXT, error=TEXT)

ENTITY = struct(
    park_id=LONG, land_id=LONG, land_name=TEXT, id=LONG, name=TEXT, entityType=TEXT, ingest_timestamp=TEXT
)
LIVE_BRONZE = struct(
    park_id=LONG, land_id=LONG, land_name=TEXT, id=LONG, name=TEXT, entityType=TEXT, is_open=FLAG, status=TEXT,
    wait_time=LONG, last_updated=TEXT, ingest_timestamp=TEXT,
)
# As LIVE_BRONZE, for reading files: a wait may be 5, 5.0 or "5", and an entityType that is
# absent differs from one that is null.
LIVE_FILE = T.StructType(
    [T.StructField(f.name, T.VariantType()) if f.name in ("wait_time", "entityType") else f for f in LIVE_BRONZE]
)
LIVE_SILVER = struct(
    park_id=LONG, land_id=LONG, land_name=TEXT, id=LONG, name=TEXT, entityType=TEXT, is_open=FLAG, status=TEXT,
    wait_time=LONG, last_updated=TIME, ingest_timestamp=TIME,
)

QUEUE = struct(
    STANDBY=struct(waitTime=LONG),
    SINGLE_RIDER=struct(waitTime=LONG),
    PAID_STANDBY=struct(waitTime=LONG),
    RETURN_TIME=struct(state=TEXT, returnStart=TEXT, returnEnd=TEXT),
    BOARDING_GROUP=struct(
        estimatedWait=TEXT, currentGroupStart=TEXT, currentGroupEnd=TEXT, allocationStatus=TEXT,
        nextAllocationTime=TEXT,
    ),
)


def _concrete(kind: T.DataType) -> T.DataType:
    """The same type with every void inside it turned into string."""
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _concrete(f.dataType), f.nullable, f.metadata) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_concrete(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(_concrete(kind.keyType), _concrete(kind.valueType), kind.valueContainsNull)
    return kind


def void_to_string(df: DataFrame) -> DataFrame:
    """Give columns whose every value was NULL a type that a table can hold, at any depth."""
    wanted = _concrete(df.schema)
    changed = {f.name: F.col(f"`{f.name}`").cast(f.dataType) for f in wanted if f.dataType != df.schema[f.name].dataType}
    return df.withColumns(changed) if changed else df


#: Whole numbers by width, with the digits that each can have; and what a whole number fits into without loss.
WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
EXACT_IN = {T.FloatType(): 5, T.DoubleType(): 10}


def common_type(one: T.DataType, two: T.DataType) -> T.DataType | None:
    """The smallest type that holds every value of both without loss, at any depth; None if there is none.

    Whole numbers widen, float widens to double, decimals to digits enough before and after the point. Structs
    have the fields of both, the first one's first.
    """
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        kinds = {f.name: common_type(f.dataType, two[f.name].dataType) if f.name in two.names else f.dataType for f in one}
        kinds |= {f.name: f.dataType for f in two if f.name not in kinds}
        return None if None in kinds.values() else struct(**kinds)
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        element = common_type(one.elementType, two.elementType)
        return element and T.ArrayType(element)
    if isinstance(one, T.MapType) and isinstance(two, T.MapType) and one.keyType == two.keyType:
        value = common_type(one.valueType, two.valueType)
        return value and T.MapType(one.keyType, value)
    if one in WHOLE and two in WHOLE:
        return max(one, two, key=WHOLE.__getitem__)
    if {type(one), type(two)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    for whole, other in ((one, two), (two, one)):
        if whole in WHOLE and other in EXACT_IN:
            return other if WHOLE[whole] <= EXACT_IN[other] else T.DoubleType() if WHOLE[whole] <= 10 else None
    if all(k in WHOLE or isinstance(k, T.DecimalType) for k in (one, two)):
        digits = [(WHOLE[k], 0) if k in WHOLE else (k.precision - k.scale, k.scale) for k in (one, two)]
        before, after = (max(d) for d in zip(*digits, strict=True))
        return T.DecimalType(before + after, after) if before + after <= 38 else None
    return None


def fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in a type that ``common_type`` gave: fields by name, those that it lacks NULL."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = [
            (fitted(value[f.name], have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(value.isNotNull(), F.struct(*fields)).cast(want)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: fitted(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, x: fitted(x, have.valueType, want.valueType))
    return value.cast(want)


def cast_timestamps(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Turn the named columns into UTC timestamps. Names the data lacks are skipped."""
    from tidemark.functions.columns import parse_iso

    casts = {}
    for name in names:
        if name not in df.columns:
            continue
        kind = df.schema[name].dataType
        if isinstance(kind, (T.StringType, T.NullType)):
            casts[name] = parse_iso(F.col(name).cast("string"))
        elif not isinstance(kind, T.TimestampType):
            casts[name] = F.col(name).cast("timestamp")
    return df.withColumns(casts) if casts else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order: unknown fields go, missing ones become NULL."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )
