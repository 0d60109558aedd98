from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions import columns as C
from tidemark.functions import schemas as S

UTC = timezone.utc


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_status_counts_unknown_as_closed(spark, settings, ansi):
    settings(spark__sql__ansi__enabled=ansi)
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert [r[0] for r in df.select(C.status_from_flag(F.col("f"))).collect()] == ["OPERATING", "CLOSED", "CLOSED"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_whole_number(spark, settings, ansi):
    settings(spark__sql__ansi__enabled=ansi)

    def whole(values, kind):
        df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", kind)]))
        return [r[0] for r in df.select(C.whole_number(F.col("x"), kind)).collect()]

    assert whole([3.7, -3.7, None], T.DoubleType()) == [3, -3, None]
    assert whole([5, None], T.LongType()) == [5, None]
    for bad in (float("nan"), 1e30):
        with pytest.raises(Exception, match="not a whole number"):
            whole([bad], T.DoubleType())
    assert whole(["42", " 7 ", "-1", None], T.StringType()) == [42, 7, -1, None]
    for bad in ("3.7", "abc", ""):
        with pytest.raises(Exception, match="not a whole number"):
            whole([bad], T.StringType())


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_whole_number_of_variants(spark, settings, ansi):
    settings(spark__sql__ansi__enabled=ansi)

    def whole(*values):
        df = spark.createDataFrame([(v,) for v in values], "j string")
        parsed = F.parse_json("j")
        return [r[0] for r in df.select(C.whole_number(parsed, T.VariantType())).collect()]

    assert whole("5", "5.0", "3.7", "-3.7", '"8"', "null", None, "1e2") == [5, 5, 3, -3, 8, None, None, 100]
    assert whole("4.99999999999", "-4.99999999999", "9007199254740993") == [4, -4, 9007199254740993]
    for bad in ('"3.7"', '"x"', "[1]", '{"a": 1}'):
        with pytest.raises(Exception, match="not a whole number"):
            whole(bad)


TIMES = {
    "2026-03-03T15:00:24.000Z": datetime(2026, 3, 3, 15, 0, 24),
    "2026-03-03T15:00:24Z": datetime(2026, 3, 3, 15, 0, 24),
    "2026-03-03T15:00:24+02:00": datetime(2026, 3, 3, 13, 0, 24),
    "2026-03-03T15:00:24.5-05:30": datetime(2026, 3, 3, 20, 30, 24, 500000),
    "2026-03-03T15:00:24.123456+00:00": datetime(2026, 3, 3, 15, 0, 24, 123456),
    "2026-03-03 15:00:24": datetime(2026, 3, 3, 15, 0, 24),
    "2026-03-03": datetime(2026, 3, 3),
    "2026-03-03T15:00:24+05": datetime(2026, 3, 3, 10, 0, 24),
    "2026-03-03T15:00": datetime(2026, 3, 3, 15, 0),
    "2026-03-03T15:00-03:00": datetime(2026, 3, 3, 18, 0),
    "2026-03-03T15Z": datetime(2026, 3, 3, 15, 0),
    "20260303T150024Z": datetime(2026, 3, 3, 15, 0, 24),
    "20260303T150024.5+0530": datetime(2026, 3, 3, 9, 30, 24, 500000),
    "20260303T1500": datetime(2026, 3, 3, 15, 0),
    "20260303": datetime(2026, 3, 3),
    # Both clock readings of an hour that New York has twice, and one it does not have.
    "2026-11-01T05:30:00Z": datetime(2026, 11, 1, 5, 30),
    "2026-11-01T06:30:00Z": datetime(2026, 11, 1, 6, 30),
    "2026-03-08T02:30:00": datetime(2026, 3, 8, 2, 30),
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_parse_iso_and_back(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    df = spark.createDataFrame([(t,) for t in TIMES] + [(None,)], "t string")
    got = df.select("t", C.utc_clock(C.parse_iso(F.col("t"))).alias("c"), C.iso_text(C.parse_iso(F.col("t"))).alias("i"))
    result = {r.t: r for r in got.collect()}
    assert {t: r.c for t, r in result.items()} == TIMES | {None: None}
    assert result["2026-03-03T15:00:24+02:00"].i == "2026-03-03T13:00:24Z"
    assert result["2026-03-03T15:00:24.5-05:30"].i == "2026-03-03T20:30:24.5Z"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_time_raises_or_is_null(spark, settings, ansi):
    settings(spark__sql__ansi__enabled=ansi)
    df = spark.createDataFrame([("soon",)], "t string")
    assert df.select(C.try_parse_iso(F.col("t"))).first()[0] is None
    with pytest.raises(Exception, match="not an ISO time"):
        df.select(C.parse_iso(F.col("t"))).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_moment_compares_the_same_in_any_zone(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    at = datetime(2026, 3, 8, 2, 30, tzinfo=UTC)
    df = spark.range(1).select(
        C.moment(at, T.TimestampNTZType()).alias("clock"), C.utc_clock(C.moment(at, T.TimestampType())).alias("instant"),
        C.moment(at.replace(tzinfo=None), T.TimestampNTZType()).alias("naive"),
    )
    assert tuple(df.first()) == (datetime(2026, 3, 8, 2, 30),) * 3


def test_default_only_where_the_key_is_absent(spark):
    bodies = ['{"a": 1}', '{"entityType": null}', '{"entityType": "SHOW"}', "{}", None, "no json"]
    df = spark.createDataFrame([(b,) for b in bodies], "j string")
    got = [r[0] for r in df.select(C.default_if_absent(F.col("j"), "entityType", "ATTRACTION")).collect()]
    assert got == ["ATTRACTION", None, "SHOW", "ATTRACTION", None, None]


def test_landing_path(spark):
    df = spark.sql("select timestamp_ntz'2026-02-19 12:03:04.5' as t")
    path = df.select(C.landing_path(F.lit("live"), F.col("t"))).first()[0]
    assert path == "bronze/live/2026/02/19/120304.jsonl.gz"


def test_json_message_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(C.json_message(df.columns)).first()[0] == '{"a":1,"b":null}'


def test_has_value(spark):
    df = spark.createDataFrame([(0, "", False), (None, None, None), (3, "0", True)], "i long, s string, b boolean")
    for name in df.columns:
        assert df.where(C.has_value(df, name)).count() == 1


def test_void_becomes_string_at_any_depth(spark):
    df = spark.sql(
        "select 1 as id, null as a, named_struct('x', null, 'y', 2) as s, array(null) as l, map('k', null) as m, "
        "array(named_struct('z', array(null))) as deep"
    )
    fixed = S.void_to_string(df)
    assert [kind for _, kind in fixed.dtypes] == [
        "int", "string", "struct<x:string,y:int>", "array<string>", "map<string,string>",
        "array<struct<z:array<string>>>",
    ]
    assert fixed.first().asDict(True) == df.first().asDict(True)
    untouched = df.select("id")
    assert S.void_to_string(untouched) is untouched


def test_void_survives_parquet_only_after_repair(spark, tmp_path):
    S.void_to_string(spark.sql("select 1 as id, null as a")).write.parquet(str(tmp_path / "t"))
    assert dict(spark.read.parquet(str(tmp_path / "t")).dtypes)["a"] == "string"


def test_cast_timestamps_skips_absent_columns(spark):
    df = spark.createDataFrame([("2026-03-03T15:00:24.5Z", 1), ("2026-03-03T15:00:24Z", 2), (None, 3)], "t string, id int")
    fixed = S.cast_timestamps(df, ["t", "nowhere"])
    assert dict(fixed.dtypes) == {"t": "timestamp", "id": "int"}
    assert [r.t is None for r in fixed.orderBy("id").collect()] == [False, False, True]
    assert S.cast_timestamps(df, ["nowhere"]) is df


def test_conform_drops_and_fills(spark):
    df = spark.createDataFrame([(1, "x", "y")], "id int, name string, extra string")
    assert S.conform(df, S.DESTINATION_SILVER).first().asDict() == {"id": 1, "name": "x", "ingest_timestamp": None}
    assert S.conform(df, S.DESTINATION_SILVER).schema.simpleString() == S.DESTINATION_SILVER.simpleString()
