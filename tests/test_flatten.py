import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.schemas import DESTINATION_BRONZE, LIVE_SILVER, PAYLOAD, QUEUE
from tidemark.operators import flatten as X


def ride(i, **more):
    return {"id": i, "name": f"ride {i}", "is_open": True, "wait_time": 5, "last_updated": "2026-02-19T07:31:09.250Z"} | more


BODIES = {
    1: {"lands": [{"id": 56, "name": "Adventure", "rides": [ride(134), ride(135, is_open=False)]}, {"id": 57, "name": "Bare"}], "rides": []},
    2: {"lands": [], "rides": [ride(200)]},
    3: {"lands": [{"id": 58, "name": "Both", "rides": [ride(300)]}], "rides": [ride(301, is_open=None, wait_time=None)]},
    4: {},
    5: {"rides": [ride(500, wait_time=12.9), ride(501, wait_time="7")]},
    6: {"lands": None, "rides": None},
}


def payloads(spark):
    data = [(k, json.dumps(v), None) for k, v in BODIES.items()]
    data += [(7, "<html>busy</html>", None), (8, None, "HTTP 500"), (9, None, None), (10, json.dumps(BODIES[2]), "timeout")]
    data += [(11, '{"rides": [{"id": "x1"}, {"id": 2}]}', None), (12, "[1]", None), (13, "", None), (14, "null", None)]
    return spark.createDataFrame(data, PAYLOAD)


def test_outcomes_isolate_failures(spark):
    good, failed = X.split_outcomes(payloads(spark))
    assert sorted(r.park_id for r in good.collect()) == [1, 2, 3, 4, 5, 6]
    unreadable, misfit = "body is missing or not JSON", "body does not fit the schema"
    assert {r.park_id: r.error for r in failed.collect()} == {
        7: unreadable, 8: "HTTP 500", 9: unreadable, 10: "timeout", 11: misfit, 12: misfit, 13: unreadable, 14: misfit,
    }
    assert {r.park_id: r.body for r in failed.collect()} == {r.park_id: r.body for r in payloads(spark).where("park_id > 6").collect()}


def test_rides_in_lands_and_outside(spark):
    good, _ = X.split_outcomes(payloads(spark))
    got = X.extract_rides(good)
    assert got.columns == ["park_id", "land_id", "land_name", "id", "name", "is_open", "wait_time", "last_updated"]
    rows = {r.id: r for r in got.collect()}
    assert sorted(rows) == [134, 135, 200, 300, 301, 500, 501]
    assert (rows[134].land_id, rows[134].land_name, rows[301].land_id) == (56, "Adventure", None)
    assert (rows[500].wait_time, rows[501].wait_time, rows[301].wait_time) == (12, 7, None)


def test_rides_from_text_and_from_the_parsed_body_agree(spark):
    good, _ = X.split_outcomes(payloads(spark))
    text = payloads(spark).where("park_id <= 6").drop("error")
    assert sorted(map(str, X.extract_rides(good).collect())) == sorted(map(str, X.extract_rides(text).collect()))


def test_bad_wait_times_are_set_apart_with_their_payload(spark):
    bodies = [
        {"rides": [ride(1, wait_time="long"), ride(2)]},
        {"lands": [None, {"id": 5, "rides": [ride(3, wait_time=[1])]}, {"id": 6, "rides": [ride(4)]}]},
        {"lands": [{"id": 7}, {"id": 8, "rides": [None, ride(5, wait_time="9"), ride(6, wait_time=None)]}], "rides": None},
        {"rides": [ride(7, wait_time="3.7")]},
        {"rides": [ride(8, wait_time=4.99999999999)]},
    ]
    df = spark.createDataFrame([(i, json.dumps(b), None) for i, b in enumerate(bodies)], PAYLOAD)
    good, failed = X.split_outcomes(df)
    assert {r.park_id: r.error for r in failed.collect()} == {i: "body does not fit the schema" for i in (0, 1, 3)}
    waits = {r.id: r.wait_time for r in X.extract_rides(good).where("id is not null").collect()}
    assert waits == {5: 9, 6: None, 8: 4}
    with pytest.raises(Exception, match="not a whole number"):
        X.extract_rides(df.where("park_id = 0").drop("error")).collect()


def test_live_rows_share_one_stamp_and_derive_status(spark):
    good, _ = X.split_outcomes(payloads(spark))
    live = X.live_rows(X.extract_rides(good), "2026-03-03T15:05:00+00:00")
    rows = {r.id: r for r in live.collect()}
    assert {r.ingest_timestamp for r in rows.values()} == {"2026-03-03T15:05:00+00:00"}
    assert (rows[134].status, rows[135].status, rows[301].status) == ("OPERATING", "CLOSED", "CLOSED")
    assert {r.entityType for r in rows.values()} == {"ATTRACTION"}
    silver = X.normalize_live(live)
    assert silver.schema.simpleString() == LIVE_SILVER.simpleString()
    assert silver.count() == 7


def test_normalize_live_reads_texts_and_fills_absent_columns(spark):
    df = spark.createDataFrame(
        [("12", "2026-03-03T15:00:24+02:00", "x"), (None, None, "y")], "wait_time string, last_updated string, unknown string"
    )
    out = X.normalize_live(df)
    assert out.schema.simpleString() == LIVE_SILVER.simpleString()
    assert [(r.wait_time, r.id) for r in out.orderBy("wait_time").collect()] == [(None, None), (12, None)]


def test_normalize_live_where_every_wait_is_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, wait_time string")
    assert dict(X.normalize_live(df).dtypes)["wait_time"] == "bigint"


def companies(spark):
    park = {"name": "P", "country": "US", "continent": "NA", "latitude": "1.5", "longitude": "-2", "timezone": "UTC"}
    data = [
        {"id": 1, "name": "One", "parks": [park | {"id": 11}, park | {"id": 12, "latitude": None}], "ingest_timestamp": "t"},
        {"id": 2, "name": "Empty", "parks": [], "ingest_timestamp": "t"},
        {"id": 3, "name": "None", "ingest_timestamp": "t"},
        {"id": 4, "name": "Falsy", "parks": [park | {"id": 0}, park | {"id": None}, park, park | {"id": 41}], "ingest_timestamp": "t"},
    ]
    return spark.createDataFrame(data, DESTINATION_BRONZE)


def test_explode_parks(spark):
    out = X.explode_parks(companies(spark))
    assert out.columns == [
        "destination_id", "destination_name", "id", "name", "country", "continent", "latitude", "longitude", "timezone",
    ]
    assert sorted((r.destination_id, r.destination_name, r.id, r.latitude) for r in out.collect() if r.latitude) == [
        (1, "One", 11, "1.5"), (4, "Falsy", 41, "1.5"),
    ]
    assert out.count() == 3
    assert dict(out.dtypes)["latitude"] == "string"


def test_flatten_queue_from_struct_and_text(spark):
    full = {
        "STANDBY": {"waitTime": 30}, "SINGLE_RIDER": {"waitTime": None}, "PAID_STANDBY": {"waitTime": 5},
        "RETURN_TIME": {"state": "AVAILABLE", "returnStart": "2026-03-03T15:00:00", "returnEnd": None},
        "BOARDING_GROUP": {
            "estimatedWait": "20", "currentGroupStart": "1", "currentGroupEnd": "9", "allocationStatus": "OPEN",
            "nextAllocationTime": "13:00",
        },
    }
    text = spark.createDataFrame([(1, json.dumps(full)), (2, "{}"), (3, None)], "id int, queue string")
    parsed = text.withColumn("queue", F.from_json("queue", QUEUE))
    for df in (text, parsed):
        rows = {r.id: r for r in X.flatten_queue(df).collect()}
        assert tuple(rows[1])[1:] == (30, None, 5, "AVAILABLE", "2026-03-03T15:00:00", None, "20", "1", "9", "OPEN", "13:00")
        assert tuple(rows[2])[1:] == (None,) * 11
        assert tuple(rows[3])[1:] == (None,) * 11


SHAPES = {
    "object": ('{"destinations": [{"id": 1}, 5, null, {"id": 2}]}', [1, 2]),
    "object without": ('{"other": [{"id": 1}]}', []),
    "list": ('[{"id": 3}, "x", {"id": 4}]', [3, 4]),
    "list of lists": ('[[{"id": 5}, 1], [{"id": 6}]]', [5]),
    "mixed, object first": ('[{"id": 7}, [{"id": 8}]]', [7]),
    "scalar": ("42", []),
    "text": ('"destinations"', []),
    "null": ("null", []),
    "empty list": ("[]", []),
    "missing": (None, []),
    "no json": ("{", []),
}


def test_payload_shapes(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in SHAPES.items()], "shape string, body string")
    out = X.payload_records(df).select("shape", F.variant_get("record", "$.id", "int").alias("id"))
    got = {}
    for r in out.collect():
        got.setdefault(r.shape, []).append(r.id)
    assert {k: sorted(v) for k, v in got.items()} == {k: v[1] for k, v in SHAPES.items() if v[1]}


def test_messages(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, n string")
    assert [json.loads(r.value) for r in X.to_messages(df).collect()] == [{"id": 1, "n": None}, {"id": 2, "n": "x"}]


def test_routing_gives_both_outcomes_of_one_pass(spark, tmp_path, helpers):
    df = payloads(spark)
    good, failed = X.split_outcomes(df)
    path = str(tmp_path / "routed")
    routed = X.route_outcomes(df, path)
    assert helpers.rows(X.extract_rides(routed.good)) == helpers.rows(X.extract_rides(good))
    assert helpers.rows(routed.failed) == helpers.rows(failed) and routed.failed.columns == failed.columns
    assert (routed.attempts, routed.failures) == (df.count(), failed.count())
    assert routed.good.count() + routed.failed.count() == df.count()
    # What both are read from was read and parsed once, and they read nothing else.
    df.write.parquet(str(tmp_path / "payloads"))
    once = helpers.plan(X._by_outcome(spark.read.parquet(str(tmp_path / "payloads")), "body", "error", X.PAYLOAD_BODY))
    assert once.count("FileScan") == 1 and once.count("from_json") == 1
    for part in (routed.good, routed.failed):
        assert all("/routed/outcome=" in f for f in part.inputFiles())
        assert "from_json" not in helpers.plan(part)


def test_routing_without_payloads(spark, tmp_path):
    routed = X.route_outcomes(payloads(spark).limit(0), str(tmp_path / "none"))
    assert (routed.attempts, routed.failures, routed.good.count(), routed.failed.count()) == (0, 0, 0, 0)
