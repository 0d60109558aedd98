import csv
import glob
import gzip
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions.schemas import ENTITY, LIVE_BRONZE, struct, LONG, TEXT
from tidemark.sources import bronze as B
from tidemark.sources import files as X

AT = datetime(2026, 2, 19, 12, 0, 0, tzinfo=timezone.utc)
SMALL = struct(id=LONG, name=TEXT)


# --- bronze ------------------------------------------------------------------------------


def test_bronze_roundtrip_keeps_nulls_as_keys(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], SMALL)
    done = B.write_bronze(df, str(tmp_path), "live", AT)
    assert done["path"] == f"{tmp_path}/bronze/live/2026/02/19/120000"
    assert done["rows_written"] == 2
    lines = []
    for name in glob.glob(f"{done['path']}/*.gz"):
        with gzip.open(name, "rt") as f:
            lines += [json.loads(line) for line in f]
    assert sorted(lines, key=lambda r: r["id"]) == [{"id": 1, "name": "a"}, {"id": 2, "name": None}]
    back = B.read_bronze(spark, done["path"], SMALL)
    assert sorted(map(tuple, back.collect()), key=str) == [(1, "a"), (2, None)]
    with pytest.raises(Exception, match="(?i)exists"):
        B.write_bronze(df, str(tmp_path), "live", AT)


def test_files_stay_small(spark, tmp_path):
    done = B.write_bronze(spark.range(100).coalesce(1), str(tmp_path), "live", AT, rows_per_file=30)
    assert len(glob.glob(f"{done['path']}/*.gz")) == 4


def test_batch_path_is_utc():
    from datetime import timedelta

    east = AT.astimezone(timezone(timedelta(hours=5)))
    assert B.batch_path("s3a://bucket/", "live", east) == "s3a://bucket/bronze/live/2026/02/19/120000"
    assert B.batch_time(B.batch_path("x", "live", AT)) == AT
    with pytest.raises(ValueError):
        B.batch_time("bronze/live")


def test_read_plain_gzip_blank_and_empty(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "name": "a"}\n\n  \n{"id": 2}\n')
    with gzip.open(tmp_path / "b.jsonl.gz", "wt") as f:
        f.write('{"id": 3, "name": "c", "unknown": 1}')
    (tmp_path / "empty.jsonl").write_text("")
    assert B.read_bronze(spark, str(tmp_path / "a.jsonl"), SMALL).count() == 2
    assert sorted(r.id for r in B.read_bronze(spark, str(tmp_path), SMALL).collect()) == [1, 2, 3]
    assert B.read_bronze(spark, str(tmp_path / "empty.jsonl"), SMALL).collect() == []


def test_malformed_line_is_an_error(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        B.read_bronze(spark, str(tmp_path / "a.jsonl"), SMALL).collect()


def test_read_needs_a_path_text(spark):
    for wrong in (None, [{"id": 1}], 5):
        with pytest.raises(TypeError):
            B.read_bronze(spark, wrong, SMALL)


def test_latest_bronze_at_or_before_the_run(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], SMALL)
    times = [AT, AT.replace(hour=18), AT.replace(month=3)]
    paths = [B.write_bronze(df, str(tmp_path), "live", t)["path"] for t in times]
    B.write_bronze(df, str(tmp_path), "entities", AT.replace(month=4))

    def newest(at=None):
        found = B.latest_bronze(spark, str(tmp_path), "live", at)
        return found and found.removeprefix("file:")

    assert newest() == paths[2]
    assert newest(times[1]) == paths[1]
    assert newest(times[1].replace(hour=17)) == paths[0]
    assert newest(AT.replace(year=2025)) is None
    assert B.landed_batches(spark, str(tmp_path)).count() == 4

    # Batches that are single files count as well.
    single = tmp_path / "bronze" / "live" / "2026" / "05" / "01"
    single.mkdir(parents=True)
    (single / "101112.jsonl").write_text('{"id": 5}\n')
    with gzip.open(single / "101113.jsonl.gz", "wt") as f:
        f.write('{"id": 6}\n')
    (single / "notes.jsonl").write_text("not a batch")
    assert newest() == f"{single}/101113.jsonl.gz"
    assert [r.id for r in B.read_bronze(spark, newest(), SMALL).collect()] == [6]
    assert newest(AT.replace(month=5, day=1, hour=10, minute=11, second=12)) == f"{single}/101112.jsonl"
    assert B.batch_time(newest()) == AT.replace(month=5, day=1, hour=10, minute=11, second=13)


def test_a_batch_in_many_files_is_listed_once(spark, tmp_path):
    for n, rows in enumerate((0, 1, 500)):
        B.write_bronze(spark.range(rows).repartition(4), str(tmp_path), "live", AT.replace(hour=n), rows_per_file=20)
    assert B.landed_batches(spark, str(tmp_path)).count() == 3


def test_inference_is_for_looking_around(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "x": null}\n{"id": "two", "x": null}\n')
    assert dict(B.explore_json(spark, str(tmp_path)).dtypes)["id"] == "string"


def test_records_from_memory_need_a_schema(spark):
    got = X.from_records(spark, [{"park_id": 1, "id": 2}, {"id": 3, "name": "n"}], ENTITY)
    assert got.schema == ENTITY
    assert [r.name for r in got.orderBy("id").collect()] == [None, "n"]
    assert X.from_records(spark, [], LIVE_BRONZE).schema == LIVE_BRONZE


# --- parquet -----------------------------------------------------------------------------


def test_parquet_partitioned_with_summary(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "x")], "id long, name string, p string")
    path = X.dated_path(str(tmp_path), "live", "raw", at=AT)
    assert path.endswith("/live/raw/2026-02-19/2026-02-19T12-00-00.parquet")
    done = X.write_parquet(df, path, ["p"], at=AT, sizes=True)
    assert (done["status"], done["row_count"], done["column_count"], done["columns"]) == ("loaded", 3, 3, ["id", "name", "p"])
    assert done["timestamp"] == AT.isoformat()
    on_disk = glob.glob(f"{path}/p=*/*.parquet")
    assert done["size_bytes"] == sum(len(open(f, "rb").read()) for f in on_disk)
    assert all(".snappy." in f for f in on_disk) and len(on_disk) == 2
    back = X.read_summary(spark, done)
    assert sorted((r.id, r.name, r.p) for r in back.collect()) == [(1, "a", "x"), (2, "b", "y"), (3, "c", "x")]
    by_name = X.read_summary(spark, {"object_name": path.removeprefix(f"{tmp_path}/")}, root=str(tmp_path))
    assert by_name.count() == 3
    coded = spark.createDataFrame([(1, "00"), (2, "01")], "id long, p string")
    back = X.read_summary(spark, X.write_parquet(coded, f"{tmp_path}/coded", ["p"]))
    assert sorted(map(tuple, back.collect())) == [(1, "00"), (2, "01")]
    for bad in ({}, {"path": ""}, {"object_name": "x"}):
        with pytest.raises(ValueError):
            X.read_summary(spark, bad)


def test_parquet_of_nothing_is_skipped(spark, tmp_path):
    done = X.write_parquet(spark.createDataFrame([], SMALL), str(tmp_path / "none"))
    assert (done["status"], done["row_count"], done["reason"]) == ("skipped", 0, "no rows")


def test_hot_folder_is_split_on_write(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB")
    df = spark.range(0, 30000, 1, 4).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("x"), F.when(F.col("id") < 29000, "hot").otherwise("cold").alias("p")
    )
    X.write_parquet(df, str(tmp_path / "t"), ["p"])
    assert len(glob.glob(f"{tmp_path}/t/p=hot/*.parquet")) > 1
    assert len(glob.glob(f"{tmp_path}/t/p=cold/*.parquet")) == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 30000


# --- CSV and messages --------------------------------------------------------------------


def read_csv(path):
    out = []
    for name in sorted(glob.glob(f"{path}/*.csv")):
        with open(name, newline="") as f:
            out += list(csv.DictReader(f))
    return out


def test_csv_of_several_inputs_has_the_sorted_union_of_columns(spark, tmp_path):
    a = spark.createDataFrame([(1, 'say "hi", twice')], "b int, a string")
    b = spark.createDataFrame([(2, 3.5)], "b int, c double")
    assert X.write_csv([a, b], str(tmp_path / "t"))
    got = sorted(read_csv(tmp_path / "t"), key=lambda r: r["b"])
    assert [list(r) for r in got] == [["a", "b", "c"]] * 2
    assert got == [{"a": 'say "hi", twice', "b": "1", "c": ""}, {"a": "", "b": "2", "c": "3.5"}]


def test_csv_of_a_table_keeps_its_order(spark, tmp_path):
    assert X.write_csv(spark.createDataFrame([(1, "x")], "z int, a string"), str(tmp_path / "t"))
    assert [list(r) for r in read_csv(tmp_path / "t")] == [["z", "a"]]


def test_csv_of_nothing_writes_nothing(spark, tmp_path):
    assert not X.write_csv([], str(tmp_path / "t"))
    assert not X.write_csv([spark.createDataFrame([], SMALL)], str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()


def test_messages_need_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        X.publish(spark.range(1), "localhost:0", "topic")


def test_one_entry_for_all_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], SMALL)
    assert X.load(df, str(tmp_path / "p"), "parquet")["row_count"] == 1
    assert X.load(df, str(tmp_path / "c"), "csv")
    assert X.load(df, str(tmp_path), "bronze", prefix="live", at=AT)["rows_written"] == 1
    assert X.load(df, "loads.small", "table", root=str(tmp_path / "t"))["rows_written"] == 1
    with pytest.raises(ValueError, match="unknown sink"):
        X.load(df, "x", "orc")


def test_an_empty_overwrite_leaves_what_is_there(spark, tmp_path):
    path = str(tmp_path / "kept")
    X.write_parquet(spark.range(3), path)
    assert X.write_parquet(spark.range(0), path, mode="overwrite")["status"] == "skipped"
    assert spark.read.parquet(path).count() == 3


def test_kinds_of_values_by_path(spark):
    from tidemark.sources.bronze import merged_schema, value_types

    bodies = spark.createDataFrame([(b,) for b in ('{"a": [1, "x", {"b": null}]}', '{"a": {"b": 2.5}}', "[true]", "7", "no json", None)], "body string")
    assert sorted(map(tuple, value_types(bodies).collect())) == [
        ("$", "ARRAY", 1), ("$", "BIGINT", 1), ("$", "OBJECT", 2), ("$.a", "ARRAY", 1), ("$.a", "OBJECT", 1), ("$.a.b", "DECIMAL", 1),
        ("$.a[]", "BIGINT", 1), ("$.a[]", "OBJECT", 1), ("$.a[]", "STRING", 1), ("$.a[].b", "VOID", 1), ("$[]", "BOOLEAN", 1),
    ]
    assert {r.path for r in value_types(bodies, depth=1).collect()} == {"$", "$.a", "$[]"}
    assert merged_schema(bodies) == "VARIANT" and merged_schema(bodies.where("body like '{%'")) == "OBJECT<a: VARIANT>"
    assert value_types(bodies.limit(0)).count() == 0
