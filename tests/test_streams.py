import glob
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions.schemas import LIVE_BRONZE, LIVE_SILVER
from tidemark.operators.flatten import normalize_live
from tidemark.operators.latest import latest
from tidemark.session import scratch_path
from tidemark.sources.bronze import write_bronze
from tidemark.sources.tables import ensure_namespace, point_table
from tidemark.streaming import live
from tidemark.streaming.progress import BatchLog, batch_report

AT = datetime(2026, 3, 3, 15, 0, 0, tzinfo=timezone.utc)


def batch(spark, minute, waits):
    stamp = (AT + timedelta(minutes=minute)).isoformat()
    data = [(1, None, None, i, f"ride {i}", "ATTRACTION", w is not None, "OPERATING", w, stamp, stamp) for i, w in waits.items()]
    return spark.createDataFrame(data, LIVE_BRONZE)


class Pipeline:
    def __init__(self, spark, base):
        self.spark, self.base, self.committed = spark, str(base), []

    def land(self, minute, waits):
        write_bronze(batch(self.spark, minute, waits), self.base, "live", AT + timedelta(minutes=minute))

    def run(self):
        source = live.bronze_stream(self.spark, f"{self.base}/bronze/live", max_files=2)
        live.bronze_to_silver(source, f"{self.base}/silver", f"{self.base}/cp-silver").awaitTermination()
        silver = self.spark.readStream.schema(LIVE_SILVER).parquet(f"{self.base}/silver")
        live.silver_to_gold(
            silver, f"{self.base}/gold", f"{self.base}/cp-gold", on_commit=lambda n, path: self.committed.append(n)
        ).awaitTermination()

    def silver(self):
        return self.spark.read.parquet(f"{self.base}/silver").drop("ingest_date")

    def gold(self):
        return live.read_gold(self.spark, f"{self.base}/gold", LIVE_SILVER)

    def waits(self):
        return {r.id: r.wait_time for r in self.gold().collect()}


@pytest.fixture
def pipeline(spark, tmp_path):
    return Pipeline(spark, tmp_path)


def test_bronze_to_silver_to_gold(pipeline):
    pipeline.land(0, {1: 10, 2: 20})
    pipeline.land(5, {1: 15, 3: None})
    pipeline.run()
    assert pipeline.silver().count() == 4
    assert dict(pipeline.silver().dtypes)["ingest_timestamp"] == "timestamp"
    assert pipeline.waits() == {1: 15, 2: 20, 3: None}
    assert glob.glob(f"{pipeline.base}/silver/ingest_date=2026-03-03/*.parquet")

    # The same files are not taken twice, and nothing new means no new epoch.
    epochs = list(pipeline.committed)
    pipeline.run()
    assert pipeline.silver().count() == 4
    assert pipeline.committed == epochs

    # A new batch moves the state on; a late one does not displace a newer row.
    pipeline.land(10, {2: 25})
    pipeline.run()
    assert pipeline.waits() == {1: 15, 2: 25, 3: None}
    pipeline.land(2, {1: 99, 4: 40})
    pipeline.run()
    assert pipeline.waits() == {1: 15, 2: 25, 3: None, 4: 40}
    assert pipeline.committed == sorted(set(pipeline.committed))

    # Stream and batch agree.
    whole = latest(pipeline.silver(), ["id"], ["ingest_timestamp"])
    assert sorted(map(str, pipeline.gold().collect())) == sorted(map(str, whole.select(pipeline.gold().columns).collect()))


def test_an_epoch_writes_the_buckets_of_its_keys_alone(pipeline):
    pipeline.land(0, {i: i for i in range(200)})
    pipeline.run()
    folders = {f: files_of(f) for f in glob.glob(f"{pipeline.base}/gold/gold_bucket=*")}
    assert len(folders) > 50
    pipeline.land(5, {7: 700, 8: None})
    pipeline.run()
    changed = {f for f, files in folders.items() if files_of(f) != files}
    rows = pipeline.spark.read.parquet(f"{pipeline.base}/gold").where("id in (7, 8)").select("gold_bucket").collect()
    assert {int(f.split("=")[-1]) for f in changed} == {r.gold_bucket for r in rows} and 1 <= len(changed) <= 2
    assert pipeline.waits() == {**{i: i for i in range(200)}, 7: 700, 8: None}


def files_of(folder):
    return sorted(glob.glob(f"{folder}/*.parquet"))


def merge(spark, tmp_path, epoch, waits, minute):
    rows = normalize_live(batch(spark, minute, waits))
    return live.merge_into_gold(rows, f"{tmp_path}/gold", f"{tmp_path}/aside", epoch, ["id"], ["ingest_timestamp"], buckets=4)


def test_an_epoch_that_died_before_gold_was_whole_is_put_in_from_aside(spark, tmp_path):
    merge(spark, tmp_path, 0, {i: 1 for i in range(40)}, 0)
    merge(spark, tmp_path, 1, {1: 5}, 1)
    whole = sorted(map(str, live.read_gold(spark, f"{tmp_path}/gold", LIVE_SILVER).collect()))
    (lost,) = [f for f in glob.glob(f"{tmp_path}/gold/gold_bucket=*") if spark.read.parquet(f).where("id = 1").count()]
    for file in glob.glob(f"{lost}/*"):
        Path(file).unlink()  # the run died when the old files were gone and the new ones not yet there
    assert merge(spark, tmp_path, 1, {1: 5}, 1) == [int(lost.split("=")[-1])]
    assert sorted(map(str, live.read_gold(spark, f"{tmp_path}/gold", LIVE_SILVER).collect())) == whole
    assert merge(spark, tmp_path, 2, {}, 2) == []
    assert sorted(map(str, live.read_gold(spark, f"{tmp_path}/gold", LIVE_SILVER).collect())) == whole


def test_a_second_checkpoint_does_not_take_the_first_ones_rows(spark, tmp_path):
    merge(spark, tmp_path, 0, {1: 1}, 0)
    rows = normalize_live(batch(spark, 3, {1: 9, 2: 2}))
    live.merge_into_gold(rows, f"{tmp_path}/gold", f"{tmp_path}/other", 0, ["id"], ["ingest_timestamp"], buckets=4)
    assert {r.id: r.wait_time for r in live.read_gold(spark, f"{tmp_path}/gold", LIVE_SILVER).collect()} == {1: 9, 2: 2}


def test_silver_as_a_table_that_a_stream_feeds(spark, tmp_path, pipeline):
    name = f"silver_{tmp_path.name.replace('-', '_')}.live_data"

    def run():
        source = live.bronze_stream(spark, f"{tmp_path}/bronze/live", max_files=1)
        live.bronze_to_silver(source, f"{tmp_path}/silver", f"{tmp_path}/cp", table=name).awaitTermination()

    pipeline.land(0, {1: 10, 2: 20})
    run()
    pipeline.land(5, {1: 15})
    pipeline.land(24 * 60, {3: 1})
    run()
    assert sorted((r.id, r.wait_time) for r in spark.table(name).collect()) == [(1, 10), (1, 15), (2, 20), (3, 1)]
    assert spark.table(name).where("ingest_date = date '2026-03-04'").count() == 1
    assert dict(spark.table(name).dtypes)["ingest_timestamp"] == "timestamp"


def test_the_log_of_a_stream_tells_attempts_failures_and_rows(spark, tmp_path, pipeline):
    log = BatchLog(spark, f"{tmp_path}/log")
    spark.streams.addListener(log)

    def run(normalize=normalize_live):
        source = live.bronze_stream(spark, f"{tmp_path}/bronze/live")
        query = live.bronze_to_silver(source, f"{tmp_path}/silver", f"{tmp_path}/cp", normalize=normalize)
        try:
            query.awaitTermination()
        finally:
            log.wait(query)

    def broken(rows):
        return normalize_live(rows).withColumn("name", F.when(F.col("id") > 0, F.raise_error(F.lit("no name"))).otherwise(F.col("name")))

    try:
        pipeline.land(0, {1: 10, 2: None})
        run()
        pipeline.land(5, {3: 1})
        for _ in range(2):
            with pytest.raises(Exception, match="(?s)no name|STREAM_FAILED"):
                run(broken)
        open_batches = batch_report(spark, f"{tmp_path}/log").orderBy("batch").collect()
        assert [(r.batch, r.attempts, r.failures, r["rows"]) for r in open_batches] == [(0, 1, 0, 2), (1, 2, 2, None)]
        run()
    finally:
        spark.streams.removeListener(log)
    report = batch_report(spark, f"{tmp_path}/log").orderBy("batch").collect()
    assert [(r.batch, r.attempts, r.failures, r["rows"], r.without_time) for r in report] == [(0, 1, 0, 2, 0), (1, 3, 2, 1, 0)]


def test_bad_line_stops_the_stream(spark, tmp_path, pipeline):
    pipeline.land(0, {1: 10})
    folder = next(iter(glob.glob(f"{tmp_path}/bronze/live/*/*/*/*")))
    with open(f"{folder}/broken.json", "w") as f:
        f.write("{\n")
    with pytest.raises(Exception, match="(?i)malformed|failed_read_file|stream_failed"):
        pipeline.run()


def test_gold_table_follows_the_stream(spark, tmp_path):
    """The commit hook may make a catalog table of gold and tell it of new buckets."""
    name = f"gold_{tmp_path.name.replace('-', '_')}.current"
    ensure_namespace(spark, name.split(".")[0], str(tmp_path))
    pipe, told = Pipeline(spark, tmp_path), []
    pipe.land(0, {1: 10})
    schema = T.StructType([*LIVE_SILVER, T.StructField(live.BUCKET, T.IntegerType())])

    def commit(epoch, buckets):
        told.append((epoch, len(buckets)))
        if not spark.catalog.tableExists(name):
            point_table(spark, name, f"{tmp_path}/gold", schema, [live.BUCKET])
        spark.sql(f"MSCK REPAIR TABLE {name}")

    def run():
        source = live.bronze_stream(spark, f"{tmp_path}/bronze/live")
        live.bronze_to_silver(source, f"{tmp_path}/silver", f"{tmp_path}/cp-silver").awaitTermination()
        silver = spark.readStream.schema(LIVE_SILVER).parquet(f"{tmp_path}/silver")
        live.silver_to_gold(silver, f"{tmp_path}/gold", f"{tmp_path}/cp-gold", on_commit=commit).awaitTermination()

    run()
    pipe.land(5, {1: 11, 2: 20})
    run()
    assert {r.id: r.wait_time for r in spark.table(name).collect()} == {1: 11, 2: 20}
    assert [epoch for epoch, _ in told] == [0, 1]


ODD_LINES = """
{"id": 1, "wait_time": 50.0, "entityType": null, "ingest_timestamp": "2026-03-03T15:00:00Z"}
{"id": 2, "wait_time": 3.9, "entityType": "SHOW", "ingest_timestamp": "2026-03-03T15:00:00Z"}
{"id": 3, "wait_time": "7", "ingest_timestamp": "2026-03-03T17:00:00+02:00"}

{"id": 4, "wait_time": null, "ingest_timestamp": "2026-03-03T15:00:00.000001Z"}
"""


def test_numbers_texts_and_absent_keys_in_files(spark, tmp_path, pipeline):
    from tidemark.functions.schemas import LIVE_FILE
    from tidemark.operators.flatten import normalize_live
    from tidemark.sources.bronze import read_bronze

    folder = tmp_path / "bronze" / "live" / "2026" / "03" / "03"
    folder.mkdir(parents=True)
    (folder / "150000.jsonl").write_text(ODD_LINES)
    batch = normalize_live(read_bronze(spark, str(folder), LIVE_FILE))
    want = {1: (50, None), 2: (3, "SHOW"), 3: (7, "ATTRACTION"), 4: (None, "ATTRACTION")}
    assert {r.id: (r.wait_time, r.entityType) for r in batch.collect()} == want
    assert {r.ingest_timestamp.microsecond for r in batch.collect()} == {0, 1}
    pipeline.run()
    assert {r.id: (r.wait_time, r.entityType) for r in pipeline.silver().collect()} == want


def test_periodic_trigger(spark, tmp_path, pipeline):
    pipeline.land(0, {1: 10})
    source = live.bronze_stream(spark, f"{tmp_path}/bronze/live")
    query = live.bronze_to_silver(source, f"{tmp_path}/silver", f"{tmp_path}/cp", every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
        assert pipeline.silver().count() == 1
    finally:
        query.stop()


def test_gold_before_the_first_state(spark, tmp_path):
    assert live.read_gold(spark, str(tmp_path / "gold"), LIVE_SILVER).count() == 0


def test_shared_folder_comes_from_the_session(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(spark.conf.get("spark.checkpoint.dir") + "/x-") and one != two


class Unset:
    """A session without the setting, on a cluster or local."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master = master

    def get(self, key, default=None):
        return default


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Unset("yarn"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Unset("local-cluster[3,2,3000]"), "x")
    assert scratch_path(Unset("local[2]"), "x") and scratch_path(Unset("local"), "x")
