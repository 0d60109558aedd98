from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import boards as B


def live(spark):
    return spark.createDataFrame(
        [
            (1, 10, "Alpha", "OPERATING", 30), (2, 10, "Beta", "CLOSED", None), (3, 10, "Gamma", "OPERATING", 50),
            (4, 20, "Delta", "OPERATING", 5), (5, 99, "Lost", "DOWN", 1), (6, 10, "Epsilon", "OPERATING", 30),
        ],
        "id long, park_id long, name string, status string, wait_time long",
    )


def places(spark):
    destinations = spark.createDataFrame([(1, "Resort"), (2, "Else")], "did long, dest_name string")
    parks = spark.createDataFrame([(10, 1, "Harbour"), (20, 1, "Other"), (30, 2, "Far")], "pid long, owner long, park_name string")
    return destinations.join(parks, F.col("did") == F.col("owner"))


def test_star_board_rows_and_order(spark):
    board = B.star_board(
        live(spark), places(spark).where("dest_name = 'Resort' and park_name = 'Harbour'"),
        F.col("park_id") == F.col("pid"), ["dest_name", "park_name", F.col("name").alias("entity_name"), "wait_time"],
        desc=["wait_time"], asc=["id"],
    )
    assert [(r.entity_name, r.wait_time) for r in board.collect()] == [
        ("Gamma", 50), ("Alpha", 30), ("Epsilon", 30), ("Beta", None),
    ]


def test_ascending_order_puts_null_last(spark):
    df = spark.createDataFrame([(None, "b"), (2, None), (1, "z"), (2, "a"), (None, "a")], "park_id long, name string")
    got = [tuple(r) for r in B.ordered(df, asc=["park_id", "name"]).collect()]
    assert got == [(1, "z"), (2, "a"), (2, None), (None, "a"), (None, "b")]


def test_top_n_and_no_limit(spark):
    assert [r.id for r in B.top_n(live(spark), 3, desc=["wait_time"], asc=["id"]).collect()] == [3, 1, 6]
    assert B.top_n(live(spark), 0).count() == 6
    assert B.top_n(live(spark), None).count() == 6


def test_star_and_repeated_column(spark):
    df = live(spark).alias("d").select("d.*", F.col("d.name").alias("label"))
    assert df.columns == ["id", "park_id", "name", "status", "wait_time", "label"]


def test_counts(spark):
    assert [tuple(r) for r in A.count_by(live(spark), "status").collect()] == [("OPERATING", 4), ("CLOSED", 1), ("DOWN", 1)]
    share = A.share_by(live(spark), "park_name", F.col("status") == "OPERATING", places(spark), {"park_id": "pid"})
    assert sorted(tuple(r) for r in share.collect()) == [("Harbour", 3, 4), ("Other", 1, 1)]
    failed = A.failures_by(live(spark), "park_id", F.col("status") == "DOWN")
    assert sorted(tuple(r) for r in failed.collect()) == [(10, 0, 4, True), (20, 0, 1, True), (99, 1, 1, False)]
    assert tuple(A.dedup_counts(live(spark), ["park_id"]).first()) == (6, 3)
    assert tuple(A.dedup_counts(live(spark).limit(0), ["park_id"]).first()) == (0, 0)


def test_known_keys(spark):
    df = spark.createDataFrame([(3,), (0,), (None,), (1,), (3,)], "park_id long")
    assert [r.park_id for r in A.known_keys(df, "park_id").collect()] == [1, 3]
    text = spark.createDataFrame([("b",), ("",), (None,), ("a",)], "park_id string")
    assert [r.park_id for r in A.known_keys(text, "park_id").collect()] == ["a", "b"]


def test_hot_join_key_is_split(spark, settings):
    """Past the broadcast threshold, adaptive execution splits the partition of a hot key."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    facts = spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("event"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    dims = spark.range(60000).select(F.col("id").alias("d"), F.concat(F.lit("n"), "id").alias("name"))
    board = B.star_board(facts, dims, F.col("k") == F.col("d"), ["event", "name", "payload"], asc=["event"])
    assert len(board.collect()) == 60000
    assert "skew=true" in board._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_positions_number_the_whole_order_without_one_task_for_all(spark, settings, helpers):
    settings(spark__sql__shuffle__partitions="7", spark__sql__adaptive__coalescePartitions__enabled="false")
    data = [(i, float(i % 13) if i % 5 else None) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, `odd.name` double").repartition(5)
    got = B.positioned(df, desc=["`odd.name`"], asc=["id"])
    want = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [tuple(r) for r in got.orderBy("position").collect()] == [(*r, n) for n, r in enumerate(want, 1)]
    assert "Window" not in helpers.plan(got)
    assert B.positioned(df.limit(0), asc=["id"]).count() == 0
