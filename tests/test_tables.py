import glob
from datetime import datetime, timezone
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tidemark.sources import tables as T


@pytest.fixture
def name(spark, tmp_path):
    return f"ns_{uuid4().hex[:8]}.live_data"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")


def frame(spark, data, ddl="id long, name string"):
    return spark.createDataFrame(data, ddl)


def content(spark, name):
    return sorted(map(tuple, spark.table(name).collect()), key=str)


def test_first_write_creates_once_and_append_adds(spark, name, root):
    first = T.write_table(frame(spark, [(1, "a")]), name, root=root)
    assert (first["rows_written"], first["status"], first["table"], first["columns"]) == (1, "loaded", name, ["id", "name"])
    assert content(spark, name) == [(1, "a")]
    second = T.write_table(frame(spark, [(2, "b")]).select("name", "id"), name, root=root)
    assert second["rows_written"] == 1 and second["snapshot_id"] > first["snapshot_id"]
    assert content(spark, name) == [(1, "a"), (2, "b")]


def test_overwrite_replaces_and_keeps_the_old_version_readable(spark, name, root):
    first = T.write_table(frame(spark, [(1, "a"), (2, "b")]), name, "overwrite", root=root)
    second = T.write_table(frame(spark, [(3, "c")]), name, "overwrite", root=root)
    assert content(spark, name) == [(3, "c")]
    assert {r.version: r.rows for r in T.table_versions(spark, name).collect()} == {
        first["snapshot_id"]: 2, second["snapshot_id"]: 1,
    }
    assert T.read_version(spark, name, first["snapshot_id"]).count() == 2


def test_history_records_every_complete_write(spark, name, root):
    first = T.write_table(frame(spark, [(1, "a"), (2, "b")]), name, root=root)
    second = T.write_table(frame(spark, [(3, "c")]), name, root=root)
    third = T.write_table(frame(spark, [(4, "d")]), name, "overwrite", root=root)
    T.write_table(frame(spark, []), name, root=root)
    history = T.table_history(spark, name).orderBy("snapshot_id").collect()
    assert [(r.version, r.operation, r.rows) for r in history] == [
        (first["snapshot_id"], "append", 2), (first["snapshot_id"], "append", 1), (third["snapshot_id"], "overwrite", 1),
    ]
    assert [r.snapshot_id for r in history][::2] == [first["snapshot_id"], third["snapshot_id"]]
    assert second["snapshot_id"] < history[1].snapshot_id < third["snapshot_id"]
    assert {r.version: r.rows for r in T.table_versions(spark, name).collect()} == {
        first["snapshot_id"]: 3, third["snapshot_id"]: 1,
    }
    log = T.snapshot_log(spark, [name, "nowhere.none"])
    assert {r.table for r in log.collect()} == {name} and log.count() == 3
    assert T.snapshot_log(spark, []).count() == 0


def test_state_at_a_moment_comes_from_the_files(spark, name, root):
    """Files that were written later are not opened, and no list of writes is kept."""
    before = datetime.now(timezone.utc)
    one = T.write_table(frame(spark, [(1, "a")]), name, root=root)
    two = T.write_table(frame(spark, [(2, "b")]), name, root=root)
    three = T.write_table(frame(spark, [(3, "c")]), name, "overwrite", root=root)

    def at(moment):
        return sorted(r.id for r in T.read_as_of(spark, name, moment).collect())

    times = [datetime.fromisoformat(w["written_at"]) for w in (one, two, three)]
    assert [at(t) for t in (before, *times)] == [[], [1], [1, 2], [3]]
    assert not glob.glob(f"{root}/**/*.history", recursive=True)
    early = T.read_as_of(spark, name, times[0])
    assert early.count() == 1 and len(early.inputFiles()) >= 1
    files = early._jdf.queryExecution().executedPlan().collectLeaves().head()
    early.collect()
    assert "file_modification_time" in str(files)


def test_buckets_spare_the_table_a_shuffle(spark, name, root, helpers, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = frame(spark, [(i, "a") for i in range(50)])
    T.write_table(rows, name, "overwrite", root=root, buckets=(4, ["id"]))
    assert T.table_buckets(spark, name) == (4, ["id"])
    grouped = spark.table(name).groupBy("id").count()
    assert "Exchange" not in helpers.plan(grouped) and grouped.count() == 50
    done = T.write_table(spark.table(name).where("id < 9"), name, "overwrite", root=root)
    assert done["rows_written"] == 9 and T.table_buckets(spark, name) == (4, ["id"]) and spark.table(name).count() == 9
    T.write_table(frame(spark, [(9, "z")]), name, root=root)
    assert sorted(content(spark, name))[-1] == (9, "z")
    assert {r.version: r.rows for r in T.table_versions(spark, name).collect()}[done["snapshot_id"]] == 10
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("written_")]


def test_a_table_can_be_rewritten_from_itself(spark, name, root):
    T.write_table(frame(spark, [(1, "a"), (2, "b")]), name, "overwrite", root=root)
    T.write_table(spark.table(name).where("id = 2"), name, "overwrite", root=root)
    assert content(spark, name) == [(2, "b")]


def test_failed_overwrite_leaves_the_table(spark, name, root):
    T.write_table(frame(spark, [(1, "a")]), name, "overwrite", root=root)
    broken = frame(spark, [(5, "x")]).withColumn("id", F.when(F.col("id") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        T.write_table(broken, name, "overwrite", root=root)
    assert content(spark, name) == [(1, "a")]


def test_retried_version_replaces_its_own_files(spark, name, root):
    for _ in range(2):
        T.write_table(frame(spark, [(1, "a")]), name, "overwrite", root=root, version=7)
    assert {r.version: r.rows for r in T.table_versions(spark, name).collect()} == {7: 1}


def test_empty_input_changes_nothing(spark, name, root):
    empty = frame(spark, [])
    done = T.write_table(empty, name, root=root)
    assert (done["status"], done["rows_written"], done["snapshot_id"], done["reason"]) == ("skipped", 0, None, "no rows")
    assert not T.table_exists(spark, name)
    T.write_table(frame(spark, [(1, "a")]), name, root=root)
    for mode in T.MODES:
        assert T.write_table(empty, name, mode, root=root)["status"] == "skipped"
    assert content(spark, name) == [(1, "a")]


def test_guards(spark, name, root):
    df = frame(spark, [(1, "a")])
    with pytest.raises(ValueError, match="unknown mode"):
        T.write_table(df, name, "upsert", root=root)
    with pytest.raises(ValueError, match="unknown drift"):
        T.write_table(df, name, on_drift="ignore", root=root)
    with pytest.raises(ValueError, match="does not exist"):
        T.write_table(df, name, create=False, root=root)
    assert not T.table_exists(spark, name)


DRIFTS = {
    "added": ([(2, "b", 5)], "id long, name string, wait long"),
    "removed": ([(2,)], "id long"),
    "both": ([(2, 5)], "id long, wait long"),
}


@pytest.mark.parametrize("mode", T.MODES)
@pytest.mark.parametrize("kind", [*DRIFTS, "type"])
def test_drift_fails_by_default_and_keeps_history(spark, name, root, mode, kind):
    T.write_table(frame(spark, [(1, "a")]), name, root=root)
    data, ddl = DRIFTS.get(kind, ([("x", "a")], "id string, name string"))
    with pytest.raises(ValueError, match="differ"):
        T.write_table(frame(spark, data, ddl), name, mode, root=root)
    assert content(spark, name) == [(1, "a")]


@pytest.mark.parametrize(
    "kind,want",
    [("added", [(1, "a", None), (2, "b", 5)]), ("removed", [(1, "a"), (2, None)]), ("both", [(1, "a", None), (2, None, 5)])],
)
def test_merge_on_append_widens_without_rewriting(spark, name, root, kind, want):
    T.write_table(frame(spark, [(1, "a")]), name, root=root)
    done = T.write_table(frame(spark, *DRIFTS[kind]), name, on_drift="merge", root=root)
    assert content(spark, name) == want
    assert len(T.table_versions(spark, name).collect()) == 1
    assert (done["added"], done["removed"]) == (
        ["wait"] if kind != "removed" else [], ["name"] if kind != "added" else [],
    )
    T.write_table(frame(spark, [(9, "z")]), name, on_drift="merge", root=root)
    assert spark.table(name).count() == 3


def test_merge_on_overwrite_keeps_lost_columns_as_null(spark, name, root):
    T.write_table(frame(spark, [(1, "a")]), name, root=root)
    T.write_table(frame(spark, *DRIFTS["both"]), name, "overwrite", "merge", root=root)
    assert [r.asDict() for r in spark.table(name).collect()] == [{"id": 2, "wait": 5, "name": None}]


def test_merge_does_not_change_types(spark, name, root):
    T.write_table(frame(spark, [(1, "a")]), name, root=root)
    with pytest.raises(ValueError, match="changed=\\['id'\\]"):
        T.write_table(frame(spark, [("x", "a")], "id string, name string"), name, on_drift="merge", root=root)


WIDER = [
    ("int", "long", "bigint", [1], [1 << 40]), ("long", "int", "bigint", [1 << 40], [2]), ("float", "double", "double", [0.5], [0.1]),
    ("int", "double", "double", [7], [0.25]), ("decimal(5,2)", "decimal(6,4)", "decimal(7,4)", ["1.25"], ["3.1234"]), ("int", "decimal(4,2)", "decimal(12,2)", [9], ["1.5"]),
]


@pytest.mark.parametrize("old, new, want, a, b", WIDER)
@pytest.mark.parametrize("by", [(), ("name",)])
def test_merge_takes_the_smallest_type_that_holds_both(spark, name, root, old, new, want, a, b, by):
    def one(kind, value):
        return spark.createDataFrame([(value[0], "k")], f"v {'string' if kind.startswith('decimal') else kind}, name string").selectExpr(f"cast(v as {kind}) v", "name")

    T.write_table(one(old, a), name, root=root, partition_by=by)
    T.write_table(one(new, b), name, on_drift="merge", root=root)
    assert dict(spark.table(name).dtypes)["v"] == want
    assert sorted(float(r.v) for r in spark.table(name).collect()) == sorted(float(v) for v in (*a, *b))
    assert len(T.table_versions(spark, name).collect()) == 1


def test_merge_widens_inside_structs_and_lists(spark, name, root):
    T.write_table(spark.sql("select 1 id, named_struct('a', 1, 'b', array(named_struct('x', 1))) s, map('k', 1) m"), name, root=root)
    T.write_table(spark.sql("select 2 id, named_struct('c', 'new', 'b', array(named_struct('y', 2L, 'x', 5L)), 'a', 7L) s, map('k', 8L) m"), name, on_drift="merge", root=root)
    T.write_table(spark.sql("select 3 id, named_struct('a', 3) s, cast(null as map<string,int>) m"), name, on_drift="merge", root=root)
    assert dict(spark.table(name).dtypes)["s"] == "struct<a:bigint,b:array<struct<x:bigint,y:bigint>>,c:string>"
    got = {r.id: r.asDict(recursive=True) for r in spark.table(name).collect()}
    assert got[1]["s"] == {"a": 1, "b": [{"x": 1, "y": None}], "c": None} and got[1]["m"] == {"k": 1}
    assert got[2]["s"] == {"a": 7, "b": [{"x": 5, "y": 2}], "c": "new"} and got[2]["m"] == {"k": 8}
    assert got[3]["s"] == {"a": 3, "b": None, "c": None} and got[3]["m"] is None


@pytest.mark.parametrize("old, new", [("long", "double"), ("string", "int"), ("date", "string"), ("struct<a:int>", "struct<a:string>"), ("decimal(38,0)", "decimal(10,5)")])
def test_merge_refuses_types_that_do_not_meet_without_loss(spark, name, root, old, new):
    T.write_table(spark.createDataFrame([], f"v {old}, id int").union(spark.sql(f"select cast(null as {old}), 1")), name, root=root)
    with pytest.raises(ValueError, match="changed=\\['v'\\]"):
        T.write_table(spark.sql(f"select cast(null as {new}) v, 1 id"), name, on_drift="merge", root=root)


@pytest.mark.parametrize("mode", T.MODES)
def test_recreate_starts_over_but_old_files_stay(spark, name, root, mode):
    first = T.write_table(frame(spark, [(1, "a")]), name, root=root)
    T.write_table(frame(spark, [("x", 5)], "id string, wait long"), name, mode, "recreate", root=root)
    assert content(spark, name) == [("x", 5)]
    assert T.read_version(spark, name, first["snapshot_id"]).count() == 1


def test_recreate_without_drift_appends(spark, name, root):
    T.write_table(frame(spark, [(1, "a")]), name, root=root)
    T.write_table(frame(spark, [(2, "b")]), name, on_drift="recreate", root=root)
    assert content(spark, name) == [(1, "a"), (2, "b")]


def test_partitioned_table(spark, name, root):
    ddl = "id long, day string, wait long"
    T.write_table(frame(spark, [(1, "mon", 1), (2, "tue", 2)], ddl), name, partition_by=["day"], root=root)
    T.write_table(frame(spark, [(3, "tue", 3), (4, "wed", 4)], ddl), name, root=root)
    assert sorted((r.id, r.day, r.wait) for r in spark.table(name).collect()) == [
        (1, "mon", 1), (2, "tue", 2), (3, "tue", 3), (4, "wed", 4),
    ]
    text = spark.table(name).where("day = 'tue'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text
    T.write_table(frame(spark, [(5, "thu", 5)], ddl), name, "overwrite", root=root)
    assert sorted((r.id, r.day) for r in spark.table(name).collect()) == [(5, "thu")]
    T.write_table(frame(spark, [(6, "fri", 6, "n")], ddl + ", note string"), name, on_drift="merge", root=root)
    assert sorted((r.id, r.note or "") for r in spark.table(name).collect()) == [(5, ""), (6, "n")]


def test_void_and_text_times_are_repaired_on_write(spark, name, root):
    df = spark.sql("select 1L as id, null as note, '2026-03-03T15:00:24Z' as seen")
    T.write_table(df, name, timestamps=["seen", "absent"], root=root)
    assert dict(spark.table(name).dtypes) == {"id": "bigint", "note": "string", "seen": "timestamp"}
    T.write_table(df.withColumn("note", F.lit("x")), name, timestamps=["seen"], root=root)
    assert spark.table(name).count() == 2


def test_catalog_listing_predicate_and_limit(spark, name, root):
    T.write_table(frame(spark, [(i, str(i)) for i in range(10)]), name, root=root)
    assert tuple(name.split(".")) in T.list_tables(spark)
    assert T.table_exists(spark, name) and not T.table_exists(spark, name + "_no")
    assert T.read_table(spark, name, "id >= 4 and name != '5'").count() == 5
    assert T.read_table(spark, name, limit=3).count() == 3
    assert T.read_table(spark, name, limit=0).count() == T.read_table(spark, name, limit=None).count() == 10


def test_describe_and_explain(spark, name, root):
    T.write_table(frame(spark, [(1, "a")]), name, root=root)
    described = spark.sql(f"DESCRIBE QUERY SELECT * FROM {name}").collect()
    assert [(r.col_name, r.data_type) for r in described] == [("id", "bigint"), ("name", "string")]
    assert "Physical Plan" in spark.sql(f"EXPLAIN FORMATTED SELECT * FROM {name} WHERE id = 1").first()[0]


def test_a_table_made_elsewhere_takes_appends_once(spark, name, root):
    T.ensure_namespace(spark, name.split(".")[0], root)
    frame(spark, [(1, "a")], "id long, Location string").write.saveAsTable(name)
    done = T.write_table(frame(spark, [(2, "b")], "id long, Location string"), name)
    assert done["rows_written"] == 1 and content(spark, name) == [(1, "a"), (2, "b")]


def test_an_empty_append_does_not_widen_the_table(spark, name, root):
    T.write_table(frame(spark, [(1, "a")]), name, root=root)
    done = T.write_table(frame(spark, [], "id long, name string, extra int"), name, on_drift="merge")
    assert done["status"] == "skipped" and spark.table(name).columns == ["id", "name"]


def test_an_old_version_has_the_columns_that_came_later(spark, name, root):
    first = T.write_table(frame(spark, [(1, "a")]), name, root=root)
    T.write_table(frame(spark, [(2, "b", 7)], "id long, name string, extra int"), name, on_drift="merge")
    old = T.read_version(spark, name, first["snapshot_id"])
    assert sorted(map(tuple, old.collect())) == [(1, "a", None), (2, "b", 7)]


def test_query_text_takes_its_values_from_markers(spark, name, root):
    T.write_table(frame(spark, [(1, "a"), (2, "b' or 1 = 1 --"), (3, "c")]), name, root=root)
    read = lambda *a, **k: sorted(r.id for r in T.read_table(spark, name, *a, **k).collect())
    assert read() == read("", 0) == read(limit=None) == [1, 2, 3]
    assert read("id >= :least", args={"least": 2}) == [2, 3]
    assert read("name = :name", args={"name": "b' or 1 = 1 --"}) == [2]
    assert len(read("id > 0", 2)) == 2 and read("id = 3") == [3]
