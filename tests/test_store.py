"""Upsert, versions, change feed, table maintenance (SNK-1..SNK-9, AGG-9)."""

import re

import pytest
from pyspark.sql import functions as F

from framelake.sinks import store


def _frames(spark, rows):
    return spark.createDataFrame(rows, "frame_id string, video_id string, width int")


def test_merge_result_updates_and_inserts(spark):
    t = _frames(spark, [("a", "v", 1), ("b", "v", 1)])
    s = _frames(spark, [("b", "v", 2), ("c", "v", 2)])
    got = sorted(tuple(r) for r in store.merge_result(t, s, ["frame_id"]).collect())
    assert got == [("a", "v", 1), ("b", "v", 2), ("c", "v", 2)]


def _rows(spark, path):
    return sorted(tuple(r) for r in store.read_path(spark, path).collect())


def test_path_upsert_is_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/frames"
    first = _frames(spark, [("a", "v", 1), ("b", "v", 1)])
    assert store.upsert(spark, path, first, ["frame_id"]) == "created"
    inc = _frames(spark, [("b", "v", 2), ("c", "v", 2)])
    assert store.upsert(spark, path, inc, ["frame_id"]) == "merged"
    once = _rows(spark, path)
    assert store.upsert(spark, path, inc, ["frame_id"]) == "merged"
    assert once == _rows(spark, path) == [("a", "v", 1), ("b", "v", 2), ("c", "v", 2)]
    assert store.read_path(spark, path).columns == first.columns


@pytest.fixture
def table(spark):
    """Names of tables that are dropped at the end."""
    made = []

    def drop(n):
        for x in (n, f"{n}__inc", f"{n}__merged", f"{n}__old", f"{n}__staged"):
            if store.table_exists(spark, x) and store.Layout.of(spark, x):
                store.drop_keyed(spark, x)
            spark.sql(f"DROP TABLE IF EXISTS {x}")

    def name(n):
        made.append(n)
        drop(n)
        return n

    yield name
    for n in made:
        drop(n)


def _table_rows(spark, name):
    return sorted(tuple(r) for r in store.read_table(spark, name).collect())


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_only_touched_partitions_are_rewritten(spark, table):
    name = table("fl_many")
    rows = [(f"k{i}", "v", 1) for i in range(200)]
    assert store.upsert(spark, name, _frames(spark, rows), ["frame_id"], parts=8, buckets=4) == "created"
    before = set(spark.table(name).inputFiles())
    assert store.upsert(spark, name, _frames(spark, [("k7", "v", 2)]), ["frame_id"]) == "merged"
    after = set(spark.table(name).inputFiles())
    assert len(before) == len(after) == 32 and len(before - after) == 4  # the four buckets of one partition
    assert _table_rows(spark, name) == sorted([r for r in rows if r[0] != "k7"] + [("k7", "v", 2)])
    assert store.upsert(spark, name, _frames(spark, [("k7", "v", 2)]), ["frame_id"]) == "merged"
    assert spark.table(name).count() == 200 and not spark.catalog.tableExists(f"{name}__merged")
    fs, _ = store._fs(spark, store._described(spark, name)["Location"])
    folders = {f.rsplit("/", 2)[0] for f in spark.table(name).inputFiles()}
    store.drop_keyed(spark, name)
    assert len(folders) == 2 and not any(fs.exists(store._fs(spark, f)[1]) for f in folders)


def test_merge_shuffles_neither_side(spark, table):
    name, inc = table("fl_plan"), table("fl_plan_inc")
    first = spark.range(5000).select(F.col("id").cast("string").alias("frame_id"), F.lit("v").alias("video_id"), F.lit(1).alias("width"))
    store.create_keyed(spark, name, first, ["frame_id"], parts=2, buckets=6)
    store.create_keyed(spark, inc, first.where("id % 3 = 0").withColumn("width", F.lit(2)), ["frame_id"], parts=2, buckets=6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t, s = spark.table(name), spark.table(inc)
        plans = [_plan(store.keyed_merge(t, s, ["frame_id"])), _plan(s.select("frame_id").join(t.select("frame_id"), ["frame_id"], "left_semi")),
                 _plan(s.groupBy("frame_id").count().where("count > 1"))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("Exchange" not in p for p in plans) and plans[0].count("SortMergeJoin") == 1
    assert store.keyed_merge(t, s, ["frame_id"]).groupBy("width").count().orderBy("width").collect() == [(1, 3333), (2, 1667)]


def test_new_keys_are_inserted_and_columns_evolve(spark, table):
    name = table("fl_evolve")
    store.upsert(spark, name, spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "k string, x int, y int"), ["k"], parts=2, buckets=2)
    files = set(spark.table(name).inputFiles())
    assert store.upsert(spark, name, spark.createDataFrame([("c", 1, 30)], "k string, x int, y int"), ["k"]) == "appended"
    assert files < set(spark.table(name).inputFiles())
    wide = spark.createDataFrame([("b", 2, 5, "n"), ("d", 2, 6, "n")], "k string, x int, y int, z string")
    with pytest.raises(ValueError, match="columns differ"):
        store.upsert(spark, name, wide, ["k"])
    assert store.upsert(spark, name, wide, ["k"], evolve=True) == "merged"
    assert store.upsert(spark, name, spark.createDataFrame([("b", 7), ("e", 8)], "k string, x int"), ["k"], evolve=True) == "merged"
    assert _table_rows(spark, name) == [("a", 1, 10, None), ("b", 7, 5, "n"), ("c", 1, 30, None), ("d", 2, 6, "n"), ("e", 8, None, None)]
    with pytest.raises(ValueError, match="keyed by"):
        store.upsert(spark, name, wide, ["k", "x"], evolve=True)
    for bad in ([("f", 1), ("f", 2)], [(None, 1)]):
        with pytest.raises(ValueError):
            store.upsert(spark, name, spark.createDataFrame(bad, "k string, x int"), ["k"], evolve=True)
    assert spark.table(name).count() == 5


@pytest.mark.parametrize("switched", [0, 1, 2, 3])
def test_a_merge_cut_short_loses_no_row(spark, table, monkeypatch, switched):
    """The writer dies after some partitions were switched: every row is there, old or new, and a repeat finishes."""
    name = table("fl_cut")
    rows = [(f"k{i}", "v", 1) for i in range(60)]
    store.upsert(spark, name, _frames(spark, rows), ["frame_id"], parts=3, buckets=2)
    inc = _frames(spark, [(f"k{i}", "v", 2) for i in range(50, 70)])
    switch = store._switch

    def die(spark, table, layout, folder, parts):
        switch(spark, table, layout, folder, sorted(parts)[:switched])
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "_switch", die)
    with pytest.raises(RuntimeError, match="lost"):
        store.upsert(spark, name, inc, ["frame_id"])
    monkeypatch.undo()
    got = {r[0]: r[2] for r in _table_rows(spark, name)}
    assert set(got) >= {r[0] for r in rows} and (switched < 3 or len(got) == 70)
    assert store.upsert(spark, name, inc, ["frame_id"]) == "merged"
    assert _table_rows(spark, name) == sorted((f"k{i}", "v", 2 if i >= 50 else 1) for i in range(70))


@pytest.mark.parametrize("step", ["aside", "moved"])
def test_a_swap_of_folders_cut_short_loses_no_row(spark, tmp_dir, step):
    path = f"{tmp_dir}/t"
    store.upsert(spark, path, _frames(spark, [("a", "v", 1), ("b", "v", 1)]), ["frame_id"])
    fs, root = store._fs(spark, path)
    _, old = store._fs(spark, f"{path}__old")
    if step == "aside":  # the present folder was moved aside, the new one not moved in
        _frames(spark, [("a", "v", 2), ("b", "v", 1)]).write.parquet(f"{path}__new")
        fs.rename(root, old)
    else:  # the new one is in, the old one not removed
        _frames(spark, [("z", "v", 0)]).write.parquet(f"{path}__old")
    assert _rows(spark, path) == [("a", "v", 1), ("b", "v", 1)]
    assert store.upsert(spark, path, _frames(spark, [("a", "v", 2), ("c", "v", 2)]), ["frame_id"]) == "merged"
    assert _rows(spark, path) == [("a", "v", 2), ("b", "v", 1), ("c", "v", 2)]
    assert not fs.exists(old)


def test_new_keys_of_a_path_are_appended(spark, tmp_dir):
    path = f"{tmp_dir}/det"
    store.upsert(spark, path, _frames(spark, [("a", "v", 1)]), ["frame_id"])
    for k in "bcd":
        kept = set(spark.read.parquet(path).inputFiles())
        assert store.upsert(spark, path, _frames(spark, [(k, "v", 1)]), ["frame_id"]) == "appended"
        assert kept < set(spark.read.parquet(path).inputFiles())
    assert store.upsert(spark, path, _frames(spark, [("b", "v", 9)]), ["frame_id"]) == "merged"
    assert _rows(spark, path) == [("a", "v", 1), ("b", "v", 9), ("c", "v", 1), ("d", "v", 1)]


def test_plain_parquet_is_merged_and_overwritten(spark, tmp_dir):
    path = f"{tmp_dir}/plain"
    _frames(spark, [("a", "v", 1), ("b", "v", 1)]).write.parquet(path)
    assert store.upsert(spark, path, _frames(spark, [("b", "v", 2)]), ["frame_id"]) == "merged"
    assert _rows(spark, path) == [("a", "v", 1), ("b", "v", 2)]
    store.overwrite(store.read_path(spark, path).withColumn("z", F.lit(1)), path)
    assert _rows(spark, path) == [("a", "v", 1, 1), ("b", "v", 2, 1)]


@pytest.mark.parametrize("rows", [[("a", "v", 1), ("a", "v", 2)], [(None, "v", 1)]])
def test_upsert_rejects_duplicate_or_null_keys(spark, tmp_dir, rows):
    with pytest.raises(ValueError):
        store.upsert(spark, f"{tmp_dir}/x", _frames(spark, rows), ["frame_id"])
    assert store.read_path(spark, f"{tmp_dir}/x") is None  # nothing of the rejected increment is readable
    assert store.upsert(spark, f"{tmp_dir}/x", _frames(spark, [("z", "v", 3)]), ["frame_id"]) == "created"
    assert _rows(spark, f"{tmp_dir}/x") == [("z", "v", 3)]


def test_catalog_table_create_then_merge(spark, table):
    name = table("fl_test_frames")
    assert not store.table_exists(spark, name)
    assert store.upsert(spark, name, _frames(spark, [("a", "v", 1)]), ["frame_id"]) == "created"
    assert store.upsert(spark, name, _frames(spark, [("a", "v", 5), ("b", "v", 1)]), ["frame_id"]) == "merged"
    assert _table_rows(spark, name) == [("a", "v", 5), ("b", "v", 1)]
    store.set_table_properties(spark, name, {"domain": "video", "note": "it's"})
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert props["domain"] == "video" and props["note"] == "it's"


def test_table_of_another_layout_is_swapped(spark, table):
    name = table("fl_test_foreign")
    _frames(spark, [("a", "v", 1)]).write.saveAsTable(name)
    assert store.upsert(spark, name, _frames(spark, [("a", "v", 5), ("b", "v", 1)]), ["frame_id"]) == "swapped"
    assert _table_rows(spark, name) == [("a", "v", 5), ("b", "v", 1)]


def test_feature_table_and_overwrite(spark):
    name, snap = "fl_test_features", "fl_test_snapshot"
    for n in (name, snap):
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    store.create_feature_table(spark, name, _frames(spark, [("a", "v", 1)]), "frame_id", "Raw frame features; it's keyed")
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert props["primary_key"] == "frame_id"
    store.overwrite(_frames(spark, [("a", "v", 1)]), snap)
    store.overwrite(spark.createDataFrame([(1,)], "other int"), snap)
    assert spark.table(snap).columns == ["other"]
    for n in (name, snap):
        spark.sql(f"DROP TABLE {n}")


def test_snapshot_changes(spark):
    old = _frames(spark, [("a", "v", 1), ("b", "v", 1), ("c", None, 1)])
    new = _frames(spark, [("a", "v", 1), ("b", "v", 2), ("c", None, 1), ("d", "v", 1)])
    got = sorted((r["frame_id"], r["change_type"]) for r in store.snapshot_changes(old, new, ["frame_id"]).collect())
    assert got == [("b", "update"), ("d", "insert")]
    got = sorted((r["frame_id"], r["change_type"]) for r in store.snapshot_changes(new, old, ["frame_id"]).collect())
    assert got == [("b", "update"), ("d", "delete")]


def test_manifest_parquet_and_csv(spark, tmp_dir):
    df = _frames(spark, [("a", "v", 1)])
    store.write_manifest(df, tmp_dir)
    assert spark.read.parquet(f"{tmp_dir}/manifest.parquet").count() == 1
    assert spark.read.option("header", True).csv(f"{tmp_dir}/manifest.csv").columns == df.columns


def test_snapshot_changes_null_to_value_is_update(spark):
    old = _frames(spark, [("a", None, 1), ("b", "v", None)])
    new = _frames(spark, [("a", "v", 1), ("b", "v", None)])
    got = [(r["frame_id"], r["change_type"]) for r in store.snapshot_changes(old, new, ["frame_id"]).collect()]
    assert got == [("a", "update")]


def test_interrupted_swap_loses_no_row(spark):
    name = "fl_test_swap"
    for n in (name, f"{name}__old", f"{name}__staged"):
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    _frames(spark, [("a", "v", 1), ("b", "v", 1), ("c", "v", 1)]).write.saveAsTable(name)
    # a crash after the present table was moved aside and before the staged one took its place
    store.merge_result(spark.table(name), _frames(spark, [("d", "v", 1)]), ["frame_id"]).write.saveAsTable(f"{name}__staged")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    assert store.upsert(spark, name, _frames(spark, [("d", "v", 2)]), ["frame_id"]) == "swapped"
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [("a", "v", 1), ("b", "v", 1), ("c", "v", 1), ("d", "v", 2)]
    # a crash before the old table was dropped
    spark.table(name).limit(1).write.saveAsTable(f"{name}__old")
    store.recover_table(spark, name)
    assert spark.table(name).count() == 4 and not store.table_exists(spark, f"{name}__old")
    spark.sql(f"DROP TABLE {name}")


def test_column_differences_raise_or_merge(spark, tmp_dir):
    t = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "k string, x int, y int")
    wide = spark.createDataFrame([("b", 2, 5, "n"), ("c", 2, 6, "n")], "k string, x int, y int, z string")
    narrow = spark.createDataFrame([("b", 7)], "k string, x int")
    for s in (wide, narrow):
        with pytest.raises(ValueError, match="columns differ"):
            store.merge_result(t, s, ["k"])
    assert sorted(store.merge_result(t, wide, ["k"], evolve=True).collect()) == [("a", 1, 10, None), ("b", 2, 5, "n"), ("c", 2, 6, "n")]
    assert sorted(store.merge_result(t, narrow, ["k"], evolve=True).collect()) == [("a", 1, 10), ("b", 7, 20)]
    path = f"{tmp_dir}/evolving"
    store.upsert(spark, path, t, ["k"])
    with pytest.raises(ValueError, match="columns differ"):
        store.upsert(spark, path, wide, ["k"])
    store.upsert(spark, path, wide, ["k"], evolve=True)
    store.upsert(spark, path, narrow, ["k"], evolve=True)
    assert sorted(store.read_path(spark, path).select("k", "x", "y", "z").collect()) == [("a", 1, 10, None), ("b", 7, 5, "n"), ("c", 2, 6, "n")]


def test_snapshot_changes_with_null_keys_and_other_columns(spark):
    old = spark.createDataFrame([(None, 1, "x"), ("a", 1, None), ("b", 1, "y")], "k string, v int, gone string")
    new = spark.createDataFrame([(None, 2, 5), ("a", 1, None), ("c", None, None)], "k string, v int, come int")
    got = {(r["k"], r["change_type"]): r for r in store.snapshot_changes(old, new, ["k"]).collect()}
    assert set(got) == {(None, "update"), ("b", "delete"), ("c", "insert")}
    assert got[None, "update"]["_old"].asDict() == {"v": 1, "gone": "x", "come": None} and got[None, "update"]["_new"]["come"] == 5
    assert got["b", "delete"]["_new"] is None and got["c", "insert"]["_old"] is None and got["c", "insert"]["_new"] is not None
    only_keys = store.snapshot_changes(old.select("k"), new.select("k"), ["k"])
    assert sorted((r["k"], r["change_type"]) for r in only_keys.collect()) == [("b", "delete"), ("c", "insert")]


def test_equal_partitions_are_not_read(spark, tmp_dir):
    old = spark.range(3000).select(F.format_string("k%d", "id").alias("k"), (F.col("id") % 7).alias("v"))
    new = old.withColumn("v", F.when(F.col("k") == "k77", -1).otherwise(F.col("v"))).where("k <> 'k5'").union(spark.createDataFrame([("new", 1)], "k string, v long"))
    for df, name in ((old, "old"), (new, "new"), (old.orderBy(F.desc("k")), "again")):
        store.write_snapshot(df, f"{tmp_dir}/{name}", ["k"], parts=32)
    got = store.changes_between(spark, f"{tmp_dir}/old", f"{tmp_dir}/new", ["k"])
    assert sorted((r["k"], r["change_type"]) for r in got.collect()) == [("k5", "delete"), ("k77", "update"), ("new", "insert")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    read = {int(x) for x in re.findall(r"key_part_of_32#\d+ IN \(([\d,]+)\)", plan)[0].split(",")}
    assert len(read) <= 3
    assert store.changes_between(spark, f"{tmp_dir}/old", f"{tmp_dir}/again", ["k"]).isEmpty()
    store.write_snapshot(old.withColumn("z", F.lit(None).cast("int")), f"{tmp_dir}/wide", ["k"], parts=8)
    assert store.changes_between(spark, f"{tmp_dir}/old", f"{tmp_dir}/wide", ["k"]).isEmpty()  # the new column holds nothing
    assert store.changes_between(spark, f"{tmp_dir}/new", f"{tmp_dir}/wide", ["k"]).count() == 3
