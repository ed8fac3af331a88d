import datetime as dt

import pytest
from pyspark.errors import PySparkException


from cxlake.operators.merge import merge_frames
from cxlake.plans.tabledef import TableDef
from cxlake.sinks.tables import ConcurrentSaveError, EmptyResultError, TableStore

SCHEMA = "k STRING, m STRING, v DOUBLE"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def mk(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_merge_semantics(spark):
    target = mk(spark, [("a", "1", 1.0), ("b", "1", 2.0), ("b", "1", 2.5), (None, "1", 9.0), ("c", None, 3.0)])
    source = mk(spark, [("b", "1", 20.0), ("d", "1", 4.0), (None, "1", 8.0), ("c", None, 30.0)])
    out = merge_frames(target, source, ["k", "m"])
    # a kept; both b rows updated (duplicate target rows stay duplicated);
    # d inserted; NULL keys never match: kept and inserted again
    got = sorted(map(str, rows(out)))
    want = sorted(
        map(
            str,
            [
                ("a", "1", 1.0),
                ("b", "1", 20.0),
                ("b", "1", 20.0),
                ("d", "1", 4.0),
                (None, "1", 9.0),
                (None, "1", 8.0),
                ("c", None, 3.0),
                ("c", None, 30.0),
            ],
        )
    )
    assert got == want


def test_merge_is_idempotent_for_non_null_keys(spark):
    target = mk(spark, [("a", "1", 1.0), ("b", "1", 2.0)])
    source = mk(spark, [("b", "1", 5.0), ("e", "2", 6.0)])
    once = merge_frames(target, source, ["k", "m"])
    twice = merge_frames(once, source, ["k", "m"])
    assert rows(once) == rows(twice)


def test_merge_duplicate_source_rows_matching_a_target_row_raise(spark):
    target = mk(spark, [("a", "1", 1.0)])
    source = mk(spark, [("a", "1", 5.0), ("a", "1", 6.0)])
    with pytest.raises(PySparkException, match="several source rows"):
        merge_frames(target, source, ["k", "m"]).collect()


def test_merge_duplicate_source_rows_without_target_are_inserted(spark):
    target = mk(spark, [("a", "1", 1.0)])
    source = mk(spark, [("z", "1", 5.0), ("z", "1", 6.0)])
    assert len(merge_frames(target, source, ["k", "m"]).collect()) == 3


def test_merge_plan_shuffles_each_side_once(spark):
    target = mk(spark, [("a", "1", 1.0)])
    source = mk(spark, [("z", "1", 5.0)])
    plan = merge_frames(target, source, ["k", "m"])._jdf.queryExecution().executedPlan().toString()
    # window count and full outer join share one hash partitioning per side
    assert plan.count("Exchange hashpartitioning") <= 2


def test_store_merge_overwrite_append_compact(spark):
    store = TableStore(spark)
    tdef = TableDef(
        name="t_merge",
        origin="python",
        python_source="x",
        mode="merge",
        primary_key=("k", "m"),
        schema_ddl=SCHEMA,
        partition_by="m",
    )
    r1 = store.save(mk(spark, [("a", "1", 1.0), ("b", "2", 2.0)]), tdef)
    assert (r1.inserted, r1.updated, r1.copied) == (2, 0, 0)
    r2 = store.save(mk(spark, [("b", "2", 20.0), ("c", "1", 3.0)]), tdef)
    assert (r2.inserted, r2.updated, r2.copied) == (1, 1, 1)
    t = spark.table("t_merge")
    assert sorted(tuple(r) for r in t.select("k", "m", "v").collect()) == [
        ("a", "1", 1.0),
        ("b", "2", 20.0),
        ("c", "1", 3.0),
    ]
    # re-running the same merge changes nothing
    store.save(mk(spark, [("b", "2", 20.0), ("c", "1", 3.0)]), tdef)
    assert spark.table("t_merge").count() == 3

    # overwrite the table from a query that reads the same table
    ow = TableDef(name="t_merge", origin="python", python_source="x", mode="overwrite", partition_by="m")
    src = spark.table("t_merge").where("k <> 'a'")
    store.save(src, ow)
    assert spark.table("t_merge").count() == 2

    ap = TableDef(name="t_merge", origin="python", python_source="x", mode="APPEND", partition_by="m")
    store.save(mk(spark, [("x", "9", 9.0)]), ap)
    assert spark.table("t_merge").count() == 3

    before = rows(spark.table("t_merge").select("k", "m", "v"))
    res = store.compact(ow, num_files=1)
    assert res.rows_written == 3
    assert rows(spark.table("t_merge").select("k", "m", "v")) == before


def test_empty_result_raises_and_leaves_table(spark):
    store = TableStore(spark)
    tdef = TableDef(name="t_empty", origin="python", python_source="x", mode="overwrite")
    store.save(mk(spark, [("a", "1", 1.0)]), tdef)
    with pytest.raises(EmptyResultError):
        store.save(mk(spark, []), tdef)
    assert spark.table("t_empty").count() == 1
    relaxed = TableDef(name="t_empty", origin="python", python_source="x", mode="overwrite", fail_if_empty=False)
    store.save(mk(spark, []), relaxed)
    assert spark.table("t_empty").count() == 0


def test_create_from_ddl(spark):
    store = TableStore(spark)
    tdef = TableDef(
        name="t_created",
        origin="python",
        python_source="x",
        mode="merge",
        primary_key=("k",),
        schema_ddl="k STRING, ts TIMESTAMP, n BIGINT",
    )
    store.create(tdef)
    assert store.exists(tdef)
    assert [f.name for f in spark.table("t_created").schema.fields] == ["k", "ts", "n"]
    store.create(tdef)  # no-op when present


def test_table_def_validation():
    with pytest.raises(ValueError):
        TableDef(name="x", origin="python", python_source="f", mode="replace")
    with pytest.raises(ValueError):
        TableDef(name="x", origin="nosql")
    with pytest.raises(ValueError):
        TableDef(name="x", origin="python", python_source="f", mode="merge")
    assert TableDef(name="t", origin="sql", query_sql_path="q.sql", catalog="c", database="d").full_name == "c.d.t"


def _file_times(spark, name):
    rows = spark.table(name).select("m", "_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    return {(r[0], r[1]): r[2] for r in rows}


def test_merge_rewrites_only_touched_partitions(spark):
    store = TableStore(spark)
    tdef = TableDef(
        name="t_incr", origin="python", python_source="x", mode="merge", primary_key=("m", "k"), schema_ddl=SCHEMA, partition_by="m"
    )
    store.save(mk(spark, [("a", "1", 1.0), ("b", "2", 2.0), ("c", "3", 3.0)]), tdef)
    before = _file_times(spark, "t_incr")
    r = store.save(mk(spark, [("b", "2", 20.0), ("d", "4", 4.0)]), tdef)
    assert (r.inserted, r.updated, r.copied) == (1, 1, 0)  # partitions 1 and 3 were not even read
    after = _file_times(spark, "t_incr")
    same = {k[0] for k in set(before) & set(after)}
    assert same == {"1", "3"}
    assert rows(spark.table("t_incr").select("k", "m", "v")) == rows(
        mk(spark, [("a", "1", 1.0), ("b", "2", 20.0), ("c", "3", 3.0), ("d", "4", 4.0)])
    )
    # a full overwrite drops partitions that are no longer present, one by partitions keeps them
    ow = TableDef(name="t_incr", origin="python", python_source="x", mode="overwrite", partition_by="m")
    store.save(mk(spark, [("z", "9", 9.0), ("y", "1", 8.0)]), ow)
    assert rows(spark.table("t_incr").select("k", "m", "v")) == rows(mk(spark, [("y", "1", 8.0), ("z", "9", 9.0)]))
    part = TableDef(name="t_incr", origin="python", python_source="x", mode="overwrite_partitions", partition_by="m")
    store.save(mk(spark, [("w", "9", 1.0)]), part)
    assert rows(spark.table("t_incr").select("k", "m", "v")) == rows(mk(spark, [("y", "1", 8.0), ("w", "9", 1.0)]))


VALUES = {
    "string": ["a", "", "x/y:z=%", None],
    "boolean": [True, False, None],
    "double": [1.5, -2.0, None],
    "date": [dt.date(2024, 1, 31), None],
    "int": [7, None],
}


@pytest.mark.parametrize("kind", list(VALUES))
def test_partitioned_saves_keep_every_row(spark, kind):
    """NULL and non-text partition values, saved twice, merged twice, appended."""
    store = TableStore(spark)
    data = [(f"k{i}", v) for i, v in enumerate(VALUES[kind])]
    # Spark stores an empty text as the NULL partition: the row is kept
    stored = sorted(((k, None if v == "" else v) for k, v in data), key=str)
    frame = spark.createDataFrame(data, f"k STRING, p {kind}")
    ow = TableDef(name=f"t_part_{kind}", origin="python", python_source="x", partition_by="p")
    for _ in range(2):
        assert store.save(frame, ow).rows_written == len(data)
        assert rows(spark.table(ow.full_name).select("k", "p")) == stored
    mg = TableDef(
        name=f"t_pmerge_{kind}", origin="python", python_source="x", mode="merge", primary_key=("k", "p"), partition_by="p", schema_ddl=f"k STRING, v INT, p {kind}"
    )
    for v in (1, 2):
        store.save(frame.selectExpr("k", f"{v} AS v", "p"), mg)
        # NULL keys never match: they are inserted again, and nothing is lost
        again = sum(x[1] is None for x in data)
        assert spark.table(mg.full_name).count() >= len(data) + (v - 1) * again
    assert spark.table(mg.full_name).where("p IS NOT NULL AND v = 1").count() == 0


def test_a_table_changed_meanwhile_is_not_overwritten(spark, monkeypatch):
    store, other = TableStore(spark), TableStore(spark)
    tdef = TableDef(name="t_race", origin="python", python_source="x", mode="overwrite")
    store.save(mk(spark, [("a", "1", 1.0)]), tdef)
    stage = store._stage

    def stage_then_lose(*args):
        out = stage(*args)
        other.append(mk(spark, [("b", "2", 2.0)]), tdef)
        return out

    monkeypatch.setattr(store, "_stage", stage_then_lose)
    with pytest.raises(ConcurrentSaveError):
        store.save(mk(spark, [("c", "3", 3.0)]), tdef)
    assert rows(spark.table("t_race").select("k")) == [("a",), ("b",)]


def test_create_from_a_ddl_file(spark, tmp_path):
    ddl = tmp_path / "t.sql"
    ddl.write_text("CREATE TABLE IF NOT EXISTS {full_name} (k STRING COMMENT '{primary_key}', m STRING) USING parquet {partition_by}")
    tdef = TableDef(name="t_ddl", origin="python", python_source="x", ddl_path=str(ddl), primary_key=("k",), partition_by="m")
    store = TableStore(spark)
    store.create(tdef)
    assert spark.table("t_ddl").columns == ["k", "m"] and spark.catalog.listColumns("t_ddl")[1].isPartition
    store.drop(tdef)
    assert not store.exists(tdef)


IDENTITY = dict(origin="python", python_source="x", primary_key=("m", "k"), identity=("k",), mode="merge")


def everything(spark, store, t):
    return rows(spark.table(t.full_name).select("k", "m", "v"))


@pytest.mark.parametrize("partition_by,buckets", [("m", None), (None, None), ("m", 3), (None, 3)])
def test_merge_by_identity_moves_rows(spark, partition_by, buckets):
    import uuid

    store = TableStore(spark)
    t = TableDef(f"t_{uuid.uuid4().hex[:10]}", partition_by=partition_by, buckets=buckets, **IDENTITY)
    store.save(mk(spark, [("a", "1", 1.0), ("b", "1", 2.0), ("c", "2", 3.0), ("d", None, 4.0), (None, "1", 9.0), ("e", "it's", 5.0)]), t)
    r = store.save(mk(spark, [("a", "3", 10.0), ("b", "1", 20.0), ("c", "1", 30.0), ("f", "1", 6.0), ("d", "1", 40.0), ("e", None, 50.0), (None, "1", 8.0)]), t)
    # months 2 and it's have lost their rows, and so has the one of NULLs before e came
    assert everything(spark, store, t) == rows(mk(spark, [
        ("a", "3", 10.0), ("b", "1", 20.0), ("c", "1", 30.0), ("d", "1", 40.0), ("e", None, 50.0), ("f", "1", 6.0), (None, "1", 9.0), (None, "1", 8.0)
    ]))
    assert (r.inserted, r.updated, r.moved, r.copied) == (2, 1, 4, 1)
    with pytest.raises(PySparkException, match="several source rows have one identity"):
        store.save(mk(spark, [("a", "1", 1.0), ("a", "2", 2.0)]), t)
    store.drop(t)
    assert not spark.catalog.tableExists(f"{t.full_name}_places")


def test_merge_by_identity_reads_and_replaces_touched_partitions_only(spark):
    import uuid

    store = TableStore(spark)
    t = TableDef(f"t_{uuid.uuid4().hex[:10]}", partition_by="m", **IDENTITY)
    store.save(mk(spark, [(f"k{i}", str(i % 6), float(i)) for i in range(60)]), t)
    before = {r["file"]: r["part"] for r in store.files(t).collect()}
    # k0 sat in month 0 and comes to month 1; k7 stays in month 1
    r = store.save(mk(spark, [("k0", "1", 100.0), ("k7", "1", 70.0)]), t)
    after = {r["file"] for r in store.files(t).collect()}
    assert {part for f, part in before.items() if f not in after} == {"0", "1"}
    assert (r.moved, r.updated, r.copied) == (1, 1, 18)
    # the map is made anew when another mode has written
    from dataclasses import replace as changed

    store.save(mk(spark, [("k1", "5", 1.5), ("new", "4", 0.0)]), changed(t, mode="append", identity=()))
    store.save(mk(spark, [("new", "0", 1.0), ("k1", "2", 2.0)]), t)  # k1 was in two months
    got = everything(spark, store, t)
    assert ("new", "0", 1.0) in got and [x for x in got if x[0] in ("k1", "new")] == [("k1", "2", 2.0), ("new", "0", 1.0)]
    assert len(got) == 61
    store.drop(t)


def test_a_merge_by_identity_that_breaks_off_is_repaired_by_the_same_save(spark, monkeypatch):
    import uuid

    store = TableStore(spark)
    t = TableDef(f"t_{uuid.uuid4().hex[:10]}", partition_by="m", **IDENTITY)
    store.save(mk(spark, [("a", "1", 1.0), ("b", "2", 2.0), ("c", "2", 3.0)]), t)
    publish = TableStore._publish

    def lost(self, path, tdef, version, how):
        if tdef.name == t.name:
            raise RuntimeError("lost")
        return publish(self, path, tdef, version, how)

    source = mk(spark, [("a", "2", 10.0)])
    monkeypatch.setattr(TableStore, "_publish", lost)
    with pytest.raises(RuntimeError, match="lost"):
        store.save(source, t)
    monkeypatch.setattr(TableStore, "_publish", publish)
    for _ in range(2):
        store.save(source, t)
        assert everything(spark, store, t) == [("a", "2", 10.0), ("b", "2", 2.0), ("c", "2", 3.0)]
    store.drop(t)


def test_compaction_leaves_good_partitions_alone(spark):
    import uuid

    store = TableStore(spark)
    t = TableDef(f"t_{uuid.uuid4().hex[:10]}", "python", python_source="x", mode="append", partition_by="m")
    for parts in ("1234", "12", "1"):
        store.save(mk(spark, [(f"k{i}", p, float(i)) for p in parts for i in range(5)] + ([("n", None, 0.0)] if parts != "12" else [])), t)
    files = lambda: {(r["part"], r["file"]) for r in store.files(t).collect()}
    content, before = rows(spark.table(t.full_name)), files()
    many = {p for p, _ in before if sum(q == p for q, _ in before) > 1}
    assert many == {"1", "2", None}
    r = store.compact(t, small_bytes=1 << 20)
    after = files()
    assert {p for p, f in before & after} == {"3", "4"} and not {p for p, f in before & after} & many
    assert len(after) == 5 and r.rows_written == 15 + 10 + 2
    assert rows(spark.table(t.full_name)) == content
    assert store.compact(t, small_bytes=1 << 20).rows_written == 0 and files() == after
    store.drop(t)
