"""Runs of several tables: order, shared inputs, tables at the same time, failures."""

import threading
from dataclasses import replace

import pytest

from cxlake.plans.catalog import default_table_defs
from cxlake.plans.job import Inputs, builtin_builders, run_table_graph
from cxlake.plans.tabledef import TableDef
from cxlake.sinks.tables import TableStore
from cxlake.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def small(name, *needs, mode="overwrite", **more):
    return TableDef(name=f"graph_{name}", origin="python", python_source=name, mode=mode, depends_on=needs, **more)


@pytest.fixture
def store(spark):
    s = TableStore(spark)
    yield s
    for r in spark.catalog.listTables():
        if r.name.startswith("graph_"):
            spark.sql(f"DROP TABLE {r.name}")


def test_tables_come_after_those_they_read_and_a_failure_stops_only_these(spark, store):
    order = []

    def made(name):
        def build(s, tdef):
            order.append(name)
            if name == "bad":
                raise ValueError("no such thing")
            return s.range(3) if name == "a" else s.table("graph_a").selectExpr("id + 1 AS id")

        return build

    defs = {"c": small("c", "b"), "b": small("b", "a"), "a": small("a"), "bad": small("bad", "a"), "after": small("after", "bad"), "last": small("last", "after", "b")}
    runs = run_table_graph(spark, defs, defs, {n: made(n) for n in defs}, store)
    assert [r.name for r in runs] == list(defs)
    told = {r.name: (r.status, r.error) for r in runs}
    assert told["a"] == told["b"] == told["c"] == ("saved", None)
    assert told["bad"] == ("failed", "ValueError: no such thing") and told["after"] == ("skipped", "bad") and told["last"] == ("skipped", "after")
    assert order.index("a") < order.index("b") < order.index("c") and "after" not in order and "last" not in order
    assert spark.table("graph_c").count() == 3 and not spark.catalog.tableExists("graph_after")


def test_tables_without_open_dependencies_run_at_the_same_time(spark, store):
    meet = threading.Barrier(3, timeout=60)

    def build(s, tdef):
        meet.wait()  # breaks unless all three are under way
        return s.range(2)

    defs = {n: small(n) for n in "xyz"}
    assert [r.status for r in run_table_graph(spark, defs, defs, dict.fromkeys(defs, build), store, parallel=3)] == ["saved"] * 3


def test_partitions_of_others_survive_when_tables_are_saved_at_the_same_time(spark, store):
    """One thread's overwrite of everything must not reach another's overwrite of partitions."""
    defs = {f"p{i}": small(f"p{i}", mode="overwrite_partitions", partition_by="day") for i in range(4)}
    defs |= {f"w{i}": small(f"w{i}") for i in range(4)}
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for days in ([1, 2], [2, 3], [3, 4]):
        build = lambda s, tdef, days=days: s.createDataFrame([(d, d) for d in days], "id INT, day INT")
        runs = run_table_graph(spark, defs, defs, dict.fromkeys(defs, build), store, parallel=8)
        assert {r.status for r in runs} == {"saved"}, runs
    for name, d in defs.items():
        days = {r["day"] for r in spark.table(d.full_name).collect()}
        assert days == ({1, 2, 3, 4} if name[0] == "p" else {3, 4})
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_claim_tables_share_one_read_of_the_logs(spark, store):
    reads = []

    def logs(s):
        reads.append(1)
        return fx.usage_logs(s, SF)

    names = ["claim_top", "claim_evolution", "claim_summary", "claim_detail"]
    defs = {n: replace(default_table_defs()[n], name=f"graph_{n}") for n in names}
    runs = run_table_graph(spark, names, defs, builtin_builders(Inputs(usage_logs=logs, log_tie_breaker="log_id")), store)
    assert {r.status for r in runs} == {"saved"} and len(reads) == 1


def test_a_circle_or_an_unknown_table_is_an_error_before_anything_runs(spark, store):
    defs = {"a": small("a", "b"), "b": small("b", "a")}
    with pytest.raises(ValueError):
        run_table_graph(spark, defs, defs, {}, store)
    with pytest.raises(ValueError):
        run_table_graph(spark, ["nothing"], defs, {}, store)
    assert run_table_graph(spark, [], defs, {}, store) == []
