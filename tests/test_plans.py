"""Plan shapes that the scale design depends on (checked on the physical plan)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchange_inputs(plan: str) -> list[str]:
    """The ``Input`` list of every Exchange node of a formatted plan."""
    out = []
    for m in re.finditer(r"\(\d+\) (?:Exchange|ShuffleExchange)[^\n]*\n((?:[^\n]+\n)*?)\n", plan):
        body = m.group(1)
        inp = re.search(r"Input \[\d+\]: \[([^\]]*)\]", body)
        out.append(inp.group(1) if inp else "")
    return out


def plans_of_checkpoints(monkeypatch) -> list[str]:
    """The formatted plans of the checkpoints made from here on."""
    from pyspark.sql.classic.dataframe import DataFrame

    plans, checkpoint = [], DataFrame.checkpoint

    def watched(self, *args, **kwargs):
        plans.append(formatted(self))
        return checkpoint(self, *args, **kwargs)

    monkeypatch.setattr(DataFrame, "checkpoint", watched)
    return plans


@pytest.fixture
def static_plans(spark):
    # no runtime re-planning and no size-based broadcast: the plan a large
    # input would get
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_dashboard_reads_each_input_twice_at_most(static_plans, monkeypatch):
    """Metrics once (their checkpoint serves pairing and result), histories once; surveys for pairing and index."""
    plans = plans_of_checkpoints(monkeypatch)
    plans.append(formatted(entry.queries()["dashboard_base"](static_plans, SF)))
    both = "".join(plans)
    assert len(re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*conversations", both)) <= 2
    assert len(re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*events", both)) <= 2


def test_no_message_text_reaches_the_metrics_aggregate(static_plans):
    """The text moves with the copies of a message (combined map-side); the session-day exchange has sums only."""
    plan = formatted(entry.queries()["session_metrics"](static_plans, SF))
    inputs = exchange_inputs(plan)
    assert len(inputs) == 2, plan
    assert sum("content#" in i for i in inputs) == 1
    assert plan.count("HashAggregate") + plan.count("SortAggregate") >= 4  # partial and final, twice


def test_a_hot_session_day_keeps_its_metrics(spark):
    """A third of all messages in one session-day, and many without a session."""
    from cxlake.operators import messages, sessions

    rows = [
        (("hot" if i % 3 == 0 else None if i % 3 == 1 else f"s{i % 50}"), "u1", "user" if i % 2 else "assistant", f"text {i}", 1704067200 + i % 1000)
        for i in range(6000)
    ]
    df = spark.createDataFrame(rows, "session_id string, balancer_mongo_id string, role string, content string, t bigint")
    df = df.selectExpr("*", "timestamp_seconds(t) AS message_timestamp", "timestamp_seconds(t) AS conversation_expires_at", "timestamp_seconds(t) AS conversation_updated_at").drop("t")
    days = sessions.session_days(messages.with_message_date(df)).collect()
    by = {r["session_id"]: r for r in days}
    assert by["hot"]["cantidad_mensajes"] == len(by["hot"]["history"]) == 2000
    assert by[None]["cantidad_mensajes"] == len(by[None]["history"]) == 2000
    assert sum(r["cantidad_mensajes"] for r in days) == 6000


def test_claim_detail_limits_before_its_only_shuffle(static_plans):
    plan = formatted(entry.queries()["claim_detail"](static_plans, SF))
    assert len(exchange_inputs(plan)) == 1  # the OT shuffle
    assert re.search(r"WindowGroupLimit[^\n]*\n(?:[^\n]+\n)*?Arguments: [^\n]*Partial", plan)


def test_no_json_parsing_in_the_claim_plan(static_plans, tmp_path):
    from cxlake.operators import claims
    from cxlake.sources import fixtures as fx
    from cxlake.sources.scans import read_usage_logs

    fx.usage_logs(static_plans, SF).withColumnRenamed("log_id", "_id").write.json(str(tmp_path / "j"))
    for df in (fx.usage_logs(static_plans, SF), read_usage_logs(static_plans, str(tmp_path / "j")).withColumnRenamed("_id", "log_id")):
        assert formatted(claims.claim_detail(df)).count("get_json_object") == 0


def test_the_single_file_export_keeps_the_width_of_its_aggregate(spark, tmp_path):
    from cxlake.sinks.files import export_parquet

    df = spark.range(1000).selectExpr("id % 7 AS g").groupBy("g").count()
    export_parquet(df, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("part-*.parquet"))) == 1


def test_index_join_is_broadcast(static_plans):
    plan = formatted(entry.queries()["dashboard_base"](static_plans, SF))
    assert "BroadcastExchange" in plan  # the daily index, bounded by days


def _scans(df) -> list[str]:
    """One text per parquet scan of a formatted plan (its detail lines)."""
    plan = formatted(df)
    return [m.group(0) for m in re.finditer(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*", plan)]


@pytest.fixture
def full_metadata(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield spark
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_filters_and_columns_reach_the_scans(full_metadata, tmp_path):
    from cxlake.operators import claims, dashboard
    from cxlake.sources import fixtures as fx

    spark = full_metadata
    fx.usage_logs(spark, SF).write.parquet(str(tmp_path / "logs"))
    fx.messages(spark, SF).write.parquet(str(tmp_path / "m"))
    fx.surveys(spark, SF).write.parquet(str(tmp_path / "s"))

    logs = spark.read.parquet(str(tmp_path / "logs"))
    (scan,) = _scans(claims.claim_detail(logs, excluded_users=["u3"]))
    assert "IsNotNull(ot)" in scan and "Or(IsNull(user),Not(" in scan, scan

    m, s = spark.read.parquet(str(tmp_path / "m")), spark.read.parquet(str(tmp_path / "s"))
    scans = _scans(dashboard.dashboard_base(m, s, "2024-01-31", 31))
    msg = [x for x in scans if "message_timestamp" in x]
    assert msg and all("GreaterThanOrEqual(message_timestamp" in x for x in msg)
    srv = [x for x in scans if "Fecha" in x]
    assert srv and all("GreaterThanOrEqual(Fecha" in x and "EqualTo(AtencionIA,Si)" in x for x in srv)


@pytest.mark.parametrize("partition_by", [None, "Mes"])
def test_a_merge_into_buckets_shuffles_the_source_alone(static_plans, partition_by, monkeypatch):
    """The plan that the store itself runs: the bucketed table's scan has no exchange above it."""
    from dataclasses import replace

    from cxlake.plans import queries as Q
    from cxlake.sinks import tables

    store, tdef = tables.TableStore(static_plans), Q._own_def("claim_detail", partition_by=partition_by, buckets=6)
    prev, cur = Q._loads(static_plans, SF)
    store.save(prev, tdef)
    plans, stage = [], tables.TableStore._stage

    def watched(self, df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(self, df, *rest)

    monkeypatch.setattr(tables.TableStore, "_stage", watched)
    merged = store.save(cur, tdef)
    assert merged.updated > 0 and merged.inserted > 0
    above = plans[0][plans[0].index("FullOuter") : plans[0].index("Bucketed: true")]
    target = above[above.rindex("Sort [") :]  # from the join's sort of the stored side down to its scan
    assert "_t_Usuario" in target and "Exchange" not in target
    rows = static_plans.table(tdef.full_name)
    plain = Q._own_def("claim_detail")
    store.save(prev, plain)
    store.save(cur, plain)
    columns = sorted(rows.columns)
    assert sorted(rows.select(*columns).collect(), key=str) == sorted(static_plans.table(plain.full_name).select(*columns).collect(), key=str)
    for t in (tdef, plain):
        store.drop(t)
    with pytest.raises(ValueError):
        replace(tdef, buckets=0)


def test_exclusion_list_reads_the_logs_once_and_moves_marked_rows_alone(static_plans, monkeypatch):
    plans = plans_of_checkpoints(monkeypatch)
    result = formatted(entry.queries()["claim_user_exclusion_list"](static_plans, SF))
    assert len(plans) == 1 and "orders" not in result
    assert len(re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*orders", plans[0])) == 1
    # on the way to the checkpoint only the list and its words are shuffled
    assert not [i for i in exchange_inputs(plans[0]) if "o_orderkey" in i or "log_id" in i]
    # past it, rows with log_id are shuffled by their number, after the test of their marks
    assert sum("log_id" in i for i in exchange_inputs(result)) == 1
    assert re.search(r"Condition : \(size\(_users#\d+L?, false\) > 0\)", result)
