"""Sources, sinks and the per-table job."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cxlake.functions.text import clean_name, clean_names
from cxlake.plans.catalog import default_table_defs
from cxlake.plans.job import Inputs, build, builtin_builders, run_table_job, with_load_ts
from cxlake.plans.tabledef import TableDef, load_table_defs
from cxlake.sinks import files
from cxlake.sinks.tables import TableStore
from cxlake.sources import fixtures as fx
from cxlake.sources.normalize import normalize_result
from cxlake.sources.scans import parquet_scan, run_sql, sql_file_source, strip_magic, table_sample

SF = "/root/testdata/sf0.001"


def test_clean_names():
    assert clean_name("  Suma Total (CLP) ") == "Suma_Total_CLP"
    assert clean_name("Clasificación") == "Clasificacion"
    with pytest.raises(ValueError):
        clean_names(["a b", "a_b"])


def test_csv_parquet_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("x", 1.5, dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2))],
        "`Clasificación` STRING, `Suma Total` DOUBLE, ts TIMESTAMP, d DATE",
    ).withColumn("dec", F.lit(2.5).cast("decimal(10,2)"))
    files.write_csv(df, str(tmp_path / "c"))
    back = spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "c"))
    assert back.columns == ["Clasificacion", "Suma_Total", "ts", "d", "dec"]
    files.write_parquet(df, str(tmp_path / "p"), csv_path=str(tmp_path / "pc"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
    files.export_parquet(df, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("part-*.parquet"))) == 1
    row = files.json_rows(df).collect()[0]["json"]
    assert '"ts":"2024-01-02T03:04:05"' in row and '"d":"2024-01-02"' in row and '"dec":2.5' in row
    frac = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 120000),)], "ts TIMESTAMP")
    assert files.json_rows(frac).collect()[0]["json"] == '{"ts":"2024-01-02T03:04:05.120000"}'


def test_parquet_scan_missing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        parquet_scan(spark, str(tmp_path / "nope.parquet"))
    assert parquet_scan(spark, f"{SF}/region.parquet").count() == 5


def test_sql_helpers(spark):
    fx.table(spark, SF, "orders").createOrReplaceTempView("orders_v")
    assert strip_magic("%sql SELECT 1") == "SELECT 1"
    df = run_sql(spark, "%sql SELECT o_orderkey FROM orders_v ORDER BY o_orderkey", limit=3)
    assert [r[0] for r in df.collect()] == [0, 1, 2]
    assert table_sample(spark, "orders_v").count() == 10
    with pytest.raises(LookupError):
        table_sample(spark, "no_such_table")


def test_normalize():
    class S:
        pass

    with pytest.raises(ValueError):
        normalize_result(None, None)
    with pytest.raises(ValueError):
        normalize_result(None, pd.DataFrame())
    with pytest.raises(TypeError):
        normalize_result(None, S())


def test_normalize_pandas(spark):
    assert normalize_result(spark, pd.DataFrame({"a": [1]})).count() == 1


def test_load_ts(spark):
    df = with_load_ts(spark.range(1), "2024-05-01 00:00:00")
    assert df.collect()[0]["fecha_carga"] == dt.datetime(2024, 5, 1)


def test_table_jobs_end_to_end(spark):
    store = TableStore(spark)
    inputs = Inputs(
        usage_logs=lambda s: fx.usage_logs(s, SF),
        messages=lambda s: fx.messages(s, SF),
        surveys=lambda s: fx.surveys(s, SF),
        excluded_users=fx.FIXTURE_EXCLUDED_USERS,
        log_tie_breaker="log_id",
        survey_tie_breaker="event_id",
        as_of=fx.FIXTURE_AS_OF,
    )
    builders = builtin_builders(inputs)
    defs = default_table_defs()
    r = run_table_job(spark, defs["claim_detail"], builders, store, load_ts="2024-02-01 00:00:00")
    assert r.inserted == r.rows_written > 0
    again = run_table_job(spark, defs["claim_detail"], builders, store, load_ts="2024-02-02 00:00:00")
    assert again.updated == r.rows_written and again.inserted == 0  # idempotent rerun
    t = spark.table("claim_detail")
    assert t.select(F.max("fecha_carga")).collect()[0][0] == dt.datetime(2024, 2, 2)
    assert t.groupBy("OT").count().where("count > 1").count() == 0
    summary = run_table_job(spark, defs["claim_summary"], builders, store)
    assert summary.rows_written > 0

    dash = TableDef(**{**defs["dashboard_base"].__dict__, "lookback_days": 31})
    run_table_job(spark, dash, builders, store)
    recent = run_table_job(spark, defs["dashboard_recent"], builders, store, sql_params={"as_of": "2024-01-31", "dias": 28})
    assert 0 < recent.rows_written < spark.table("dashboard_base").count()
    assert spark.table("dashboard_recent").where("message_date < date'2024-01-03'").count() == 0
    for name in defs:
        store.drop(defs[name])


def test_all_definitions_twice_through_the_command_line(spark, tmp_path):
    """Every built-in job runs, and a second run with a short lookback loses no day."""
    from cxlake.__main__ import main

    fx.usage_logs(spark, SF).withColumnRenamed("log_id", "_id").write.parquet(str(tmp_path / "logs"))
    fx.messages(spark, SF).write.parquet(str(tmp_path / "messages"))
    fx.surveys(spark, SF).write.parquet(str(tmp_path / "surveys"))
    spark.sql("CREATE DATABASE IF NOT EXISTS twice_db")
    names = list(default_table_defs())
    args = ["--tables", *names, "--database", "twice_db", "--usage-logs", str(tmp_path / "logs"), "--usage-logs-format", "parquet"]
    args += ["--messages", str(tmp_path / "messages"), "--surveys", str(tmp_path / "surveys"), "--survey-tie-breaker", "event_id"]
    wide = tmp_path / "wide.json"
    import json
    from dataclasses import asdict, replace

    defs = default_table_defs("twice_db")
    defs["dashboard_base"] = replace(defs["dashboard_base"], lookback_days=31)
    wide.write_text(json.dumps({"tables": [asdict(d) for d in defs.values()]}))
    last = fx.messages(spark, SF).agg(F.max(F.to_date("message_timestamp"))).first()[0]
    assert main([*args, "--defs", str(wide), "--as-of", str(last)]) == 0
    before = {n: spark.table(f"twice_db.{n}").count() for n in names}
    days = spark.table("twice_db.dashboard_base").select("message_date").distinct().count()
    # the default lookback of three days, ending on the last day there is
    assert main([*args, "--as-of", str(last)]) == 0
    assert spark.table("twice_db.dashboard_base").select("message_date").distinct().count() == days
    after = {n: spark.table(f"twice_db.{n}").count() for n in names}
    assert {n: after[n] for n in names if n != "dashboard_recent"} == {n: before[n] for n in names if n != "dashboard_recent"}
    assert 0 < after["dashboard_recent"] <= before["dashboard_base"]


def test_sql_file_source(spark):
    df = spark.createDataFrame([("2024-01", "X", "A", 1.0005), ("2024-01", "X", "B", 2.0)],
                               "Mes STRING, Clasificacion STRING, OT STRING, Valor_Declarado_CLP DOUBLE")
    df.createOrReplaceTempView("detail_v")
    out = sql_file_source(spark, "claim_summary.sql", source_table="detail_v").collect()[0]
    assert out["Cantidad"] == 2 and out["Suma_Total_CLP"] == 3.001


def test_table_defs_from_json(tmp_path):
    p = tmp_path / "tables.json"
    p.write_text('{"tables": [{"name": "t", "origin": "python", "python_source": "claim_detail", '
                 '"mode": "merge", "primary_key": ["Mes", "OT"]}]}')
    d = load_table_defs(p)["t"]
    assert d.primary_key == ("Mes", "OT") and d.save_mode == "merge"


def test_cli_runs_table_jobs(spark, tmp_path):
    from cxlake.__main__ import main

    logs = tmp_path / "logs.json"
    logs.write_text(
        '{"_id": "1", "ot": "A", "created_at": "2024-01-05T00:00:00", "clasificacion": "X", "valor_declarado": "10"}\n'
        '{"_id": "2", "ot": "B", "created_at": "2024-01-06T00:00:00", "clasificacion": "X", "valor_declarado": "20"}\n'
        '{"_id": "3", "ot": "C", "created_at": "2024-01-07T00:00:00", "user": "bad", "valor_declarado": "30"}\n'
    )
    spark.sql("CREATE DATABASE IF NOT EXISTS cli_db")
    args = ["--tables", "claim_detail", "claim_summary", "--database", "cli_db", "--usage-logs", str(logs)]
    assert main(args + ["--exclude-user", "bad"]) == 0
    assert spark.table("cli_db.claim_detail").count() == 2
    s = spark.table("cli_db.claim_summary").collect()[0]
    assert (s["Cantidad"], s["Suma_Total_CLP"], s["Promedio_CLP"]) == (2, 30.0, 15.0)


def test_metrics_only_dashboard_table(spark):
    from dataclasses import replace

    store = TableStore(spark)
    inputs = Inputs(
        messages=lambda s: fx.messages(s, SF),
        surveys=lambda s: fx.surveys(s, SF),
        survey_tie_breaker="event_id",
        as_of=fx.FIXTURE_AS_OF,
    )
    tdef = replace(
        default_table_defs()["dashboard_base"], name="dash_metrics", lookback_days=31,
        extra={"include_history": False},
    )
    r = run_table_job(spark, tdef, builtin_builders(inputs), store)
    assert r.rows_written > 0 and "history" not in spark.table("dash_metrics").columns


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    rows = [("a;b", 'say "hi"', "line1\nline2", "Ñandú é"), (None, "", " x ", "plain")]
    df = spark.createDataFrame(rows, "c1 STRING, c2 STRING, c3 STRING, c4 STRING")
    files.write_csv(df, str(tmp_path / "awk"))
    back = (
        spark.read.schema(df.schema).option("sep", ";").option("header", True).option("multiLine", True)
        .csv(str(tmp_path / "awk"))
    )
    # text comes back exactly, including blanks, quotes, separators, line
    # breaks and accents; an empty text reads back as NULL (CSV keeps no
    # difference between the two by default, nor did the source product's)
    norm = lambda rs: sorted((tuple(None if v == "" else v for v in r) for r in rs), key=str)
    assert norm(back.collect()) == norm(df.collect())


def test_recent_dashboard_sql_defaults_to_today(spark):
    spark.createDataFrame(
        [("s", "u", dt.date(2024, 1, 30), None, None, None, 1, 1, 0, "Abandono", 0.0, None)],
        "session_id STRING, id STRING, message_date DATE, history ARRAY<STRUCT<role: STRING, content: STRING, "
        "timestamp: STRING>>, fecha_inicio TIMESTAMP, fecha_fin TIMESTAMP, cantidad_mensajes INT, "
        "mensajes_usuario INT, mensajes_bot INT, tipo_sesion STRING, duracion_minutos DOUBLE, isn DOUBLE",
    ).createOrReplaceTempView("dash_v")
    base = dict(source_table="dash_v", dias=3)
    assert sql_file_source(spark, "dashboard_recent.sql", as_of=None, **base).count() == 0  # today is later
    assert sql_file_source(spark, "dashboard_recent.sql", as_of="2024-01-31", **base).count() == 1


def test_error_paths(spark):
    from cxlake.operators.merge import merge_frames

    a = spark.createDataFrame([("k", 1)], "k STRING, v INT")
    b = spark.createDataFrame([("k", 1, 2)], "k STRING, v INT, extra INT")
    with pytest.raises(ValueError, match="extra"):
        merge_frames(a, b, ["k"])
    with pytest.raises(ValueError):
        merge_frames(a, a, [])
    with pytest.raises(FileNotFoundError):
        sql_file_source(spark, "no_such_query.sql")
    tdef = TableDef(name="t_x", origin="python", python_source="nobody")
    with pytest.raises(ValueError, match="nobody"):
        build(spark, tdef, builtin_builders(Inputs()))


def test_cli_reads_catalog_table_and_parquet_inputs(spark, tmp_path):
    from cxlake.__main__ import main
    from cxlake.sources.scans import read_usage_logs

    logs = spark.createDataFrame(
        [("1", "A", "2024-02-05T00:00:00", "X", "10"), ("2", "B", "2024-02-06T00:00:00", "Y", "20")],
        "_id STRING, ot STRING, created_at STRING, clasificacion STRING, valor_declarado STRING",
    )
    logs.write.parquet(str(tmp_path / "logs_pq"))
    assert read_usage_logs(spark, str(tmp_path / "logs_pq"), fmt="parquet").count() == 2
    logs.createOrReplaceTempView("cli_logs_v")
    spark.sql("CREATE DATABASE IF NOT EXISTS cli_db2")
    assert main(["--tables", "claim_top", "--database", "cli_db2", "--usage-logs", "table:cli_logs_v"]) == 0
    top = [r["Clasificacion"] for r in spark.table("cli_db2.claim_top").collect()]
    assert sorted(top) == ["X", "Y"]


def test_nested_values_as_json(spark):
    import json

    df = spark.sql(
        "SELECT array(DATE'2024-01-02', NULL) AS a, named_struct('t', TIMESTAMP'2024-01-02 03:04:05.5', 'd', 1.50BD) AS s, "
        "map(1, TIMESTAMP'2024-01-02 03:04:05') AS m, X'0102' AS b, INTERVAL '1' DAY AS i, CAST(NULL AS STRUCT<x: DATE>) AS n"
    )
    got = json.loads(files.json_rows(df).first()[0])
    assert got["a"] == ["2024-01-02", None] and got["s"] == {"t": "2024-01-02T03:04:05.500000", "d": 1.5}
    assert got["m"] == {"1": "2024-01-02T03:04:05"} and got["b"] == "AQI=" and isinstance(got["i"], str) and got["n"] is None


def test_names_are_transliterated():
    from cxlake.functions.text import clean_name

    assert [clean_name(n) for n in ("Straße", "Ørsted łódź", "  Suma Total (CLP) ", "Æon œuvre", "año")] == [
        "Strasse", "Orsted_lodz", "Suma_Total_CLP", "AEon_oeuvre", "ano"]


def test_sql_marker_is_a_word():
    assert strip_magic("%sql\nSELECT 1") == strip_magic("  %SQL SELECT 1 ") == "SELECT 1"
    assert strip_magic("%sqlfoo") == "%sqlfoo" and strip_magic("%sql") == ""
