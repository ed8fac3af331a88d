"""Claim pipeline semantics on hand-written usage-log rows."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException


from cxlake.operators import claims
from cxlake.sources.scans import USAGE_LOG_SCHEMA

COLS = ["log_id", "ot", "created_at", "fecha_escaneo", "clasificacion", "valor_declarado",
        "user", "usuario", "username", "user_id"]
SCHEMA = "log_id BIGINT, " + ", ".join(f"`{c}` STRING" for c in COLS[1:])


def logs(spark, rows):
    full = [tuple(r) + (None,) * (len(COLS) - len(r)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def detail(spark, rows, **kw):
    out = claims.claim_detail(logs(spark, rows), **kw).collect()
    return {r["OT"]: r for r in out}


def test_event_date_resolution_order(spark):
    got = detail(spark, [
        (1, "A", "2024-01-05T10:00:00", "2024-02-01T00:00:00", "X", "1"),
        # unparsable created_at does NOT fall through to fecha_escaneo
        (2, "B", "not a date", "2024-02-01T00:00:00", "X", "1"),
        # missing created_at uses fecha_escaneo
        (3, "C", None, "2024-03-07 08:09:10", "X", "1"),
        # neither -> dropped
        (4, "D", None, None, "X", "1"),
        # zone suffix is converted to UTC; sub-seconds are cut
        (5, "E", "2024-01-31T23:30:00.750-02:00", None, "X", "1"),
        # a clock time, a year or a month is no date
        (6, "F", "10:15:00", None, "X", "1"),
        (7, "G", "T10:15", None, "X", "1"),
        (8, "H", "2024", None, "X", "1"),
        (9, "I", "2024-3", None, "X", "1"),
        (10, "J", "2024-04-01 07:30", None, "X", "1"),
        (11, "K", "2024-02-30", None, "X", "1"),
    ])
    assert set(got) == {"A", "C", "E", "J"}
    assert got["J"]["Fecha_Creacion"] == dt.datetime(2024, 4, 1, 7, 30, 0)
    assert got["A"]["Mes"] == "2024-01"
    assert got["C"]["Fecha_Creacion"] == dt.datetime(2024, 3, 7, 8, 9, 10)
    assert got["E"]["Mes"] == "2024-02"
    assert got["E"]["Fecha_Creacion"] == dt.datetime(2024, 2, 1, 1, 30, 0)


def test_ot_filters(spark):
    got = detail(spark, [
        (1, None, "2024-01-01", None, "X"),
        (2, "", "2024-01-01", None, "X"),
        (3, "  ", "2024-01-01", None, "X"),
        (4, "0", "2024-01-01", None, "X"),
    ])
    assert set(got) == {"  ", "0"}


def test_user_exclusion_any_field_and_nulls_kept(spark):
    rows = [
        (1, "A", "2024-01-01", None, "X", "1", "bad", None, None, None),
        (2, "B", "2024-01-01", None, "X", "1", None, None, None, "bad"),
        (3, "C", "2024-01-01", None, "X", "1", None, None, None, None),
        (4, "D", "2024-01-01", None, "X", "1", "BAD", None, None, None),
    ]
    got = detail(spark, rows, excluded_users=["bad"])
    assert set(got) == {"C", "D"}  # case-sensitive; NULL users kept
    assert got["C"]["Usuario"] == claims.NO_USER
    assert set(detail(spark, rows)) == {"A", "B", "C", "D"}  # empty list = no filter


def test_user_coalesce_empty_string_wins(spark):
    got = detail(spark, [(1, "A", "2024-01-01", None, "X", "1", None, "", "u2", "u3")])
    assert got["A"]["Usuario"] == ""


def test_class_default_and_exclusion_before_first(spark):
    got = detail(spark, [
        # an early n/a record is skipped: the later classified one wins
        (1, "A", "2024-01-01", None, "n/a", "1"),
        (2, "A", "2024-01-05", None, "Reclamo", "2"),
        # an early unclassified record wins over a later classified one
        (3, "B", "2024-01-01", None, None, "3"),
        (4, "B", "2024-01-05", None, "Reclamo", "4"),
        # empty class stays empty; other spellings are excluded
        (5, "C", "2024-01-01", None, "", "5"),
        (6, "D", "2024-01-01", None, "N/a", "6"),
        (7, "E", "2024-01-01", None, "n/A", "7"),
    ])
    assert got["A"]["Clasificacion"] == "Reclamo"
    assert got["A"]["Valor_Declarado_CLP"] == 2.0
    assert got["B"]["Clasificacion"] == claims.NO_CLASS
    assert got["C"]["Clasificacion"] == ""
    assert "D" not in got and "E" not in got


def test_declared_value_parsing(spark):
    vals = {"A": "12.3456", "B": "1.5d", "C": " 2 ", "D": "1e3", "E": "", "F": None, "G": "x", "H": "-5",
            "I": "2.6755"}
    got = detail(spark, [(i, k, "2024-01-01", None, "X", v) for i, (k, v) in enumerate(vals.items())])
    want = {"A": 12.346, "B": 0.0, "C": 0.0, "D": 1000.0, "E": 0.0, "F": 0.0, "G": 0.0, "H": -5.0, "I": 2.676}
    assert {k: got[k]["Valor_Declarado_CLP"] for k in vals} == want


def test_first_per_ot_tie_break(spark):
    got = detail(spark, [
        (9, "A", "2024-01-01", None, "late-id", "1"),
        (3, "A", "2024-01-01", None, "early-id", "2"),
    ])
    assert got["A"]["Clasificacion"] == "early-id"


def test_rollups(spark):
    rows = [
        (1, "A", "2024-01-01", None, "X", "1.0005"),
        (2, "B", "2024-01-02", None, "X", "2.0005"),
        (3, "C", "2024-01-03", None, "X", "0.001"),
        (4, "D", "2024-02-03", None, "Y", "10"),
    ]
    d = claims.claim_detail(logs(spark, rows))
    summary = {(r["Mes"], r["Clasificacion"]): r for r in claims.claim_summary(d).collect()}
    s = summary[("2024-01", "X")]
    # values rounded to 3 decimals first: 1.001 + 2.001 + 0.001 = 3.003, avg 1.001
    assert (s["Cantidad"], s["Suma_Total_CLP"], s["Promedio_CLP"]) == (3, 3.003, 1.001)
    top = claims.ranked_top(claims.claim_top(d)).collect()
    assert [r["Clasificacion"] for r in top] == ["Y", "X"]
    evo = {(r["Mes"], r["Clasificacion"]): r["Cantidad"] for r in claims.claim_evolution(d).collect()}
    assert evo == {("2024-01", "X"): 3, ("2024-02", "Y"): 1}


def test_average_rounds_half_up_exactly(spark):
    # total 0.005 over 2 rows: exact average 0.0025 -> 0.003 (half-up)
    rows = [(1, "A", "2024-01-01", None, "X", "0.002"), (2, "B", "2024-01-01", None, "X", "0.003")]
    s = claims.claim_summary(claims.claim_detail(logs(spark, rows))).collect()[0]
    assert s["Promedio_CLP"] == 0.003


def test_large_amounts_stay_in_the_totals(spark):
    rows = [(1, "A", "2024-01-01", None, "X", "1e15"), (2, "B", "2024-01-01", None, "X", "10"), (3, "C", "2024-01-01", None, "X", "5e15")]
    d = claims.claim_detail(logs(spark, rows))
    for f in (claims.claim_summary, claims.claim_evolution, claims.claim_top):
        r = f(d).collect()[0]
        assert r["Suma_Total_CLP"] == 6e15 + 10 and r["Cantidad"] == 3
    d.createOrReplaceTempView("large_amounts_v")
    from cxlake.sources.scans import sql_file_source

    r = sql_file_source(spark, "claim_summary.sql", source_table="large_amounts_v").collect()[0]
    assert r["Suma_Total_CLP"] == 6e15 + 10 and r["Promedio_CLP"] == round((6e15 + 10) / 3, 3)
    assert claims.claim_summary(d).collect()[0]["Promedio_CLP"] == r["Promedio_CLP"]


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), 1e30])
def test_amounts_without_an_exact_sum_are_an_error(spark, bad):
    d = spark.createDataFrame([("2024-01", "X", "A", bad), ("2024-01", "X", "B", 1.0)], "Mes STRING, Clasificacion STRING, OT STRING, Valor_Declarado_CLP DOUBLE")
    with pytest.raises(PySparkException):
        claims.claim_summary(d).collect()


def test_averages_of_negative_totals_round_away_from_zero(spark):
    d = spark.createDataFrame([("m", "X", "A", -0.002), ("m", "X", "B", -0.003)], "Mes STRING, Clasificacion STRING, OT STRING, Valor_Declarado_CLP DOUBLE")
    assert claims.claim_summary(d).collect()[0]["Promedio_CLP"] == -0.003


def test_exclusion_list_as_a_table(spark):
    rows = [(1, "A", "2024-01-01", None, "X", "1", "bad", None, None, None), (2, "B", "2024-01-01", None, "X", "1", None, None, None, "worse"),
            (3, "C", "2024-01-01", None, "X", "1", None, "good", None, None), (4, "D", "2024-01-01", None, "X", "1")]
    df = logs(spark, rows)
    names = spark.createDataFrame([("bad",), ("worse",), (None,)], "name STRING")
    want = df.where(claims.not_excluded_user(df, ["bad", "worse", None]))
    for marks in (claims.EXCLUSION_MARKS, 64):  # 64: most rows are marked, none may go for that
        assert sorted(claims.without_users(df, names, marks).collect(), key=str) == sorted(want.collect(), key=str)


def test_long_exclusion_list_with_a_hot_name(spark):
    # a third of the rows has one listed name; repeated rows stay repeated
    rows = [(i, f"OT{i % 50}", "2024-01-01", None, "X", "1", "hot" if i % 3 == 0 else f"u{i % 40}", None, None, f"v{i % 7}") for i in range(900)]
    df = logs(spark, rows + rows[1:30])
    listed = ["hot", "v3", *(f"nobody{i}" for i in range(3000))]
    names = spark.createDataFrame([(n,) for n in listed * 2], "name STRING")
    want = sorted(df.where(claims.not_excluded_user(df, listed)).collect(), key=str)
    for marks in (claims.EXCLUSION_MARKS, 128):
        assert sorted(claims.without_users(df, names, marks).collect(), key=str) == want
    got = claims.claim_detail(df, excluded_users=names)
    assert sorted(got.collect()) == sorted(claims.claim_detail(df, excluded_users=listed).collect())
    # an empty list, and rows without user fields
    assert claims.without_users(df, names.limit(0)).count() == df.count()
    assert claims.without_users(df.drop(*claims.USER_FIELDS), names).count() == df.count()


def test_json_usage_logs_with_typed_schema(spark, scratch, tmp_path):
    from cxlake.sources.scans import read_usage_logs

    p = tmp_path / "logs.json"
    p.write_text(
        '{"_id": "1", "ot": "A", "created_at": {"$date": "2024-05-01T00:00:00Z"}, "valor_declarado": 7}\n'
        '{"_id": "2", "ot": "B", "fecha_escaneo": "2024-06-02T00:00:00", "clasificacion": "Z"}\n'
        '{"_id": "3", "ot": "C", "created_at": {"$date": {"$numberLong": "1704067200000"}}}\n'
    )
    df = read_usage_logs(spark, str(p))
    assert df.schema == USAGE_LOG_SCHEMA
    got = {r["OT"]: r for r in claims.claim_detail(df, tie_breaker="_id").collect()}
    assert got["A"]["Mes"] == "2024-05" and got["A"]["Valor_Declarado_CLP"] == 7.0
    assert got["B"]["Mes"] == "2024-06" and got["B"]["Clasificacion"] == "Z"
    assert got["C"]["Fecha_Creacion"] == dt.datetime(2024, 1, 1, 0, 0, 0)


def test_extended_json_numbers(spark, tmp_path):
    from cxlake.sources.scans import read_usage_logs

    p = tmp_path / "canonical.json"
    p.write_text(
        '{"_id": "1", "ot": {"$numberInt": "123"}, "created_at": "2024-05-01T00:00:00", '
        '"valor_declarado": {"$numberDecimal": "12.50"}, "user_id": {"$numberLong": "42"}}\n'
        '{"_id": "2", "ot": "B", "created_at": "2024-05-02T00:00:00", "valor_declarado": {"$numberDouble": "2.5"}, '
        '"user": {"$numberInt": "7"}}\n'
    )
    df = read_usage_logs(spark, str(p))
    got = {r["OT"]: r for r in claims.claim_detail(df, excluded_users=["7"], tie_breaker="_id").collect()}
    assert set(got) == {"123"}  # B is excluded through its unwrapped numeric user
    assert got["123"]["Valor_Declarado_CLP"] == 12.5 and got["123"]["Usuario"] == "42"


def test_detail_plan_limits_before_shuffle(spark):
    d = claims.claim_detail(logs(spark, [(1, "A", "2024-01-01", None, "X", "1")]))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_presentation_order(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["claim_sorted"](spark, "/root/testdata/sf0.001").collect()
    keys = [(r["Mes"], r["Clasificacion"], r["OT"]) for r in rows]
    assert keys == sorted(keys) and len(keys) > 10
