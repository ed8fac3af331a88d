"""Conversation pipeline semantics on hand-written messages and surveys."""

import datetime as dt

import pytest

from cxlake.operators import dashboard, messages, sessions

MSG_SCHEMA = (
    "session_id STRING, balancer_mongo_id STRING, role STRING, content STRING, message_timestamp TIMESTAMP_NTZ, "
    "conversation_expires_at TIMESTAMP_NTZ, conversation_updated_at TIMESTAMP_NTZ"
)
SURVEY_SCHEMA = (
    "event_id BIGINT, IdUsuario STRING, Fecha DATE, EvalIA STRING, EvalAcceso STRING, EvalResolvReq STRING, "
    "AtencionIA STRING, OperadorAbre STRING, OperadorCierra STRING"
)
T0 = dt.datetime(2024, 1, 10, 9, 0, 0)
EXP = dt.datetime(2024, 1, 11)
UPD = dt.datetime(2024, 1, 10, 10)


def msg(session, content, minutes=0, role="user", bal="u1", ts=None):
    return (session, bal, role, content, ts or T0 + dt.timedelta(minutes=minutes), EXP, UPD)


def flags(spark, contents):
    df = spark.createDataFrame([msg("s", c, i) for i, c in enumerate(contents)], MSG_SCHEMA)
    return [r.asDict() for r in messages.flag_messages(df).orderBy("message_timestamp").collect()]


def test_regex_traps(spark):
    out = flags(
        spark,
        [
            "vivo en la cruz",  # rut* matches "ru" inside a word
            "mi teléfono es",  # accented word matches (stray whitespace dropped)
            "responde\nsí",  # . does not cross a line break
            "responde que sí",
            "caso CAS-AB12-9 creado y CAS-ZZ",  # first match extracted; case-sensitive
            "caso cas-ab12",
            None,
            "Hubo un problema al crear tu reclamo en este momento",
        ],
    )
    assert [r["pidio_datos"] for r in out] == [1, 1, 0, 0, 0, 0, 0, 1]
    assert [r["ss_creacion_reclamo"] for r in out] == [0, 0, 0, 1, 0, 0, 0, 0]
    assert [r["genero_caso"] for r in out] == [0, 0, 0, 0, 1, 0, 0, 0]
    assert [r["id_reclamo"] for r in out] == ["", "", "", "", "CAS-AB12-9", "", None, ""]
    assert [r["error_reclamos"] for r in out] == [0, 0, 0, 0, 0, 0, 0, 1]


def base(spark, msgs, survey_rows=(), as_of="2024-01-31", days=60, include_history=True):
    m = spark.createDataFrame(msgs, MSG_SCHEMA)
    s = spark.createDataFrame(list(survey_rows), SURVEY_SCHEMA)
    return dashboard.dashboard_base(m, s, as_of, days, include_history=include_history)


def test_duplicates_inflate_sums_not_counts(spark):
    dup = msg("s1", "indique su rut", 0)
    rows = [dup, dup, msg("s1", "gracias", 1, role="assistant")]
    r = base(spark, rows).collect()[0]
    assert r["pidio_datos"] == 2  # the duplicate counts twice
    assert r["cantidad_mensajes"] == 2  # but is one history element
    assert r["estado_reclamo"] == sessions.CLAIM_IN_PROGRESS
    assert r["tipo_sesion"] == sessions.SESSION_ABANDONED  # exactly one user message


def test_history_order_and_ties(spark):
    same = T0
    rows = [
        msg("s1", "b", role="user", ts=same),
        msg("s1", "a", role="assistant", ts=same),
        msg("s1", "z", role="user", ts=T0 - dt.timedelta(seconds=30)),
    ]
    r = base(spark, rows).collect()[0]
    hist = [(h["role"], h["content"]) for h in r["history"]]
    assert hist == [("user", "z"), ("assistant", "a"), ("user", "b")]
    assert r["primer_timestamp"] == "2024-01-10 08:59:30"
    assert r["duracion_segundos"] == 30
    assert r["duracion_minutos"] == 0.5
    assert r["turnos_conversacion"] == 1.5


def test_session_split_by_day_and_zero_user_messages(spark):
    late = dt.datetime(2024, 1, 10, 23, 59)
    rows = [
        msg("s1", "hola", ts=late, role="assistant"),
        msg("s1", "sigo", ts=late + dt.timedelta(minutes=2), role="assistant"),
    ]
    out = {r["message_date"]: r for r in base(spark, rows).collect()}
    assert set(out) == {dt.date(2024, 1, 10), dt.date(2024, 1, 11)}
    assert all(r["tipo_sesion"] == sessions.SESSION_CONVERSATION for r in out.values())


def test_claim_status_chain_and_null_session(spark):
    rows = [
        msg("c", "su caso es CAS-1", 0),
        msg("i", "ya existe un reclamo", 0),
        msg(None, "mi correo electronico", 0),
        msg("n", "hola", 0),
    ]
    out = {r["session_id"]: r for r in base(spark, rows).collect()}
    assert out["c"]["estado_reclamo"] == sessions.CLAIM_CREATED and out["c"]["id_reclamo"] == "CAS-1"
    assert out["i"]["estado_reclamo"] == sessions.CLAIM_INCONCLUSIVE
    assert out["n"]["estado_reclamo"] == sessions.NO_CLAIM
    # a NULL session never reaches its claim status
    assert out[None]["estado_reclamo"] is None and out[None]["pidio_datos"] is None


def test_case_id_max_is_lexicographic(spark):
    rows = [msg("s", "CAS-9", 0), msg("s", "CAS-10", 1)]
    assert base(spark, rows).collect()[0]["id_reclamo"] == "CAS-9"


def test_fifo_match_and_index(spark):
    d = dt.date(2024, 1, 10)
    msgs = [
        msg("s1", "hola", 0, bal="u1"),
        msg("s2", "hola", 60, bal="u1"),
        msg("s3", "hola", 30, bal="u2"),
        msg("s4", "hola", 10, bal=None),
    ]
    srv = [
        (1, "u1", d, "7", "5", "Si", "Si", "robot", "robot"),
        (2, "u1", d, "mal", "5", "No", "Si", "robot", "robot"),  # takes an ordinal, not in the index
        (3, "u1", d, "2", "x", "Si", "No", "robot", "robot"),  # not attended by the assistant
        (4, "u2", d, "5", "7.0", "Si", "Si", "robot", "robot"),
        (5, None, d, "6", "1", "Si", "Si", "robot", "robot"),  # NULL id: index only
        (6, "u2", d, " ", "1", "Si", "Si", "robot", "robot"),  # blank rating: dropped
    ]
    out = {r["session_id"]: r for r in base(spark, msgs, srv).collect()}
    assert (out["s1"]["orden_conv"], out["s1"]["orden_enc"], out["s1"]["eval_ia"]) == (1, 1, 7)
    assert (out["s2"]["orden_conv"], out["s2"]["orden_enc"], out["s2"]["eval_ia"]) == (2, 2, None)
    assert out["s3"]["eval_ia"] == 5 and out["s3"]["eval_acceso"] is None  # '7.0' is not a whole number
    assert out["s4"]["orden_enc"] is None and out["s4"]["orden_conv"] == 1
    # index of the day over ratings 7, 5, 6: (2 promoters - 0) * 100 / 3
    assert all(r["isn"] == 66.67 for r in out.values())


def test_lookback_and_recent(spark):
    msgs = [msg("old", "x", ts=dt.datetime(2023, 12, 1)), msg("new", "x", ts=dt.datetime(2024, 1, 30))]
    b = base(spark, msgs, as_of="2024-01-31", days=10)
    assert [r["session_id"] for r in b.collect()] == ["new"]
    wide = base(spark, msgs, as_of="2024-01-31", days=365)
    recent = dashboard.dashboard_recent(wide, "2024-01-31", 5)
    assert [r["session_id"] for r in recent.collect()] == ["new"]
    assert recent.columns == list(dashboard.RECENT_COLUMNS)


def test_history_free_plan_matches(spark):
    msgs = [msg("s1", "rut", 0), msg("s1", "rut", 0), msg("s1", "ok", 3, role="assistant"), msg("s2", "CAS-7", 5)]
    with_h = base(spark, msgs).drop("history")
    without = base(spark, msgs, include_history=False)
    key = lambda r: str(r)
    assert sorted(with_h.collect(), key=key) == sorted(without.collect(), key=key)


def test_dashboard_plan_shape(spark):
    msgs = [msg("s1", "rut", 0)]
    df = base(spark, msgs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert df.columns == list(dashboard.DASHBOARD_COLUMNS)


def test_text_expiry_columns_are_parsed_leniently(spark):
    schema = MSG_SCHEMA.replace("conversation_expires_at TIMESTAMP_NTZ", "conversation_expires_at STRING").replace(
        "conversation_updated_at TIMESTAMP_NTZ", "conversation_updated_at STRING"
    )
    rows = [
        ("s1", "u1", "user", "hola", T0, "2024-01-11 10:00:00", "not a time"),
        ("s2", "u1", "user", "hola", T0, None, "2024-01-10T11:00:00"),
    ]
    m = spark.createDataFrame(rows, schema)
    s = spark.createDataFrame([], SURVEY_SCHEMA)
    out = {r["session_id"]: r for r in dashboard.dashboard_base(m, s, "2024-01-31", 60).collect()}
    assert out["s1"]["expires_at"] == dt.datetime(2024, 1, 11, 10) and out["s1"]["updated_at"] is None
    assert out["s2"]["expires_at"] is None and out["s2"]["updated_at"] == dt.datetime(2024, 1, 10, 11)


def test_survey_date_as_timestamp_groups_by_day(spark):
    schema = SURVEY_SCHEMA.replace("Fecha DATE", "Fecha TIMESTAMP")
    d = dt.datetime(2024, 1, 10, 8)
    srv = [
        (1, "u1", d, "7", "5", "Si", "Si", "robot", "robot"),
        (2, "u1", d + dt.timedelta(hours=5), "1", "5", "Si", "Si", "robot", "robot"),
    ]
    msgs = [msg("s1", "hola", 0, bal="u1")]
    m = spark.createDataFrame(msgs, MSG_SCHEMA)
    s = spark.createDataFrame(srv, schema)
    row = dashboard.dashboard_base(m, s, "2024-01-31", 60).collect()[0]
    assert row["isn"] == 0.0  # one promoter, one detractor on the same calendar day
    assert row["fecha_encuesta"] == dt.date(2024, 1, 10) and row["orden_enc"] == 1 and row["eval_ia"] == 7


def test_null_role_sorts_first_and_counts_only_in_total(spark):
    rows = [msg("s1", "b", role="assistant", ts=T0), msg("s1", "a", role=None, ts=T0), msg("s1", "c", 1)]
    r = base(spark, rows).collect()[0]
    assert [(h["role"], h["content"]) for h in r["history"]] == [(None, "a"), ("assistant", "b"), ("user", "c")]
    assert (r["cantidad_mensajes"], r["mensajes_usuario"], r["mensajes_bot"]) == (3, 1, 1)


def test_history_chunks_of_a_hot_session(spark):
    """A session-day with most of all messages is spread: no task holds it, and its chunks make its history."""
    from cxlake.operators import sessions
    from cxlake.operators.messages import MESSAGE_COLUMNS, with_message_date

    hot = spark.range(6000).selectExpr(
        "if(id < 4000, null, if(id < 5000, 'hot', cast(id % 50 AS string))) AS session_id", "'b' AS balancer_mongo_id", "if(id % 3 = 0, 'user', 'assistant') AS role",
        "concat('m', id % 1700) AS content", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (id * 7919) % 1700) AS message_timestamp",
        "timestamp_ntz'2024-01-02 00:00:00' AS conversation_expires_at", "timestamp_ntz'2024-01-02 00:00:00' AS conversation_updated_at",
    ).select(*MESSAGE_COLUMNS)
    dated = with_message_date(hot)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        chunks = sessions.history_chunks(dated, 100).checkpoint()
        from pyspark.sql import functions as F

        loads = [r[0] for r in chunks.groupBy(F.spark_partition_id()).agg(F.sum("n_messages")).select("sum(n_messages)").collect()]
        assert max(loads) < sum(loads) / 4
        assert chunks.agg(F.max(F.size("history"))).first()[0] == 100
        days = sessions.session_days(dated, include_history=True)
        want = {(r["session_id"], r["message_date"]): r["history"] for r in days.select("session_id", "message_date", "history").collect()}
        got = {(r["session_id"], r["message_date"]): r["history"] for r in sessions.whole_histories(chunks).collect()}
        assert got == want and (None, next(iter(want))[1]) in want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    with pytest.raises(ValueError):
        sessions.history_chunks(dated, 0)
