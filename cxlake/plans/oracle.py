"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement re-derives its inputs from the driver's tables with the same
expressions as ``cxlake.sources.fixtures`` and then states the operator's
semantics in plain SQL. Column names and types are aliased to equal the Spark
results. Money rounding that must be half-up is done in integer arithmetic,
so it does not depend on how either engine rounds binary doubles.
"""

from __future__ import annotations

# --- input derivations ------------------------------------------------------

USAGE_LOGS = r"""
usage_logs AS (
  SELECT o_orderkey AS log_id,
    CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN ''
         ELSE concat('OT-', CAST(o_custkey AS VARCHAR)) END AS ot,
    CASE WHEN o_orderkey % 31 = 0 THEN 'sin fecha' WHEN o_orderkey % 37 = 0 THEN '10:15:00'
         WHEN o_orderkey % 47 = 0 THEN '2024-3'
         WHEN o_orderkey % 53 = 0 THEN concat(strftime(o_orderdate, '%Y-%m-%d'), ' 07:30')
         WHEN o_orderkey % 29 = 0 THEN NULL
         ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS created_at,
    CASE WHEN o_orderkey % 58 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS fecha_escaneo,
    CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 26 = 1 THEN 'N/A'
         WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS clasificacion,
    CASE WHEN o_orderkey % 17 = 0 THEN 'x' WHEN o_orderkey % 19 = 0 THEN ''
         WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_totalprice AS VARCHAR) END AS valor_declarado,
    CASE WHEN o_orderkey % 5 = 0 THEN concat('u', CAST(o_custkey % 20 AS VARCHAR)) END AS "user",
    CASE WHEN o_orderkey % 3 = 0 THEN concat('u', CAST(o_custkey % 21 AS VARCHAR)) END AS usuario,
    CASE WHEN o_orderkey % 2 = 0 THEN concat('u', CAST(o_custkey % 22 AS VARCHAR)) END AS username,
    CASE WHEN o_orderkey % 11 <> 0 THEN concat('u', CAST(o_custkey % 23 AS VARCHAR)) END AS user_id
  FROM orders
)"""

MESSAGES = r"""
msg_base AS (
  SELECT CAST(conv_id AS VARCHAR) AS session_id, CAST(conv_id % 60 AS VARCHAR) AS balancer_mongo_id, role,
    concat(text, CASE WHEN conv_id % 5 = 0 AND turn = 2 THEN ' ya existe un reclamo'
                      WHEN conv_id % 4 = 0 AND turn = 3 THEN concat(' CAS-', CAST(conv_id AS VARCHAR), '-X')
                      WHEN conv_id % 6 = 0 AND turn = 1 THEN ' indique su telefono'
                      WHEN conv_id % 9 = 0 AND turn = 1 THEN ' no fue posible crear el reclamo porque'
                      ELSE '' END) AS content,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(conv_id * 397 + turn * 7 AS BIGINT)) AS message_timestamp,
    TIMESTAMP '2024-01-02 00:00:00' + to_minutes(CAST(conv_id * 397 AS BIGINT)) AS conversation_expires_at,
    TIMESTAMP '2024-01-01 01:00:00' + to_minutes(CAST(conv_id * 397 AS BIGINT)) AS conversation_updated_at,
    conv_id, turn
  FROM conversations
),
messages AS (
  SELECT session_id, balancer_mongo_id, role, content, message_timestamp, conversation_expires_at,
         conversation_updated_at FROM msg_base
  UNION ALL
  SELECT session_id, balancer_mongo_id, role, content, message_timestamp, conversation_expires_at,
         conversation_updated_at FROM msg_base WHERE conv_id % 8 = 0 AND turn = 0
)"""

SURVEYS = r"""
surveys AS (
  SELECT event_id, CAST(user_id % 50 AS VARCHAR) AS "IdUsuario", CAST(ts AS DATE) AS "Fecha",
    CASE WHEN event_id % 10 = 9 THEN '' WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'mal'
         ELSE CAST(event_id % 9 AS VARCHAR) END AS "EvalIA",
    CAST(event_id % 5 + 1 AS VARCHAR) AS "EvalAcceso",
    CASE WHEN event_id % 2 = 0 THEN 'Si' ELSE 'No' END AS "EvalResolvReq",
    CASE WHEN event_id % 3 = 0 THEN 'No' ELSE 'Si' END AS "AtencionIA",
    CASE WHEN event_id % 7 = 0 THEN 'humano' ELSE 'robot' END AS "OperadorAbre",
    CASE WHEN event_id % 8 = 0 THEN 'humano' ELSE 'robot' END AS "OperadorCierra"
  FROM events
)"""

# --- claim pipeline -----------------------------------------------------------

DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


# A date has its ten characters year-month-day first; what follows, if anything,
# must read as a time of day with at least hours and minutes.
def _event_text(field: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({field}, '[0-9]{{4}}(-[0-9]{{2}}){{2}}(|[T ][0-9]{{2}}:[0-9]{{2}}(|:[0-9]{{2}}(|[.][0-9]+)))')"
        f" THEN try_strptime(rpad(replace({field}, 'T', ' '), 19, substr('0000-00-00 00:00:00', length({field}) + 1)), '%Y-%m-%d %H:%M:%S') END"
    )


EVENT_TS = f"CASE WHEN created_at IS NULL THEN {_event_text('fecha_escaneo')} ELSE {_event_text('created_at')} END"


def _claim_ctes(
    excluded_users: tuple[str, ...] | str = ("u3", "u7"), date_cutoff: str | None = None, prefix: str = ""
) -> str:
    """``excluded_users``: the names, or a query of one column of names."""
    if excluded_users:
        lst = excluded_users if isinstance(excluded_users, str) else ", ".join(f"'{u}'" for u in excluded_users)
        user_filter = " ".join(
            f'AND NOT coalesce({c} IN ({lst}), false)' for c in ('"user"', "usuario", "username", "user_id")
        )
    else:
        user_filter = ""
    cutoff = f"AND ev < TIMESTAMP '{date_cutoff}'" if date_cutoff else ""
    p = prefix
    return f"""
{p}claim_dated AS (
  SELECT *, {EVENT_TS} AS ev
  FROM usage_logs
),
{p}claim_cand AS (
  SELECT ot, ev AS event_ts, coalesce(clasificacion, 'Sin clasificación') AS clasificacion,
    coalesce(CASE WHEN regexp_matches(valor_declarado, '{DECIMAL_TEXT}') THEN try_cast(valor_declarado AS DOUBLE) END, 0.0) AS valor,
    coalesce("user", usuario, username, user_id, 'Sin usuario') AS usuario, log_id
  FROM {p}claim_dated
  WHERE ev IS NOT NULL AND ot IS NOT NULL AND ot <> '' {user_filter} {cutoff}
),
{p}claim_kept AS (
  SELECT * FROM {p}claim_cand WHERE clasificacion NOT IN ('n/a', 'N/A', 'N/a', 'n/A')
),
{p}claim_first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY ot ORDER BY event_ts, log_id) AS rn FROM {p}claim_kept
  ) WHERE rn = 1
),
{p}claim_detail AS (
  SELECT strftime(event_ts, '%Y-%m') AS "Mes", clasificacion AS "Clasificacion", ot AS "OT",
    round(valor, 3) AS "Valor_Declarado_CLP", date_trunc('second', event_ts) AS "Fecha_Creacion",
    usuario AS "Usuario"
  FROM {p}claim_first
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def _half_up_avg(total_dec: str, count: str) -> str:
    """Half-up average to 3 decimals of an exact DECIMAL(*,3) total, as DOUBLE."""
    t = f"CAST(({total_dec}) * 1000 AS HUGEINT)"
    c = f"CAST(({count}) AS HUGEINT)"
    return f"CAST(sign({t}) * ((2 * abs({t}) + {c}) // (2 * {c})) AS DOUBLE) / 1000.0"


MONEY_SUM = 'sum(CAST("Valor_Declarado_CLP" AS DECIMAL(38,3)))'

CLAIM_DETAIL = _with(USAGE_LOGS, _claim_ctes()) + "\nSELECT * FROM claim_detail"

CLAIM_SUMMARY = _with(USAGE_LOGS, _claim_ctes()) + f"""
SELECT "Mes", "Clasificacion", CAST(count(*) AS INTEGER) AS "Cantidad",
  CAST({MONEY_SUM} AS DOUBLE) AS "Suma_Total_CLP",
  {_half_up_avg(MONEY_SUM, "count(*)")} AS "Promedio_CLP"
FROM claim_detail GROUP BY "Mes", "Clasificacion"
"""

CLAIM_EVOLUTION = _with(USAGE_LOGS, _claim_ctes()) + f"""
SELECT "Mes", "Clasificacion", CAST({MONEY_SUM} AS DOUBLE) AS "Suma_Total_CLP",
  CAST(count(*) AS BIGINT) AS "Cantidad"
FROM claim_detail GROUP BY "Mes", "Clasificacion"
"""

CLAIM_TOP = _with(USAGE_LOGS, _claim_ctes()) + f"""
SELECT "Clasificacion", CAST({MONEY_SUM} AS DOUBLE) AS "Suma_Total_CLP",
  CAST(count(*) AS BIGINT) AS "Cantidad",
  {_half_up_avg(MONEY_SUM, "count(*)")} AS "Promedio_CLP"
FROM claim_detail GROUP BY "Clasificacion"
"""


# --- conversation pipeline ------------------------------------------------------

# The message patterns, written here anew: the checks must not share the engine's.
ASKED = "(reclam(o)*|ru(t)*|correo electr(ó|o)nic(o)*|tel(é|e)fon(o)*)"
REQUESTED = "(responde.*sí|ya existe un reclam(o)*)"
CASE = "CAS-[-0-9A-Z]+"
FAILED = "(hubo un problema al crear tu reclamo en este moment(o)*|no fue posible crear el reclamo porqu(e)*)"

AS_OF = "2024-01-31"
DAYS = 31
RECENT_DAYS = 10
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"


def _half_up(num: str, den: str, scale: int) -> str:
    """round(num / den, scale) half-up (away from zero), exact, as DOUBLE."""
    f = 10**scale
    x = f"CAST(({num}) AS HUGEINT) * {f}"
    d = f"CAST(({den}) AS HUGEINT)"
    return f"CAST(sign({x}) * ((2 * abs({x}) + {d}) // (2 * {d})) AS DOUBLE) / {f}.0"


ISN_NUMERATOR = (
    "(sum(CASE WHEN eval_ia IN (6, 7) THEN 1 ELSE 0 END)"
    " - sum(CASE WHEN eval_ia BETWEEN 1 AND 4 THEN 1 ELSE 0 END)) * 100"
)


def _hits(pattern: str, text: str = "lower(content)") -> str:
    return f"coalesce(len(regexp_extract_all({text}, '{pattern}')) > 0, false)"


def _conv_ctes(days: int = DAYS) -> str:
    """Each operator by its specification, on row sets named after what they hold.

    ``copies`` has every message of the lookback with its marks, ``sent`` the
    distinct messages, ``days`` the session-days; answers are numbered by
    counting the earlier ones of the same person."""
    return f"""
copies AS (
  SELECT m.*, CAST(message_timestamp AS DATE) AS message_date,
    {_hits(ASKED)} AS asked, {_hits(REQUESTED)} AS requested, {_hits(FAILED)} AS failed,
    {_hits(CASE, "content")} AS has_case, coalesce(regexp_extract_all(content, '{CASE}')[1], '') AS first_case
  FROM messages m WHERE message_timestamp >= DATE '{AS_OF}' - {days}
),
sent AS (
  SELECT session_id, balancer_mongo_id, role, content, message_timestamp, message_date, conversation_expires_at,
    conversation_updated_at, count(*) FILTER (asked) AS pidio_datos, count(*) FILTER (requested) AS ss_creacion_reclamo,
    CAST(any_value(has_case) AS INTEGER) AS genero_caso,
    CASE WHEN any_value(content) IS NOT NULL THEN any_value(first_case) END AS id_reclamo,
    count(*) FILTER (failed) AS error_reclamos
  FROM copies
  GROUP BY session_id, balancer_mongo_id, role, content, message_timestamp, message_date, conversation_expires_at,
    conversation_updated_at
),
answers AS (
  SELECT CAST("IdUsuario" AS VARCHAR) AS id, "Fecha", "EvalResolvReq" AS resolucion, event_id,
    try_cast(nullif(regexp_extract("EvalIA", '^\\s*([-+]?[0-9]+)\\s*$', 1), '') AS INTEGER) AS eval_ia,
    try_cast(nullif(regexp_extract("EvalAcceso", '^\\s*([-+]?[0-9]+)\\s*$', 1), '') AS INTEGER) AS eval_acceso
  FROM surveys
  WHERE "AtencionIA" = 'Si' AND 'robot' = "OperadorAbre" AND 'robot' = "OperadorCierra"
    AND length(trim(coalesce("EvalIA", ''))) > 0 AND "Fecha" >= DATE '{AS_OF}' - {days}
),
numbered_answers AS (
  SELECT *, CAST(count(*) OVER (PARTITION BY id ORDER BY "Fecha", event_id ROWS UNBOUNDED PRECEDING) AS INTEGER) AS orden_enc
  FROM answers
),
per_day AS (
  SELECT session_id, message_date, max(balancer_mongo_id) AS id, max(conversation_expires_at) AS expires_at,
    max(conversation_updated_at) AS updated_at, min(message_timestamp) AS fecha_inicio, max(message_timestamp) AS fecha_fin,
    CAST(count(*) AS INTEGER) AS cantidad_mensajes, CAST(count(*) FILTER (role = 'user') AS INTEGER) AS mensajes_usuario,
    CAST(count(*) FILTER (role = 'assistant') AS INTEGER) AS mensajes_bot,
    list({{'role': role, 'content': content, 'timestamp': CAST(message_timestamp AS VARCHAR)}}
         ORDER BY message_timestamp NULLS FIRST, role NULLS FIRST, content NULLS FIRST) AS said,
    max(id_reclamo) AS id_reclamo, CAST(sum(pidio_datos) AS BIGINT) AS pidio_datos,
    CAST(sum(ss_creacion_reclamo) AS BIGINT) AS solicitud_creacion_reclamo, max(genero_caso) AS genero_caso,
    CAST(sum(error_reclamos) AS BIGINT) AS error_reclamos
  FROM sent GROUP BY session_id, message_date
),
days AS (
  SELECT * EXCLUDE (said), CAST(to_json(said) AS VARCHAR) AS history,
    CAST(to_json([x for x in said if x.role = 'user']) AS VARCHAR) AS si,
    CAST(fecha_inicio AS VARCHAR) AS primer_timestamp, CAST(fecha_fin AS VARCHAR) AS ultimo_timestamp,
    cantidad_mensajes / 2 AS turnos_conversacion,
    if(mensajes_usuario = 1, 'Abandono', 'Conversacion') AS tipo_sesion,
    date_diff('second', fecha_inicio, fecha_fin) AS duracion_segundos,
    {_half_up("date_diff('second', fecha_inicio, fecha_fin)", "60", 2)} AS duracion_minutos,
    CASE WHEN genero_caso > 0 THEN 'RECLAMO_CREADO' WHEN solicitud_creacion_reclamo > 0 THEN 'RECLAMO_INCONCLUSO'
         WHEN pidio_datos > 0 THEN 'RECLAMO_EN_PROCESO' ELSE 'SIN_RECLAMO' END AS estado_reclamo,
    CAST(count(*) OVER (PARTITION BY id ORDER BY fecha_fin, session_id, message_date ROWS UNBOUNDED PRECEDING) AS INTEGER) AS orden_conv
  FROM per_day
),
daily AS (
  SELECT "Fecha" AS dia, {_half_up(ISN_NUMERATOR, "count(*)", 2)} AS isn
  FROM answers WHERE eval_ia IN (1, 2, 3, 4, 5, 6, 7) GROUP BY 1
),
dashboard AS (
  SELECT days.*, a.orden_enc, a."Fecha" AS fecha_encuesta, a.eval_ia, a.eval_acceso, a.resolucion,
    (SELECT isn FROM daily WHERE dia = days.message_date) AS isn
  FROM days LEFT JOIN numbered_answers a ON a.orden_enc = days.orden_conv AND a.id = days.id
)"""


DASHBOARD_COLUMNS = """session_id, id, message_date, expires_at, updated_at, history, primer_timestamp, ultimo_timestamp,
  fecha_inicio, fecha_fin, cantidad_mensajes, mensajes_usuario, mensajes_bot, turnos_conversacion, tipo_sesion,
  duracion_minutos, duracion_segundos, orden_conv, orden_enc, fecha_encuesta, eval_ia, eval_acceso, resolucion,
  id_reclamo, pidio_datos, solicitud_creacion_reclamo, genero_caso, error_reclamos, estado_reclamo, isn"""
STATUS = "id_reclamo, pidio_datos, solicitud_creacion_reclamo, genero_caso, error_reclamos, estado_reclamo"


def _conv(select: str, days: int = DAYS) -> str:
    return _with(MESSAGES, SURVEYS, _conv_ctes(days)) + "\n" + select.strip()


MSG_FLAG_SELECT = f"""
SELECT session_id, balancer_mongo_id, role, content, message_timestamp, conversation_expires_at,
  conversation_updated_at, CAST(message_timestamp AS DATE) AS message_date,
  CAST({_hits(ASKED)} AS INTEGER) AS pidio_datos, CAST({_hits(REQUESTED)} AS INTEGER) AS ss_creacion_reclamo,
  CAST({_hits(CASE, "content")} AS INTEGER) AS genero_caso,
  CASE WHEN content IS NOT NULL THEN coalesce(regexp_extract_all(content, '{CASE}')[1], '') END AS id_reclamo,
  CAST({_hits(FAILED)} AS INTEGER) AS error_reclamos
FROM messages
"""

def _chunks(where: str = "true") -> str:
    """Every three messages of a session-day, in order."""
    return _conv(f"""
SELECT session_id, message_date, chunk, CAST(min(nth) AS INTEGER) AS first_number, CAST(count(*) AS INTEGER) AS n_messages,
  CAST(to_json(list({{'role': role, 'content': content, 'timestamp': CAST(message_timestamp AS VARCHAR)}} ORDER BY nth)) AS VARCHAR) AS history
FROM (
  SELECT *, CAST((nth - 1) // 3 AS INTEGER) AS chunk FROM (
    SELECT *, row_number() OVER (PARTITION BY session_id, message_date
      ORDER BY message_timestamp NULLS FIRST, role NULLS FIRST, content NULLS FIRST) AS nth FROM sent WHERE {where}))
GROUP BY session_id, message_date, chunk""")


SESSION_METRIC_COLUMNS = """session_id, message_date, primer_timestamp, ultimo_timestamp, fecha_inicio, fecha_fin,
  cantidad_mensajes, mensajes_usuario, mensajes_bot, turnos_conversacion, duracion_minutos, duracion_segundos"""
SURVEY_COLUMNS = 'id, "Fecha", eval_ia, eval_acceso, resolucion, event_id'

CONVERSATION_STATEMENTS = {
    "message_scan": _with(MESSAGES) + "\nSELECT * FROM messages",
    "survey_scan": _with(SURVEYS) + "\nSELECT * FROM surveys",
    "lookback": _with(MESSAGES)
    + f"\nSELECT * FROM messages WHERE CAST(message_timestamp AS DATE) >= DATE '{AS_OF}' - {RECENT_DAYS}",
    "msg_flags": _with(MESSAGES) + MSG_FLAG_SELECT,
    "case_id": f"SELECT session_id, message_timestamp, role, id_reclamo FROM ({_with(MESSAGES)}{MSG_FLAG_SELECT})",
    "msg_dedup": _conv("SELECT * FROM sent"),
    "survey_clean": _conv(f"SELECT {SURVEY_COLUMNS} FROM answers"),
    "survey_order": _conv(f"SELECT {SURVEY_COLUMNS}, orden_enc FROM numbered_answers"),
    "satisfaction_daily": _conv('SELECT dia AS "Fecha", isn FROM daily'),
    "session_day": _conv("SELECT session_id, message_date, id, expires_at, updated_at FROM days"),
    "session_history": _conv("SELECT session_id, message_date, history FROM days"),
    "session_history_chunks": _chunks(),
    "session_user_chunks": _chunks("role = 'user'"),
    "session_history_table": _conv("SELECT session_id, message_date, history FROM days"),
    "session_metrics": _conv(f"SELECT {SESSION_METRIC_COLUMNS} FROM days"),
    "session_user_msgs": _conv("SELECT session_id, message_date, si FROM days"),
    "session_type": _conv("SELECT session_id, message_date, mensajes_usuario, tipo_sesion FROM days"),
    "session_order": _conv("SELECT session_id, message_date, id, fecha_fin, orden_conv FROM days"),
    "claim_status": _conv(f"SELECT message_date, session_id, {STATUS} FROM days"),
    "join_index": _conv("SELECT session_id, message_date, isn FROM dashboard"),
    "fifo_match": _conv(
        "SELECT session_id, message_date, id, orden_conv, orden_enc, fecha_encuesta, eval_ia, eval_acceso, resolucion FROM dashboard"
    ),
    "fifo_match_windows": _conv(
        "SELECT session_id, message_date, id, orden_conv, orden_enc, fecha_encuesta, eval_ia, eval_acceso, resolucion FROM dashboard"
    ),
    "join_status": _conv(f"SELECT session_id, message_date, {STATUS} FROM dashboard"),
    "session_days_ledger": _conv(
        f"SELECT session_id, message_date, id, expires_at, updated_at, {', '.join(SESSION_METRIC_COLUMNS.split(', ')[2:])}, tipo_sesion, {STATUS} FROM days"
    ),
    "dashboard_base": _conv(f"SELECT {DASHBOARD_COLUMNS} FROM dashboard"),
    "dashboard_recent": _conv(
        "SELECT session_id, id, message_date, history, fecha_inicio, fecha_fin, cantidad_mensajes, mensajes_usuario, "
        f"mensajes_bot, tipo_sesion, duracion_minutos, isn FROM dashboard WHERE message_date >= DATE '{AS_OF}' - {RECENT_DAYS}"
    ),
}


# --- claim steps, table operations, sources and sinks ---------------------------

USER_KEEP = " AND ".join(
    f"NOT coalesce({c} IN ('u3', 'u7'), false)" for c in ('"user"', "usuario", "username", "user_id")
)
LISTED_USERS = "SELECT concat('u', CAST(c_custkey AS VARCHAR)) FROM customer WHERE c_acctbal < 0"
PREVIOUS_CUTOFF = "1998-01-01"
LOADS = f"""
prev_load AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS fecha_carga FROM prev_claim_detail),
cur_load AS (SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS fecha_carga FROM claim_detail)"""
MERGED = """
SELECT * FROM cur_load
UNION ALL
SELECT p.* FROM prev_load p
WHERE NOT EXISTS (SELECT 1 FROM cur_load c
                  WHERE c."Mes" = p."Mes" AND c."Clasificacion" = p."Clasificacion" AND c."OT" = p."OT")"""


def _claims(select: str) -> str:
    return _with(USAGE_LOGS, _claim_ctes()) + "\n" + select.strip()


def _two_loads(select: str) -> str:
    return (
        _with(USAGE_LOGS, _claim_ctes(), _claim_ctes((), PREVIOUS_CUTOFF, "prev_"), LOADS)
        + "\n"
        + select.strip()
    )


SUMMARY_SELECT = CLAIM_SUMMARY[CLAIM_SUMMARY.index("\nSELECT"):]

STEP_STATEMENTS = {
    "usage_log_scan": _with(USAGE_LOGS) + "\nSELECT * FROM usage_logs",
    "claim_event_date": _with(USAGE_LOGS) + f"\nSELECT log_id, {EVENT_TS} AS event_ts FROM usage_logs",
    "claim_valid": _with(USAGE_LOGS)
    + f"\nSELECT log_id, ot, event_ts FROM (SELECT *, {EVENT_TS} AS event_ts FROM usage_logs)"
    " WHERE event_ts IS NOT NULL AND ot IS NOT NULL AND ot <> ''",
    "claim_user_exclusion": _with(USAGE_LOGS)
    + f'\nSELECT log_id, "user", usuario, username, user_id FROM usage_logs WHERE {USER_KEEP}',
    "claim_user_exclusion_list": _with(USAGE_LOGS)
    + f'\nSELECT log_id, "user", usuario, username, user_id FROM usage_logs WHERE '
    + " AND ".join(f"NOT coalesce({c} IN ({LISTED_USERS}), false)" for c in ('"user"', "usuario", "username", "user_id")),
    "claim_detail_exclusion_list": _with(USAGE_LOGS, _claim_ctes(LISTED_USERS)) + "\nSELECT * FROM claim_detail",
    "claim_month": _claims(
        "SELECT log_id, CAST(year(event_ts) AS INTEGER) AS year_num, CAST(month(event_ts) AS INTEGER) AS month_num,"
        " strftime(event_ts, '%Y-%m') AS \"Mes\" FROM claim_kept"
    ),
    "claim_class": _claims("SELECT log_id, clasificacion FROM claim_kept"),
    "claim_value": _with(USAGE_LOGS)
    + f"\nSELECT log_id, coalesce(CASE WHEN regexp_matches(valor_declarado, '{DECIMAL_TEXT}')"
    " THEN try_cast(valor_declarado AS DOUBLE) END, 0.0) AS valor FROM usage_logs",
    "claim_user": _with(USAGE_LOGS)
    + "\nSELECT log_id, coalesce(\"user\", usuario, username, user_id, 'Sin usuario') AS usuario FROM usage_logs",
    "claim_first_per_ot": _claims("SELECT ot, log_id, event_ts FROM claim_first"),
    "claim_sorted": _claims('SELECT * FROM claim_detail ORDER BY "Mes", "Clasificacion", "OT"'),
    "with_load_ts": _two_loads("SELECT * FROM cur_load"),
    "table_merge": _two_loads(MERGED),
    "table_merge_bucketed": _two_loads(MERGED),
    "table_merge_moved": _two_loads(
        'SELECT * FROM cur_load UNION ALL SELECT * FROM prev_load p WHERE NOT EXISTS (SELECT 1 FROM cur_load c WHERE c."OT" = p."OT")'
    ),
    "table_compact_partitions": _two_loads("SELECT * FROM prev_load UNION ALL SELECT * FROM cur_load"),
    "table_append": _two_loads("SELECT * FROM prev_load UNION ALL SELECT * FROM cur_load"),
    "table_compact": _two_loads("SELECT * FROM prev_load UNION ALL SELECT * FROM cur_load"),
    "table_overwrite": _two_loads("SELECT * FROM cur_load"),
    "table_create": _two_loads("SELECT * FROM cur_load"),
    "table_overwrite_partitioned": _claims(
        """SELECT 'alto' AS tabla, "OT", CASE WHEN "Valor_Declarado_CLP" > 0 THEN CAST("Valor_Declarado_CLP" > 150000 AS VARCHAR) END AS parte
           FROM claim_detail
           UNION ALL
           SELECT 'dia', "OT", CASE WHEN day("Fecha_Creacion") > 15 THEN strftime("Fecha_Creacion", '%Y-%m-01') END FROM claim_detail"""
    ),
    "table_job": f"SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS fecha_carga FROM ({CLAIM_SUMMARY})",
    "python_source": f"SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS fecha_carga FROM ({CLAIM_TOP})",
    "normalize_source": CLAIM_TOP,
    "table_sample": _claims("SELECT least(10, count(*)) AS n_rows, least(10, count(*)) AS n_in_table FROM claim_detail"),
    "csv_sink": _claims("SELECT * FROM claim_detail"),
    "parquet_sink": _claims("SELECT * FROM claim_detail"),
    "parquet_export": CLAIM_SUMMARY,
    "parquet_scan": "SELECT * FROM orders",
    "sql_limit": _claims('SELECT * FROM claim_detail ORDER BY "OT" LIMIT 20'),
    "sql_file_source": _claims(SUMMARY_SELECT),
    "clean_columns": _claims(SUMMARY_SELECT),
    "json_export": _claims(
        """SELECT CAST(to_json(struct_pack("Mes" := "Mes", "Clasificacion" := "Clasificacion", "OT" := "OT",
             "Valor_Declarado_CLP" := "Valor_Declarado_CLP",
             "Fecha_Creacion" := CASE WHEN microsecond("Fecha_Creacion") % 1000000 = 0
                                      THEN strftime("Fecha_Creacion", '%Y-%m-%dT%H:%M:%S')
                                      ELSE strftime("Fecha_Creacion", '%Y-%m-%dT%H:%M:%S.%f') END,
             "Usuario" := "Usuario")) AS VARCHAR) AS json FROM claim_detail"""
    ),
}


# --- documents: the same JSON texts, told apart by DuckDB's JSON types ---------------

DOCUMENTS = r"""
doc_parts AS (
  SELECT *, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso, CAST(epoch_ms(o_orderdate) AS VARCHAR) AS ms,
    CAST(o_custkey AS VARCHAR) AS cust, CAST(o_totalprice AS VARCHAR) AS price, o_orderkey AS k FROM orders
),
doc_fields AS (
  SELECT '{"$oid":"' || lpad(lower(to_hex(k)), 24, '0') || '"}' AS f_id,
    CASE WHEN k % 79 = 0 THEN NULL WHEN k % 83 = 0 THEN '""' WHEN k % 89 = 0 THEN '0' WHEN k % 97 = 0 THEN 'null' WHEN k % 101 = 0 THEN 'false'
         WHEN k % 2 = 0 THEN cust WHEN k % 3 = 0 THEN '{"$numberLong":"' || cust || '"}' ELSE '"OT-' || cust || '"' END AS f_ot,
    CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN '"sin fecha"' WHEN k % 37 = 0 THEN CAST(k AS VARCHAR) WHEN k % 41 = 0 THEN 'true'
         WHEN k % 43 = 0 THEN 'null' WHEN k % 47 = 0 THEN '{"x":1}' WHEN k % 53 = 0 THEN '"' || iso || '+0000"' WHEN k % 59 = 0 THEN '{"$date":' || ms || '}'
         WHEN k % 5 = 0 THEN '{"$date":"' || iso || 'Z"}' WHEN k % 5 = 1 THEN '{"$date":{"$numberLong":"' || ms || '"}}' ELSE '"' || iso || '"' END AS f_created,
    CASE WHEN k % 58 = 0 THEN NULL WHEN k % 61 = 0 THEN 'false' WHEN k % 3 = 0 THEN '{"$date":"' || iso || 'Z"}' ELSE '"' || iso || '"' END AS f_scanned,
    CASE WHEN k % 13 = 0 THEN '"n/a"' WHEN k % 26 = 1 THEN '"N/A"' WHEN k % 7 = 0 THEN NULL WHEN k % 67 = 0 THEN '5' ELSE '"' || o_orderpriority || '"' END AS f_class,
    CASE WHEN k % 71 = 0 THEN NULL WHEN k % 17 = 0 THEN '"x"' WHEN k % 19 = 0 THEN '""' WHEN k % 23 = 0 THEN 'null' WHEN k % 13 = 2 THEN 'true'
         WHEN k % 11 = 3 THEN 'false' WHEN k % 73 = 0 THEN '[1,2]' WHEN k % 103 = 0 THEN '{"$date":{"$numberLong":"' || cust || '000"}}' WHEN k % 7 = 0 THEN price
         WHEN k % 7 = 1 THEN '{"$numberDecimal":"' || price || '"}' WHEN k % 7 = 2 THEN '{"$numberInt":"' || cust || '"}' ELSE '"' || price || '"' END AS f_value,
    CASE WHEN k % 5 = 0 THEN '"u' || CAST(o_custkey % 20 AS VARCHAR) || '"' END AS f_user,
    CASE WHEN k % 3 = 0 THEN '"u' || CAST(o_custkey % 21 AS VARCHAR) || '"' END AS f_usuario,
    CASE WHEN k % 4 = 0 THEN 'null' WHEN k % 2 = 0 THEN '"u' || CAST(o_custkey % 22 AS VARCHAR) || '"' END AS f_username,
    CASE WHEN k % 11 <> 0 THEN CAST(o_custkey % 23 AS VARCHAR) END AS f_user_id
  FROM doc_parts
),
docs AS (
  SELECT CAST('{' || concat_ws(',', '"_id":' || f_id, '"ot":' || f_ot, '"created_at":' || f_created, '"fecha_escaneo":' || f_scanned,
    '"clasificacion":' || f_class, '"valor_declarado":' || f_value, '"user":' || f_user, '"usuario":' || f_usuario, '"username":' || f_username,
    '"user_id":' || f_user_id) || '}' AS JSON) AS doc
  FROM doc_fields
)"""

DOCUMENT_FIELDS = ("ot", "created_at", "fecha_escaneo", "clasificacion", "valor_declarado", "user", "usuario", "username", "user_id")


def _has(field: str, member: str) -> str:
    return f"""json_exists(doc, '$."{field}"."{member}"')"""


def _doc_kind(field: str) -> str:
    numbers = " OR ".join(_has(field, w) for w in ("$numberInt", "$numberLong", "$numberDecimal"))
    return f"""CASE coalesce(json_type(doc, '$."{field}"'), 'NULL') WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean'
      WHEN 'ARRAY' THEN 'other' WHEN 'OBJECT' THEN CASE WHEN {_has(field, '$date')} THEN 'date' WHEN {numbers} THEN 'number' ELSE 'other' END ELSE 'number' END"""


def _doc_text(field: str) -> str:
    inner = ", ".join(f"""json_extract_string(doc, '$."{field}"."{w}"')""" for w in ("$numberInt", "$numberLong", "$numberDecimal"))
    return f"""coalesce({inner}, json_extract_string(doc, '$."{field}"'))"""


def _doc_time(field: str) -> str:
    date = f"""'$."{field}"."$date"'"""
    told = f"""regexp_replace(coalesce(json_extract_string(doc, {date}), json_extract_string(doc, '$."{field}"')), '(Z|[+]0000)$', '')"""
    return f"""CASE json_type(doc, {date})
        WHEN 'OBJECT' THEN epoch_ms(CAST(json_extract_string(doc, '$."{field}"."$date"."$numberLong"') AS BIGINT))
        WHEN 'UBIGINT' THEN epoch_ms(CAST(json_extract_string(doc, {date}) AS BIGINT))
        ELSE {_event_text(told)} END"""


def _when_present(field: str) -> str:
    return f"({_doc_kind(field)}) IN ('date', 'text')"


DOC_EVENT = f"CASE WHEN {_when_present('created_at')} THEN {_doc_time('created_at')} WHEN {_when_present('fecha_escaneo')} THEN {_doc_time('fecha_escaneo')} END"
DOC_VALUE = f"""coalesce(CASE {_doc_kind('valor_declarado')}
    WHEN 'boolean' THEN CASE {_doc_text('valor_declarado')} WHEN 'true' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
    WHEN 'number' THEN CAST({_doc_text('valor_declarado')} AS DOUBLE)
    WHEN 'date' THEN CAST(epoch_ms({_doc_time('valor_declarado')}) AS DOUBLE)
    WHEN 'text' THEN CASE WHEN regexp_matches({_doc_text('valor_declarado')}, '{DECIMAL_TEXT}') THEN try_cast({_doc_text('valor_declarado')} AS DOUBLE) END
    END, 0.0::DOUBLE)"""
DOC_ID = """json_extract_string(doc, '$."_id"."$oid"')"""
DOC_OT = f"""CASE {_doc_kind('ot')} WHEN 'null' THEN NULL WHEN 'number' THEN nullif({_doc_text('ot')}, '0') WHEN 'boolean' THEN nullif({_doc_text('ot')}, 'false')
    ELSE nullif({_doc_text('ot')}, '') END"""
DOC_LOGS = f"""
doc_logs AS (
  SELECT {DOC_ID} AS log_id, {DOC_OT} AS ot, {DOC_EVENT} AS event_ts, {DOC_VALUE} AS valor,
    coalesce({_doc_text('clasificacion')}, 'Sin clasificación') AS clasificacion,
    {", ".join(f'{_doc_text(c)} AS "{c}"' for c in DOCUMENT_FIELDS[5:])}
  FROM docs
),
doc_first AS (
  SELECT *, row_number() OVER (PARTITION BY ot ORDER BY event_ts, log_id) AS rn FROM doc_logs
  WHERE ot IS NOT NULL AND event_ts IS NOT NULL AND clasificacion NOT IN ('n/a', 'N/A', 'N/a', 'n/A') AND {USER_KEEP}
)"""

DOCUMENT_STATEMENTS = {
    "usage_log_documents": _with(DOCUMENTS)
    + f"\nSELECT {DOC_ID} AS log_id, "
    + ", ".join(
        f"{_doc_kind(f)} AS {f}_kind, CASE WHEN ({_doc_kind(f)}) NOT IN ('date', 'other'{', ' + repr('number') if f == 'valor_declarado' else ''})"
        f' THEN {_doc_text(f)} END AS "{f}"'
        for f in DOCUMENT_FIELDS
    )
    + f", CASE WHEN ({_doc_kind('valor_declarado')}) = 'number' THEN CAST({_doc_text('valor_declarado')} AS DOUBLE) END AS valor_numero FROM docs",
    "claim_event_date_documents": _with(DOCUMENTS) + f"\nSELECT {DOC_ID} AS log_id, {DOC_EVENT} AS event_ts FROM docs",
    "claim_value_documents": _with(DOCUMENTS) + f"\nSELECT {DOC_ID} AS log_id, {DOC_VALUE} AS valor FROM docs",
    "claim_detail_documents": _with(DOCUMENTS, DOC_LOGS)
    + """
SELECT strftime(event_ts, '%Y-%m') AS "Mes", clasificacion AS "Clasificacion", ot AS "OT", round(valor, 3) AS "Valor_Declarado_CLP",
  date_trunc('second', event_ts) AS "Fecha_Creacion", coalesce("user", usuario, username, user_id, 'Sin usuario') AS "Usuario"
FROM doc_first WHERE rn = 1""",
}


def oracle_statements() -> dict[str, str]:
    return {
        "claim_detail": CLAIM_DETAIL,
        "claim_summary": CLAIM_SUMMARY,
        "claim_evolution": CLAIM_EVOLUTION,
        "claim_top": CLAIM_TOP,
        "table_graph": " UNION ALL ".join(
            f"SELECT '{name}' AS tabla, count(*) AS filas, CAST({measure} AS BIGINT) AS medida FROM ({statement})"
            for name, measure, statement in (
                ("claim_detail", 'count(DISTINCT "OT")', CLAIM_DETAIL),
                ("claim_summary", 'sum("Cantidad")', CLAIM_SUMMARY),
                ("claim_evolution", 'sum("Cantidad")', CLAIM_EVOLUTION),
                ("claim_top", 'sum("Cantidad")', CLAIM_TOP),
                ("dashboard_base", "sum(cantidad_mensajes)", CONVERSATION_STATEMENTS["dashboard_base"]),
                ("dashboard_recent", "count(DISTINCT session_id)", CONVERSATION_STATEMENTS["dashboard_recent"]),
            )
        ),
        "claim_detail_ledger": CLAIM_DETAIL,
        "claim_summary_ledger": CLAIM_SUMMARY,
        "claim_top_ledger": CLAIM_TOP,
        **STEP_STATEMENTS,
        **DOCUMENT_STATEMENTS,
        **CONVERSATION_STATEMENTS,
    }
