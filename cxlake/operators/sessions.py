"""Conversation pipeline, session-day level.

Metrics and claim status come from one aggregate per session-day over the
distinct messages (the source product makes two passes and a join). They are
plain aggregates (count, count_if, min, max, sum), so they are combined before
the shuffle. The ordered history is an array with all messages of the
session-day; it is built on its own and joined on the session key, so a large
session burdens its array alone. The grouping key is the null-free ``JOIN_KEY``
form of (session_id, message_date).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.functions.dates import as_timestamp
from cxlake.functions.text import MessagePatterns
from cxlake.operators.messages import DEDUP_KEY, dedup_messages
from cxlake.operators.ranking import ordered_numbers

# Role names, session types and claim states.
ROLE_USER = "user"
ROLE_ASSISTANT = "assistant"
SESSION_ABANDONED = "Abandono"
SESSION_CONVERSATION = "Conversacion"
CLAIM_CREATED = "RECLAMO_CREADO"
CLAIM_INCONCLUSIVE = "RECLAMO_INCONCLUSO"
CLAIM_IN_PROGRESS = "RECLAMO_EN_PROCESO"
NO_CLAIM = "SIN_RECLAMO"

SESSION_KEY = ("session_id", "message_date")
# Null-free form of the session-day key: (text of session_id or "", whether
# session_id is NULL, day). Grouping and joining on it keeps a NULL session
# as its own group and lets a later equi-join find it again without turning
# the join into a null-safe one (which would re-shuffle the joined side).
JOIN_KEY = ("_sk", "_sn", "message_date")
STATUS_COLUMNS = (
    "id_reclamo",
    "pidio_datos",
    "solicitud_creacion_reclamo",
    "genero_caso",
    "error_reclamos",
    "estado_reclamo",
)


def history_expr(ts: str = "message_timestamp") -> F.Column:
    """Ordered history: by timestamp, then role, then content (NULLs first)."""
    items = F.sort_array(F.collect_list(F.struct(F.col(ts).alias("timestamp"), "role", "content")))
    return F.transform(
        items,
        lambda x: F.struct(
            x["role"].alias("role"),
            x["content"].alias("content"),
            x["timestamp"].cast(T.StringType()).alias("timestamp"),
        ),
    )


def with_join_key(df: DataFrame) -> DataFrame:
    sid = F.col("session_id").cast(T.StringType())
    return df.withColumns({"_sk": F.coalesce(sid, F.lit("")), "_sn": sid.isNull()})


def session_metrics(dated: DataFrame, patterns: MessagePatterns = MessagePatterns(), keep_join_key: bool = False) -> DataFrame:
    """Messages (with ``message_date``) -> one row per (session_id, message_date): metrics and claim status.

    Copies are collapsed on the full message key and the session-day is summed
    from the distinct messages, both with map-side combining: no task ever
    holds all messages of a large session-day (or of a day's messages without a
    session), and no message text reaches the session-day aggregate."""
    dedup = dedup_messages(with_join_key(dated), patterns, extra_keys=("_sk", "_sn"))
    return _session_metrics(session_states(dedup), keep_join_key)


# How the columns of a session-day's state merge.
STATE_MERGES = {
    "id": "max",
    "_expires": "max",
    "_updated": "max",
    "_n": "sum",
    "_n_user": "sum",
    "_n_bot": "sum",
    "_first_ts": "min",
    "_last_ts": "max",
    "_id_reclamo": "max",
    "_pidio": "sum",
    "_ss": "sum",
    "_genero": "max",
    "_error": "sum",
}


def session_states(dedup: DataFrame, fresh: str | None = None) -> DataFrame:
    """Distinct messages with their marks -> a mergeable state per session-day (``STATE_MERGES``).

    ``fresh``: a column that is 1 for messages to be counted and 0 for those that were counted
    before (their further copies still add to the sums of marks)."""
    role, one = F.col("role"), F.col(fresh) if fresh else F.lit(1).cast("long")
    return dedup.groupBy(*JOIN_KEY).agg(
        F.max("balancer_mongo_id").alias("id"),
        F.max("conversation_expires_at").alias("_expires"),
        F.max("conversation_updated_at").alias("_updated"),
        F.sum(one).alias("_n"),
        F.sum(F.when(role == F.lit(ROLE_USER), one).otherwise(0)).alias("_n_user"),
        F.sum(F.when(role == F.lit(ROLE_ASSISTANT), one).otherwise(0)).alias("_n_bot"),
        F.min("message_timestamp").alias("_first_ts"),
        F.max("message_timestamp").alias("_last_ts"),
        F.max("id_reclamo").alias("_id_reclamo"),
        F.sum("pidio_datos").alias("_pidio"),
        F.sum("ss_creacion_reclamo").alias("_ss"),
        F.max("genero_caso").alias("_genero"),
        F.sum("error_reclamos").alias("_error"),
    )


def metrics_of_states(states: DataFrame) -> DataFrame:
    """Stored states of session-days -> the rows of ``session_metrics``."""
    return _session_metrics(states)


def session_histories(dated: DataFrame) -> DataFrame:
    """Join key and ordered history per session-day: one array with all its distinct messages.

    The array is the product's shape, so a session-day's messages do meet in
    one row here, and only here."""
    keyed = with_join_key(dated)
    distinct = keyed.groupBy(*DEDUP_KEY, "_sk", "_sn").agg(F.lit(True).alias("_one"))
    return distinct.groupBy(*JOIN_KEY).agg(history_expr().alias("history"))


CHUNK_MESSAGES = 1000
CHUNK_KEY = ("session_id", "message_date", "chunk")


def history_chunks(dated: DataFrame, chunk_messages: int = CHUNK_MESSAGES, user_only: bool = False) -> DataFrame:
    """Ordered histories in pieces: (session_id, message_date, chunk, first_number, n_messages, history).

    The distinct messages of a session-day are numbered 1, 2, ... in the order of
    ``session_histories`` by ``ordered_numbers``, so a session-day (or a day's
    messages without a session) of any size is spread over many tasks, and every
    ``chunk_messages`` of them make one row. No row and no task holds a whole large
    session-day. ``user_only``: the messages of the user alone, numbered anew."""
    if chunk_messages < 1:
        raise ValueError("a chunk has one message at least")
    keyed = with_join_key(dated)
    if user_only:
        keyed = keyed.where(F.col("role") == F.lit(ROLE_USER))
    distinct = keyed.groupBy(*DEDUP_KEY, "_sk", "_sn").agg(F.lit(True).alias("_one"))
    said = distinct.select(*JOIN_KEY, "message_timestamp", "role", "content")
    numbered = ordered_numbers(said, JOIN_KEY, ["message_timestamp", "role", "content"], "_number")
    chunk = F.floor((F.col("_number") - 1) / chunk_messages).cast(T.IntegerType())
    chunks = numbered.groupBy(*JOIN_KEY, chunk.alias("chunk")).agg(
        F.min("_number").alias("first_number"), F.count(F.lit(1)).cast(T.IntegerType()).alias("n_messages"), history_expr().alias("history")
    )
    sid = F.when(~F.col("_sn"), F.col("_sk")).alias("session_id")
    return chunks.select(sid, "message_date", "chunk", "first_number", "n_messages", "history")


def whole_histories(chunks: DataFrame) -> DataFrame:
    """Chunks put together again: one array per session-day (the presentation form of ``session_histories``)."""
    keyed = with_join_key(chunks)
    parts = F.sort_array(F.collect_list(F.struct("chunk", "history")))
    whole = keyed.groupBy(*JOIN_KEY).agg(F.flatten(F.transform(parts, lambda p: p["history"])).alias("history"))
    return whole.select(F.when(~F.col("_sn"), F.col("_sk")).alias("session_id"), "message_date", "history")


def session_days(
    dated: DataFrame,
    include_history: bool = True,
    patterns: MessagePatterns = MessagePatterns(),
    keep_join_key: bool = False,
    metrics: DataFrame | None = None,
) -> DataFrame:
    """Session-days with metrics, claim status and, unless switched off, the history.

    ``metrics``: a result of ``session_metrics`` with its join key, if there is one already."""
    if not include_history:
        return metrics if metrics is not None else session_metrics(dated, patterns, keep_join_key)
    metrics = metrics if metrics is not None else session_metrics(dated, patterns, keep_join_key=True)
    joined = metrics.join(session_histories(dated), on=list(JOIN_KEY), how="left")
    columns = [c for c in metrics.columns if c not in ("_sk", "_sn")]
    at = columns.index("updated_at") + 1
    keys = ["_sk", "_sn"] if keep_join_key else []
    return joined.select(*columns[:at], "history", *columns[at:], *keys)


def _as_timestamp(df: DataFrame, name: str) -> F.Column:
    """TIMESTAMP of a column that may hold timestamps or text (bad text -> NULL)."""
    return as_timestamp(F.col(name), df.schema[name].dataType)


def _session_metrics(agg: DataFrame, keep_join_key: bool = False) -> DataFrame:
    first_ts = _as_timestamp(agg, "_first_ts")
    last_ts = _as_timestamp(agg, "_last_ts")
    seconds = F.unix_timestamp(last_ts) - F.unix_timestamp(first_ts)
    n_user = F.col("_n_user").cast(T.IntegerType())

    genero = F.col("_genero")
    status = (
        F.when(genero == 1, F.lit(CLAIM_CREATED))
        .when((F.col("_ss") > 0) & (genero == 0), F.lit(CLAIM_INCONCLUSIVE))
        .when((F.col("_pidio") > 0) & (genero == 0), F.lit(CLAIM_IN_PROGRESS))
        .otherwise(F.lit(NO_CLAIM))
    )
    # A NULL session never matched its claim status in the source product's
    # join; keep that: status columns are NULL for it.
    has_session = ~F.col("_sn")

    def status_col(expr: F.Column, name: str) -> F.Column:
        return F.when(has_session, expr).alias(name)

    cols = [
        F.when(has_session, F.col("_sk")).alias("session_id"),
        F.col("message_date"),
        F.col("id").cast(T.StringType()).alias("id"),
        _as_timestamp(agg, "_expires").alias("expires_at"),
        _as_timestamp(agg, "_updated").alias("updated_at"),
    ]
    cols += [
        F.col("_first_ts").cast(T.StringType()).alias("primer_timestamp"),
        F.col("_last_ts").cast(T.StringType()).alias("ultimo_timestamp"),
        first_ts.alias("fecha_inicio"),
        last_ts.alias("fecha_fin"),
        F.col("_n").cast(T.IntegerType()).alias("cantidad_mensajes"),
        n_user.alias("mensajes_usuario"),
        F.col("_n_bot").cast(T.IntegerType()).alias("mensajes_bot"),
        F.round(F.col("_n") / F.lit(Decimal("2.0")), 1).cast(T.DoubleType()).alias("turnos_conversacion"),
        F.when(n_user == 1, F.lit(SESSION_ABANDONED)).otherwise(F.lit(SESSION_CONVERSATION)).alias("tipo_sesion"),
        F.round(seconds / F.lit(Decimal("60.0")), 2).cast(T.DoubleType()).alias("duracion_minutos"),
        seconds.alias("duracion_segundos"),
        status_col(F.col("_id_reclamo"), "id_reclamo"),
        status_col(F.col("_pidio"), "pidio_datos"),
        status_col(F.col("_ss"), "solicitud_creacion_reclamo"),
        status_col(genero, "genero_caso"),
        status_col(F.col("_error"), "error_reclamos"),
        status_col(status, "estado_reclamo"),
    ]
    if keep_join_key:
        cols += [F.col(c) for c in JOIN_KEY if c != "message_date"]
    return agg.select(*cols)


def user_messages(days: DataFrame) -> DataFrame:
    """The user-only part of each history (not part of the dashboard)."""
    return days.select(
        *SESSION_KEY,
        F.filter("history", lambda x: x["role"] == F.lit(ROLE_USER)).alias("si"),
    )


def order_sessions(days: DataFrame) -> DataFrame:
    """Add ``orden_conv``: 1, 2, ... per user id by end time.

    Ties (same end time) are broken by session id, then day, so the FIFO
    pairing with surveys is repeatable. NULL ids are numbered too; they never
    pair with a survey."""
    return ordered_numbers(days, ["id"], ["fecha_fin", "session_id", "message_date"], "orden_conv")
