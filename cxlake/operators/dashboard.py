"""Dashboard base and the recent-dashboard projection.

Joins of the dashboard:

* session-day -> daily index, on the day. The index has one row per
  calendar day (bounded by the lookback / the data's day span, a few hundred
  rows per year), so it is broadcast.
* session-day -> survey, FIFO: the n-th conversation of a user id takes the
  n-th survey of that id (left join on id and ordinal), computed on narrow
  rows and joined back to the wide session-day rows without moving them.
* claim status is not a join: it comes out of the same session-day aggregate
  as the metrics (see ``cxlake.operators.sessions``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.functions.dates import as_day, as_timestamp
from cxlake.functions.text import MessagePatterns
from cxlake.operators.messages import lookback, with_message_date
from cxlake.operators.ranking import ordered_numbers
from cxlake.operators.sessions import JOIN_KEY, STATUS_COLUMNS, session_days, session_metrics
from cxlake.operators.surveys import clean_surveys, satisfaction_daily
from cxlake.session import use_checkpoint_dir

SESSION_COLUMNS = (
    "session_id",
    "id",
    "message_date",
    "expires_at",
    "updated_at",
    "history",
    "primer_timestamp",
    "ultimo_timestamp",
    "fecha_inicio",
    "fecha_fin",
    "cantidad_mensajes",
    "mensajes_usuario",
    "mensajes_bot",
    "turnos_conversacion",
    "tipo_sesion",
    "duracion_minutos",
    "duracion_segundos",
)
FIFO_COLUMNS = ("orden_conv", "orden_enc")
SURVEY_COLUMNS = ("fecha_encuesta", "eval_ia", "eval_acceso", "resolucion")
DASHBOARD_COLUMNS = SESSION_COLUMNS + FIFO_COLUMNS + SURVEY_COLUMNS + STATUS_COLUMNS + ("isn",)
RECENT_COLUMNS = (
    "session_id",
    "id",
    "message_date",
    "history",
    "fecha_inicio",
    "fecha_fin",
    "cantidad_mensajes",
    "mensajes_usuario",
    "mensajes_bot",
    "tipo_sesion",
    "duracion_minutos",
    "isn",
)


def join_index(days: DataFrame, index: DataFrame) -> DataFrame:
    """Left join each session-day to the index of its calendar day."""
    idx = index.select(F.col("Fecha").alias("_idx_day"), F.col("isn"))
    return days.join(F.broadcast(idx), days["message_date"] == idx["_idx_day"], "left").drop("_idx_day")


FIFO_GROUP, FIFO_ORDER = ("id", "_side"), ("_o1", "_o2", "_o3", "_o4")


def fifo_pairs(ends: DataFrame, clean: DataFrame, survey_tie_breaker: str | None = "event_id") -> DataFrame:
    """Number conversations and surveys per user id and pair n-th with n-th.

    ``ends``: one row per session-day with ``JOIN_KEY``, session_id, id and
    fecha_fin. ``clean``: cleaned surveys. Both sides are tagged and unioned,
    numbered per (id, side) by ``ordered_numbers`` (an id of any size is spread
    over many tasks), and paired on (id, number), which spreads it again.
    Conversations with a NULL id are numbered among themselves and never
    paired; surveys with a NULL id are not candidates.

    Output: ``JOIN_KEY`` + orden_conv, orden_enc, fecha_encuesta, eval_ia,
    eval_acceso, resolucion (one row per conversation).
    """
    return pair_numbered(ordered_numbers(fifo_rows(ends, clean, survey_tie_breaker), FIFO_GROUP, FIFO_ORDER, "_n"))


def fifo_rows(ends: DataFrame, clean: DataFrame, survey_tie_breaker: str | None = "event_id") -> DataFrame:
    """Conversations and surveys as rows of one shape: id, side (c or s), order columns, keys and values."""
    tie_type = clean.schema[survey_tie_breaker].dataType if survey_tie_breaker else T.LongType()
    tie_col = F.col(survey_tie_breaker) if survey_tie_breaker else F.lit(None).cast(tie_type)
    conv = ends.select(
        "id",
        F.lit("c").alias("_side"),
        F.col("fecha_fin").alias("_o1"),
        F.col("session_id").alias("_o2"),
        F.col("message_date").alias("_o3"),
        F.lit(None).cast(tie_type).alias("_o4"),
        *[F.col(c) for c in JOIN_KEY],
        F.lit(None).cast(T.DateType()).alias("fecha_encuesta"),
        F.lit(None).cast(T.IntegerType()).alias("eval_ia"),
        F.lit(None).cast(T.IntegerType()).alias("eval_acceso"),
        F.lit(None).cast(T.StringType()).alias("resolucion"),
    )
    fecha_type = clean.schema["Fecha"].dataType
    surv = clean.where(F.col("id").isNotNull()).select(
        "id",
        F.lit("s").alias("_side"),
        as_timestamp(F.col("Fecha"), fecha_type).alias("_o1"),
        F.lit(None).cast(T.StringType()).alias("_o2"),
        F.lit(None).cast(T.DateType()).alias("_o3"),
        tie_col.alias("_o4"),
        F.lit(None).cast(T.StringType()).alias("_sk"),
        F.lit(None).cast(T.BooleanType()).alias("_sn"),
        F.lit(None).cast(T.DateType()).alias("message_date"),
        as_day(F.col("Fecha"), fecha_type).alias("fecha_encuesta"),
        "eval_ia",
        "eval_acceso",
        "resolucion",
    )
    return conv.unionByName(surv)


def pair_numbered(numbered: DataFrame) -> DataFrame:
    """Per (id, ordinal): the conversation row takes the survey row's values.

    There is one row of each side at most in such a pair. Conversations without
    an id have nothing to meet and stay out of the shuffle."""
    pair = Window.partitionBy("id", "_n")
    is_survey = F.col("_side") == F.lit("s")

    def from_survey(c: str) -> Column:
        return F.first(F.when(is_survey, F.col(c)), ignorenulls=True).over(pair)

    named = numbered.where(F.col("id").isNotNull())
    paired = named.select(
        "_side",
        *[F.col(c) for c in JOIN_KEY],
        F.col("_n").alias("orden_conv"),
        from_survey("_n").alias("orden_enc"),
        *[from_survey(c).alias(c) for c in SURVEY_COLUMNS],
    )
    alone = numbered.where(F.col("id").isNull()).select(
        "_side", *[F.col(c) for c in JOIN_KEY], F.col("_n").alias("orden_conv"), F.lit(None).cast("int").alias("orden_enc"), *SURVEY_COLUMNS
    )
    return paired.unionByName(alone).where(F.col("_side") == F.lit("c")).drop("_side")


def dashboard_base(
    messages: DataFrame,
    surveys: DataFrame,
    as_of: str | Column | None,
    days: int,
    patterns: MessagePatterns = MessagePatterns(),
    include_history: bool = True,
    survey_tie_breaker: str | None = "event_id",
    include_fifo: bool = True,
    fifo: Callable[[DataFrame, DataFrame, str | None], DataFrame] = fifo_pairs,
) -> DataFrame:
    """Per session-day dashboard row (28 columns; fewer without history or FIFO columns).

    The messages are read twice at most: for the metrics, which are written to
    the shared folder and serve both the FIFO pairing and the result, and for
    the histories. The surveys are read for the pairing and for the daily
    index, which has one row per day of the lookback and is broadcast. ``fifo``
    pairs conversations with surveys: by their numbers inside the lookback, or, with
    a ledger's ``pairs``, by their numbers of all time."""
    dated = with_message_date(lookback(messages, "message_timestamp", as_of, days))
    clean = clean_surveys(surveys, as_of, days, tie_breaker=survey_tie_breaker)
    metrics = session_metrics(dated, patterns, keep_join_key=True)
    if include_fifo:
        use_checkpoint_dir(messages.sparkSession)
        metrics = metrics.checkpoint()
    wide = session_days(dated, include_history, patterns, keep_join_key=True, metrics=metrics)
    if include_fifo:
        ends = metrics.select(*JOIN_KEY, "session_id", "id", "fecha_fin")
        wide = wide.join(fifo(ends, clean, survey_tie_breaker), on=list(JOIN_KEY), how="left")
    out = join_index(wide, satisfaction_daily(clean))
    absent = {*(() if include_history else ("history",)), *(() if include_fifo else FIFO_COLUMNS + SURVEY_COLUMNS)}
    return out.select(*[c for c in DASHBOARD_COLUMNS if c not in absent])


def dashboard_recent(base: DataFrame, as_of: str | Column | None, days: int) -> DataFrame:
    """Recent rows of the dashboard base: 12 columns, lookback on the day."""
    cols: Sequence[str] = [c for c in RECENT_COLUMNS if c in base.columns]
    return lookback(base, "message_date", as_of, days).select(*cols)
