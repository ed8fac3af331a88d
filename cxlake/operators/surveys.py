"""Conversation pipeline, survey level: clean, order, daily satisfaction index."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.functions.casts import guarded_int
from cxlake.functions.dates import as_day
from cxlake.operators.messages import lookback
from cxlake.operators.ranking import ordered_numbers

# Which surveys count (answered with the assistant, opened and
# closed by the robot) and the rating bands of the index.
ATTENDED_BY_ASSISTANT = "Si"
ROBOT_OPERATOR = "robot"
PROMOTER_RATINGS = (6, 7)
DETRACTOR_LOW, DETRACTOR_HIGH = 1, 4
RATING_LOW, RATING_HIGH = 1, 7


def clean_surveys(
    surveys: DataFrame,
    as_of: str | Column | None,
    days: int,
    tie_breaker: str | None = "event_id",
) -> DataFrame:
    """Surveys answered with the assistant inside the lookback, typed.

    Output: id (text user id), Fecha, eval_ia, eval_acceso (INT or NULL when
    not a whole number), resolucion, plus the tie breaker.
    """
    df = lookback(surveys, "Fecha", as_of, days)
    eval_ia = F.col("EvalIA")
    df = df.where(
        (F.col("AtencionIA") == ATTENDED_BY_ASSISTANT)
        & (F.col("OperadorAbre") == ROBOT_OPERATOR)
        & (F.col("OperadorCierra") == ROBOT_OPERATOR)
        & eval_ia.isNotNull()
        & (F.trim(eval_ia) != F.lit(""))
    )
    return df.select(
        F.col("IdUsuario").cast(T.StringType()).alias("id"),
        F.col("Fecha"),
        guarded_int(F.col("EvalIA")).alias("eval_ia"),
        guarded_int(F.col("EvalAcceso")).alias("eval_acceso"),
        F.col("EvalResolvReq").alias("resolucion"),
        *([F.col(tie_breaker)] if tie_breaker else []),
    )


def order_surveys(clean: DataFrame, tie_breaker: str | None = "event_id") -> DataFrame:
    """Add ``orden_enc``: 1, 2, ... per user id by date (then tie breaker), also when one id holds most surveys."""
    order = ["Fecha"] + ([tie_breaker] if tie_breaker else [])
    return ordered_numbers(clean, ["id"], order, "orden_enc")


def satisfaction_daily(clean: DataFrame) -> DataFrame:
    """Daily index: (promoters - detractors) * 100 / rated, 2 decimals.

    Only ratings 1..7 count; 5 is neutral. Grouped by the calendar day of
    ``Fecha`` (so a DATE and a TIMESTAMP source give the same days). The
    arithmetic is decimal (exact, half-up), cast to DOUBLE at the end.
    """
    rating = F.col("eval_ia")
    rated = clean.where(rating.between(RATING_LOW, RATING_HIGH))
    promoters = F.sum(F.when(rating.isin(*PROMOTER_RATINGS), 1).otherwise(0))
    detractors = F.sum(F.when(rating.between(DETRACTOR_LOW, DETRACTOR_HIGH), 1).otherwise(0))
    index = F.round((promoters - detractors) * F.lit(Decimal("100.0")) / F.count(F.lit(1)), 2)
    day = as_day(F.col("Fecha"), clean.schema["Fecha"].dataType)
    return rated.groupBy(day.alias("Fecha")).agg(index.cast(T.DoubleType()).alias("isn"))
