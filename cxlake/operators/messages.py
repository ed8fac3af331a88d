"""Conversation pipeline, message level: lookback, flags, case id, dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.functions.dates import as_day, lookback_start
from cxlake.functions.text import MessagePatterns, flag

MESSAGE_COLUMNS = (
    "session_id",
    "balancer_mongo_id",
    "role",
    "content",
    "message_timestamp",
    "conversation_expires_at",
    "conversation_updated_at",
)
# The dedup key: the seven message columns plus the calendar day.
DEDUP_KEY = (
    "session_id",
    "balancer_mongo_id",
    "role",
    "content",
    "message_timestamp",
    "message_date",
    "conversation_expires_at",
    "conversation_updated_at",
)


def lookback(df: DataFrame, column: str, as_of: str | Column | None, days: int) -> DataFrame:
    """Keep rows whose day is within ``days`` days before ``as_of``.

    For a timestamp column the test is stated on the timestamp itself
    (``ts >= start 00:00``), which equals ``to_date(ts) >= start`` but can be
    pushed to the parquet scan and used for file / row-group skipping.
    """
    start = lookback_start(as_of, days)
    dtype = df.schema[column].dataType
    col = F.col(column)
    if isinstance(dtype, T.TimestampNTZType):
        return df.where(col >= start.cast(T.TimestampNTZType()))
    if isinstance(dtype, T.TimestampType):
        return df.where(col >= start.cast(T.TimestampType()))
    if isinstance(dtype, T.DateType):
        return df.where(col >= start)
    return df.where(as_day(col, dtype) >= start)


def flag_messages(messages: DataFrame, patterns: MessagePatterns = MessagePatterns()) -> DataFrame:
    """Per message row: the calendar day and the four flags plus the case id.

    ``genero_caso`` and the case id look at the raw text (case-sensitive);
    the other flags at the lower-cased text.
    """
    content = F.col("content")
    low = F.lower(content)
    return messages.select(
        *[F.col(c) for c in MESSAGE_COLUMNS],
        as_day(F.col("message_timestamp"), messages.schema["message_timestamp"].dataType).alias("message_date"),
        flag(low, patterns.asked_for_data).alias("pidio_datos"),
        flag(low, patterns.claim_creation_request).alias("ss_creacion_reclamo"),
        flag(content, patterns.case_id).alias("genero_caso"),
        F.regexp_extract(content, patterns.case_id_group, 1).alias("id_reclamo"),
        flag(low, patterns.claim_creation_error).alias("error_reclamos"),
    )


def with_message_date(messages: DataFrame) -> DataFrame:
    ts_type = messages.schema["message_timestamp"].dataType
    return messages.withColumn("message_date", as_day(F.col("message_timestamp"), ts_type))


def dedup_messages(
    dated: DataFrame, patterns: MessagePatterns = MessagePatterns(), extra_keys: tuple[str, ...] = (), count_col: str | None = None
) -> DataFrame:
    """Collapse exact duplicate messages; flags per distinct message.

    Sum-type flags count the copies, max-type flags do not (a message sent
    twice that asks for data counts twice). Every flag is a function of the
    text, which is part of the dedup key, so the dedup itself only counts
    copies (a hash aggregate with a fixed-width buffer and map-side combine)
    and each pattern runs once per distinct message, not once per copy.
    ``count_col`` adds the number of copies under that name.
    """
    keys = (*DEDUP_KEY, *extra_keys)
    counted = dated.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    content = F.col("content")
    low = F.lower(content)
    copies = F.col("_copies")
    return counted.select(
        *keys,
        (flag(low, patterns.asked_for_data) * copies).alias("pidio_datos"),
        (flag(low, patterns.claim_creation_request) * copies).alias("ss_creacion_reclamo"),
        flag(content, patterns.case_id).alias("genero_caso"),
        F.regexp_extract(content, patterns.case_id_group, 1).alias("id_reclamo"),
        (flag(low, patterns.claim_creation_error) * copies).alias("error_reclamos"),
        *([copies.alias(count_col)] if count_col else []),
    )
