"""Date and time column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.functions import documents

# Fixed value: the texts that are a date. A full calendar date, alone or with a
# time after "T" or a blank (seconds and their fraction may be missing) and an
# optional zone ("Z", or an offset with or without its colon). A clock time, a
# year or a month alone isn't.
EVENT_TEXT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def _text_time(col: Column) -> Column:
    return F.when(col.rlike(EVENT_TEXT), F.try_to_timestamp(col))


def parse_event_time(col: Column, dtype: T.DataType) -> Column:
    """One document field -> TIMESTAMP, NULL when it is no date.

    A typed column (a date, a timestamp, text) is decided at plan time. A VARIANT
    column (JSON exports) is decided row by row: a date object, text, or no date.
    """
    if isinstance(dtype, T.VariantType):
        kind = documents.kind(col)
        told = F.coalesce(_text_time(documents.date_text(col)), F.timestamp_millis(documents.date_millis(col)), documents.plain_time(col))
        return F.when(kind == documents.DATE, told).when(kind == documents.TEXT, _text_time(documents.text(col)))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col.cast(T.TimestampType())
    if isinstance(dtype, T.StringType):
        return _text_time(col)
    # numbers, booleans, ... are neither a date nor a string: no date
    return F.lit(None).cast(T.TimestampType())


def resolve_event_date(
    primary: Column,
    primary_type: T.DataType,
    fallback: Column,
    fallback_type: T.DataType,
) -> Column:
    """Event date chosen by presence, in order: primary, then fallback.

    A present but unparsable ``primary`` yields NULL; it does *not* fall
    through to ``fallback``. This is why the expression is a ``when`` chain on
    presence rather than a ``coalesce`` of parsed values. Present is what holds a
    date or text: a number, a boolean or an object there falls through.
    """
    return F.when(_present(primary, primary_type), parse_event_time(primary, primary_type)).when(
        _present(fallback, fallback_type), parse_event_time(fallback, fallback_type)
    )


def _present(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.VariantType):
        return documents.kind(col).isin(documents.DATE, documents.TEXT)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType)):
        return col.isNotNull()
    return F.lit(False)


def as_timestamp(col: Column, dtype: T.DataType) -> Column:
    """TIMESTAMP of a date/timestamp column, or of text parsed leniently
    (unreadable text -> NULL instead of an error under ANSI mode)."""
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(col)
    return col.cast(T.TimestampType())


def as_day(col: Column, dtype: T.DataType) -> Column:
    """Calendar day of a date/timestamp column or of text (unreadable -> NULL)."""
    if isinstance(dtype, T.DateType):
        return col
    return F.to_date(as_timestamp(col, dtype))


def month_key(ts: Column) -> Column:
    """``yyyy-MM`` text of a timestamp (session time zone, pinned to UTC)."""
    return F.date_format(ts, "yyyy-MM")


def truncate_to_second(ts: Column) -> Column:
    """Drop sub-second digits, keep the TIMESTAMP type."""
    return F.date_trunc("second", ts)


def lookback_start(as_of: Column | str | None, days: int) -> Column:
    """First day inside a ``days``-day lookback that ends at ``as_of``.

    ``as_of`` defaults to ``current_date()``; pass a fixed date for repeatable
    runs (tests, backfills).
    """
    if as_of is None:
        base = F.current_date()
    elif isinstance(as_of, Column):
        base = as_of
    else:
        base = F.lit(as_of).cast(T.DateType())
    return F.date_sub(base, int(days))
