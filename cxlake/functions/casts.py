"""Strict, engine-independent casts from text.

Spark's ``try_cast`` is more lenient than most readers of this data expect
(``'1.5d'`` -> 1.5, ``' 2 '`` -> 2.0, ``'NaN'`` -> NaN), and another engine
used as an oracle is stricter. A regular-expression guard in front of the
cast pins one meaning everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.functions import documents
from cxlake.functions.dates import parse_event_time

# Fixed patterns: a plain decimal number with optional exponent, and a plain
# integer with optional surrounding blanks.
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"

# Money is summed exactly as DECIMAL(38,3) and turned into DOUBLE at the end.
# Amounts that this type can't hold (NaN, infinities, 10^29 and more, so that a
# sum has room for a million of the largest) are an error, never a silent NULL.
MONEY_TYPE = T.DecimalType(38, 3)
MONEY_LIMIT = 1e29
MONEY_ERROR = "amount is not a number or too large for an exact sum"


# Numbers and dates as document-store exports wrap them in JSON.
WRAPPED_NUMBER = r'^\s*\{\s*"\$number(?:Int|Long|Double|Decimal)"\s*:\s*"([^"]*)"\s*\}\s*$'
WRAPPED_DATE = r'^\s*\{\s*"\$date"\s*:\s*"([^"]*)"\s*\}\s*$'
WRAPPED_MILLIS = r'^\s*\{\s*"\$date"\s*:\s*\{\s*"\$numberLong"\s*:\s*"(-?\d+)"\s*\}\s*\}\s*$'


def unwrap_extended_number(col: Column) -> Column:
    """Text of a number exported as extended JSON (``{"$numberInt": "7"}``
    -> ``"7"``); any other text is returned unchanged."""
    return F.when(col.rlike(WRAPPED_NUMBER), F.regexp_extract(col, WRAPPED_NUMBER, 1)).otherwise(col)


def unwrap_extended_date(col: Column) -> Column:
    """Text of a date exported as extended JSON (``{"$date": "..."}``, or epoch
    milliseconds in ``{"$date": {"$numberLong": "..."}}``); other text unchanged."""
    millis = F.timestamp_millis(F.regexp_extract(col, WRAPPED_MILLIS, 1).try_cast(T.LongType()))
    return (
        F.when(col.rlike(WRAPPED_DATE), F.regexp_extract(col, WRAPPED_DATE, 1))
        .when(col.rlike(WRAPPED_MILLIS), F.date_format(millis, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .otherwise(col)
    )


def number_or_zero(col: Column, dtype: T.DataType) -> Column:
    """Declared value -> DOUBLE; NULL, missing, empty or unreadable -> 0.0.

    In documents (VARIANT) each row's own kind decides: a number, plain or wrapped;
    true is 1 and false 0; a date is its milliseconds; text as below."""
    if isinstance(dtype, T.VariantType):
        kind = documents.kind(col)
        found = (
            F.when(kind == documents.NUMBER, documents.plain_number(col))
            .when(kind == documents.BOOLEAN, F.try_variant_get(col, "$", "boolean").cast(T.DoubleType()))
            .when(kind == documents.DATE, F.unix_millis(parse_event_time(col, dtype)).cast(T.DoubleType()))
            .when(kind == documents.TEXT, number_or_zero(documents.text(col), T.StringType()))
        )
        return F.coalesce(found, F.lit(0.0))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(col.cast(T.DoubleType()), F.lit(0.0))
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(col.cast(T.DoubleType()), F.lit(0.0))
    if isinstance(dtype, T.StringType):
        parsed = F.when(col.rlike(DECIMAL_TEXT), col.try_cast(T.DoubleType()))
        return F.coalesce(parsed, F.lit(0.0))
    return F.lit(0.0)


def guarded_int(col: Column) -> Column:
    """Text -> INT when it is a whole number, else NULL (never an error)."""
    text = col.cast(T.StringType())
    return F.when(text.rlike(INTEGER_TEXT), F.trim(text).try_cast(T.IntegerType()))


def money(col: Column) -> Column:
    """DOUBLE amount -> exact DECIMAL(38,3) (half-up); NULL stays NULL, an amount that does not fit raises."""
    fits = ~F.isnan(col) & (F.abs(col) < F.lit(MONEY_LIMIT))
    return F.when(col.isNull() | fits, col.cast(MONEY_TYPE)).otherwise(F.raise_error(F.lit(MONEY_ERROR)).cast(MONEY_TYPE))


def half_up_average(total: Column, count: Column, decimals: int) -> Column:
    """``total / count`` rounded half-up (away from zero) to ``decimals``, as DOUBLE.

    Whole-number arithmetic: ``total`` is a decimal with at most ``decimals``
    places, so nothing is rounded twice."""
    whole = T.DecimalType(38, 0)
    units = (total * F.lit(10**decimals)).cast(whole)
    rest = units % count.cast(whole)
    quotient = ((units - rest) / count.cast(whole)).cast(whole)
    up = F.when(2 * F.abs(rest) >= count.cast(whole), F.signum(units).cast("int")).otherwise(F.lit(0))
    return (quotient + up).cast(T.DoubleType()) / F.lit(float(10**decimals))
