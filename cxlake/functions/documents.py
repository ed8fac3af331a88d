"""Document fields whose type differs from document to document (VARIANT columns).

A JSON export is read with one VARIANT per field, which keeps what each
document holds: text, number, boolean, date object, nothing, or something else.
Every expression here decides per row by the field's *kind*; nothing guesses a
type for the whole column. Extended-JSON wrappers (``{"$date": ...}``,
``{"$numberLong": "7"}``, ``{"$oid": ...}``) are the kinds that they stand for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds of a field.
TEXT, NUMBER, BOOLEAN, DATE, NULL, OTHER = "text", "number", "boolean", "date", "null", "other"

# Wrappers of extended JSON.
NUMBER_WRAPPERS = ("$numberInt", "$numberLong", "$numberDouble", "$numberDecimal")
DATE_WRAPPER, LONG_WRAPPER, ID_WRAPPER = "$date", "$numberLong", "$oid"

_DATE_SCHEMA = r"^OBJECT<`\$date`: (STRING|BIGINT|OBJECT<`\$numberLong`: STRING>)>$"
_NUMBER_SCHEMA = r"^OBJECT<`\$number(Int|Long|Double|Decimal)`: STRING>$"
_ID_SCHEMA = r"^OBJECT<`\$oid`: STRING>$"


def _inner(field: Column, *names: str, of: str = "string") -> Column:
    """A member of an object field; the names go as path steps."""
    return F.try_variant_get(field, "$" + "".join(f"['{n}']" for n in names), of)


def kind(field: Column) -> Column:
    """What a document holds in this field (a missing field is of kind null)."""
    schema = F.schema_of_variant(field)
    return (
        F.when(field.isNull() | (schema == "VOID"), NULL)
        .when(schema == "STRING", TEXT)
        .when(schema == "BOOLEAN", BOOLEAN)
        .when(schema.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))$") | schema.rlike(_NUMBER_SCHEMA), NUMBER)
        .when(schema.rlike(r"^(DATE|TIMESTAMP|TIMESTAMP_NTZ)$") | schema.rlike(_DATE_SCHEMA), DATE)
        .otherwise(OTHER)
    )


def text(field: Column) -> Column:
    """The field as text: wrapped numbers and ids unwrapped, other objects and arrays as JSON, null as NULL.

    Plain numbers come without needless zeros (7.50 is read as the number 7.5)."""
    schema = F.schema_of_variant(field)
    wrapped = F.coalesce(*[_inner(field, w) for w in NUMBER_WRAPPERS])
    return (
        F.when(schema.rlike(_NUMBER_SCHEMA), wrapped)
        .when(schema.rlike(_ID_SCHEMA), _inner(field, ID_WRAPPER))
        .when(schema.rlike("^(OBJECT|ARRAY)<"), F.to_json(field))
        .otherwise(F.try_variant_get(field, "$", "string"))
    )


def date_text(field: Column) -> Column:
    """Text inside a date object (NULL where it holds milliseconds or is none)."""
    return F.when(F.schema_of_variant(field) == "OBJECT<`$date`: STRING>", _inner(field, DATE_WRAPPER))


def date_millis(field: Column) -> Column:
    """Milliseconds inside a date object, as LONG."""
    return F.coalesce(_inner(field, DATE_WRAPPER, LONG_WRAPPER, of="bigint"), F.when(date_text(field).isNull(), _inner(field, DATE_WRAPPER, of="bigint")))


def plain_time(field: Column) -> Column:
    """A timestamp or date held as such (typed sources)."""
    return F.try_variant_get(field, "$", "timestamp")


def plain_number(field: Column) -> Column:
    """Plain or wrapped number as DOUBLE."""
    wrapped = F.coalesce(*[_inner(field, w) for w in NUMBER_WRAPPERS])
    return F.coalesce(F.try_variant_get(field, "$", "double"), wrapped.try_cast("double"))


def is_set(field: Column) -> Column:
    """False for what a program takes as empty: nothing, "", 0, false, an empty array or object."""
    value = text(field)
    of = kind(field)
    return (
        F.when(of == NULL, False)
        .when(of == NUMBER, plain_number(field) != 0)
        .when(of == BOOLEAN, value == "true")
        .when(of == OTHER, ~value.isin("[]", "{}"))
        .otherwise(value != "")
    )
