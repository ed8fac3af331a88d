"""Claim pipeline: usage logs -> claim detail -> monthly and per-class rollups.

Every function maps DataFrame -> DataFrame and only builds a lazy plan.

Plan shape of ``claim_detail`` (checked with ``explain``): the filters on
presence are pushed to the scan; the first-record-per-OT step is a
``row_number() = 1`` window, which Spark turns into a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it. The partial
step keeps at most one row per OT per input partition, so even an OT holding a
third of all rows reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.functions import documents
from cxlake.functions.casts import half_up_average, money, number_or_zero
from cxlake.functions.dates import month_key, resolve_event_date, truncate_to_second
from cxlake.session import use_checkpoint_dir

# Class label for a missing class, user label for a missing
# user, the class spellings that are excluded, and the money precision.
NO_CLASS = "Sin clasificación"
NO_USER = "Sin usuario"
EXCLUDED_CLASSES: tuple[str, ...] = ("n/a", "N/A", "N/a", "n/A")
DECIMALS = 3

USER_FIELDS: tuple[str, ...] = ("user", "usuario", "username", "user_id")

# Bits of the bitmap of an exclusion list (at most 2^19 words are broadcast), and salts of a listed name.
EXCLUSION_MARKS, EXCLUSION_SALTS = 1 << 25, 16


def _col_or_null(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """A document field that may be missing from the source schema."""
    if name in df.columns:
        return F.col(name), df.schema[name].dataType
    return F.lit(None).cast(T.StringType()), T.NullType()


def _text(df: DataFrame, name: str) -> Column:
    """A key-like document field as text. Kept a plain column expression so
    predicates on it reach the scan (a VARIANT field is told by its own kind)."""
    col, dtype = _col_or_null(df, name)
    return documents.text(col) if isinstance(dtype, T.VariantType) else col.cast(T.StringType())


def _tie_breaker(df: DataFrame, name: str) -> Column:
    """The tie breaker; a VARIANT has no order, its text has."""
    return _text(df, name).alias(name) if isinstance(df.schema[name].dataType, T.VariantType) else F.col(name)


def event_date(logs: DataFrame, date_field: str = "created_at", fallback_date_field: str = "fecha_escaneo") -> Column:
    """Resolved event time of each log (see ``resolve_event_date``)."""
    created, created_t = _col_or_null(logs, date_field)
    scanned, scanned_t = _col_or_null(logs, fallback_date_field)
    return resolve_event_date(created, created_t, scanned, scanned_t)


def valid_ot(logs: DataFrame) -> Column:
    """OT present and not empty (whitespace-only is kept; of documents, 0 and false are empty as well)."""
    col, dtype = _col_or_null(logs, "ot")
    if isinstance(dtype, T.VariantType):
        return documents.is_set(col)
    ot_text = _text(logs, "ot")
    return ot_text.isNotNull() & (ot_text != F.lit(""))


def not_excluded_user(logs: DataFrame, excluded_users: Sequence[str]) -> Column:
    """True unless ANY user field holds an excluded name (NULL is kept).

    Written as ``c IS NULL OR NOT c IN (...)`` per field (the list holds no
    NULL), a form the parquet reader can take as a pushed filter.
    """
    keep = F.lit(True)
    excluded = [u for u in excluded_users if u is not None]
    if excluded:
        for name in (c for c in USER_FIELDS if c in logs.columns):
            c = _text(logs, name)
            keep = keep & (c.isNull() | ~c.isin(excluded))
    return keep


def without_users(logs: DataFrame, excluded: DataFrame, marks: int = EXCLUSION_MARKS, fields: Sequence[str] = USER_FIELDS) -> DataFrame:
    """As ``not_excluded_user`` for a list of any size: ``excluded`` has the names in its first column.

    A bitmap of ``marks`` bits (a multiple of 64) has the hashes of the names set. It is held as
    words of 64 bits, so its broadcast has at most ``marks / 64`` rows whatever the list. Rows none
    of whose users is marked pass where they lie; only the others (those with a listed user, and a
    share that grows with the list's length over ``marks``) are shuffled and compared with the names.
    The logs are read once: the marked rows are a checkpoint, so pass the columns that are needed.
    A name of many rows is spread over salts. Nulls, in the list or the logs, exclude nothing."""
    fields = [c for c in fields if c in logs.columns]
    if not fields:
        return logs
    names = excluded.select(F.col(excluded.columns[0]).cast(T.StringType()).alias("_name")).where("_name is not null").distinct()

    def place(name: Column) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(name), F.lit(marks))
        return F.shiftright(at, 6), (at % 64).cast("int")

    word, bit = place(F.col("_name"))
    marked_bit = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = names.groupBy(word.alias("_word")).agg(F.bit_or(marked_bit).alias("_mask"))
    rows, suspected = logs, []
    for i, c in enumerate(fields):
        user = _text(logs, c)
        word, bit = place(user)
        known = F.broadcast(words.select(F.col("_word").alias(f"_word{i}"), F.col("_mask").alias(f"_mask{i}")))
        rows = rows.join(known, F.when(user.isNotNull(), word) == known[f"_word{i}"], "left")
        suspected.append(F.when(F.getbit(F.col(f"_mask{i}"), bit) == 1, user))
    use_checkpoint_dir(logs.sparkSession)
    rows = rows.select(*logs.columns, F.array_compact(F.array(*suspected)).alias("_users"), F.monotonically_increasing_id().alias("_row")).checkpoint()

    suspects = rows.where(F.size("_users") > 0)
    carried = suspects.select("_row", F.explode("_users").alias("_name"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(EXCLUSION_SALTS - 1))).alias("_salt")
    listed = carried.select("_name").distinct().join(names, "_name", "left_semi").select("_name", salts)
    salted = carried.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(EXCLUSION_SALTS)).cast("int"))
    gone = salted.join(listed, ["_name", "_salt"], "left_semi").select("_row")
    kept = suspects.join(gone, "_row", "left_anti").select(*logs.columns)
    return rows.where(F.size("_users") == 0).select(*logs.columns).unionByName(kept)


def declared_value(logs: DataFrame, value_field: str = "valor_declarado") -> Column:
    value_col, value_t = _col_or_null(logs, value_field)
    return number_or_zero(value_col, value_t)


def class_or_default(logs: DataFrame) -> Column:
    return F.coalesce(_text(logs, "clasificacion"), F.lit(NO_CLASS))


def user_or_default(logs: DataFrame) -> Column:
    chain = [_text(logs, c) for c in USER_FIELDS if c in logs.columns]
    return F.coalesce(*chain, F.lit(NO_USER))


def claim_candidates(
    logs: DataFrame,
    excluded_users: Sequence[str] | DataFrame = (),
    excluded_classes: Sequence[str] = EXCLUDED_CLASSES,
    date_field: str = "created_at",
    fallback_date_field: str = "fecha_escaneo",
    value_field: str = "valor_declarado",
    tie_breaker: str | None = "log_id",
) -> DataFrame:
    """Usage logs -> classified, valid candidate records (one per log).

    Output columns: ot, event_ts, clasificacion, valor, usuario and the tie
    breaker (when given). Order of the steps matters and follows the source:
    date -> OT -> excluded users -> defaults -> excluded classes. Users in a
    DataFrame (a list of any size, see ``without_users``) are excluded last, when
    the rows are few and narrow: all these steps are filters on single rows.
    """
    as_table = isinstance(excluded_users, DataFrame)
    user_fields = [c for c in USER_FIELDS if as_table and c in logs.columns]
    df = (
        logs.withColumn("_event_ts", event_date(logs, date_field, fallback_date_field))
        .where(F.col("_event_ts").isNotNull())
        .where(valid_ot(logs))
        .where(not_excluded_user(logs, () if as_table else excluded_users))
    )
    df = df.select(
        _text(logs, "ot").alias("ot"),
        F.col("_event_ts").alias("event_ts"),
        class_or_default(logs).alias("clasificacion"),
        declared_value(logs, value_field).alias("valor"),
        user_or_default(logs).alias("usuario"),
        *([_tie_breaker(logs, tie_breaker)] if tie_breaker else []),
        *[_text(logs, c).alias(f"_user_{c}") for c in user_fields],
    )
    if excluded_classes:
        df = df.where(~F.col("clasificacion").isin(list(excluded_classes)))
    if as_table:
        names = [f"_user_{c}" for c in user_fields]
        df = without_users(df, excluded_users, fields=names).drop(*names)
    return df


def first_per_ot(candidates: DataFrame, tie_breaker: str | None = "log_id") -> DataFrame:
    """Earliest record per OT (by event time, then the tie breaker)."""
    order = [F.col("event_ts").asc()]
    if tie_breaker:
        order.append(F.col(tie_breaker).asc())
    w = Window.partitionBy("ot").orderBy(*order)
    return (
        candidates.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


def to_detail(first: DataFrame, *more: str) -> DataFrame:
    """First records -> the detail table's six columns and types (then the columns ``more``, as they are)."""
    return first.select(
        month_key(F.col("event_ts")).alias("Mes"),
        F.col("clasificacion").alias("Clasificacion"),
        F.col("ot").alias("OT"),
        F.round(F.col("valor"), DECIMALS).alias("Valor_Declarado_CLP"),
        truncate_to_second(F.col("event_ts")).alias("Fecha_Creacion"),
        F.col("usuario").alias("Usuario"),
        *more,
    )


def claim_detail(
    logs: DataFrame,
    excluded_users: Sequence[str] | DataFrame = (),
    excluded_classes: Sequence[str] = EXCLUDED_CLASSES,
    tie_breaker: str | None = "log_id",
) -> DataFrame:
    """Usage logs -> detail table (one row per OT)."""
    candidates = claim_candidates(
        logs,
        excluded_users=excluded_users,
        excluded_classes=excluded_classes,
        tie_breaker=tie_breaker,
    )
    return to_detail(first_per_ot(candidates, tie_breaker=tie_breaker))


def sorted_detail(detail: DataFrame) -> DataFrame:
    """Presentation order: month, then class. Only for display sinks."""
    return detail.orderBy("Mes", "Clasificacion", "OT")


# ---------------------------------------------------------------------------
# Rollups. Money is summed exactly as DECIMAL and turned into DOUBLE at the
# end, so the result does not depend on partitioning or summation order.
# ---------------------------------------------------------------------------


def _money_sum() -> Column:
    return F.sum(money(F.col("Valor_Declarado_CLP")))


def _average(total: Column, count: Column) -> Column:
    # over the rows that the total sums: a detail row always has an amount
    return half_up_average(total, count, DECIMALS)


def _state(detail: DataFrame, *by: str) -> DataFrame:
    """Mergeable state of a rollup: how many (``n``) and the exact sum (``total``)."""
    return detail.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), _money_sum().alias("total"))


def summary_of(state: DataFrame) -> DataFrame:
    return state.select(
        "Mes",
        "Clasificacion",
        F.col("n").cast(T.IntegerType()).alias("Cantidad"),
        F.col("total").cast(T.DoubleType()).alias("Suma_Total_CLP"),
        _average(F.col("total"), F.col("n")).alias("Promedio_CLP"),
    )


def evolution_of(state: DataFrame) -> DataFrame:
    return state.select(
        "Mes",
        "Clasificacion",
        F.col("total").cast(T.DoubleType()).alias("Suma_Total_CLP"),
        F.col("n").cast(T.LongType()).alias("Cantidad"),
    )


def top_of(state: DataFrame) -> DataFrame:
    return state.select(
        "Clasificacion",
        F.col("total").cast(T.DoubleType()).alias("Suma_Total_CLP"),
        F.col("n").cast(T.LongType()).alias("Cantidad"),
        _average(F.col("total"), F.col("n")).alias("Promedio_CLP"),
    )


def claim_summary(detail: DataFrame) -> DataFrame:
    """Per (Mes, Clasificacion): Cantidad, Suma_Total_CLP, Promedio_CLP."""
    return summary_of(_state(detail, "Mes", "Clasificacion"))


def claim_evolution(detail: DataFrame) -> DataFrame:
    """Per (Mes, Clasificacion): Suma_Total_CLP, Cantidad."""
    return evolution_of(_state(detail, "Mes", "Clasificacion"))


def claim_top(detail: DataFrame) -> DataFrame:
    """Per class over all months (``ranked_top`` puts the largest total first)."""
    return top_of(_state(detail, "Clasificacion"))


def ranked_top(top: DataFrame) -> DataFrame:
    """Presentation order of ``claim_top``. Only for display sinks."""
    return top.orderBy(F.col("Suma_Total_CLP").desc(), F.col("Clasificacion").asc())
