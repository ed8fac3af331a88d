"""File sinks: CSV, parquet, single-file export, JSON rows; name cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.functions.text import clean_names

CSV_SEPARATOR = ";"
# ISO-8601 text as Python's isoformat() writes it: the fraction only when it
# is not zero.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_DATE = "yyyy-MM-dd"


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename columns to ``[A-Za-z0-9_]`` (metadata only, no data pass)."""
    return df.toDF(*clean_names(df.columns))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = CSV_SEPARATOR) -> None:
    """``;``-separated CSV with a header, cleaned column names.

    Values are written as they are: Spark's writer trims surrounding blanks
    by default, which would change text, so trimming is switched off.
    """
    (
        clean_columns(df)
        .write.mode(mode)
        .option("sep", sep)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    csv_path: str | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """Parquet with cleaned column names; optionally a CSV copy as well."""
    out = clean_columns(df)
    writer = out.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    if csv_path:
        write_csv(out, csv_path, mode=mode)


def export_parquet(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """Export a query result. Many files by default; with ``single_file`` the
    result is computed at full width and then written by one task, so use it
    only for results of known small size."""
    (df.repartition(1) if single_file else df).write.mode(mode).parquet(path)


def _json_safe(col: Column, dtype: T.DataType) -> Column:
    """A value as JSON can hold it, also inside arrays, structs and maps."""
    if isinstance(dtype, T.DecimalType):
        return col.cast(T.DoubleType())
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(col, "SSSSSS") == F.lit("000000")
        return F.when(whole, F.date_format(col, ISO_SECONDS)).otherwise(F.date_format(col, ISO_MICROS))
    if isinstance(dtype, T.DateType):
        return F.date_format(col, ISO_DATE)
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _json_safe(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = F.struct(*[_json_safe(col[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(col.isNotNull(), fields)
    if isinstance(dtype, T.MapType):
        values = F.transform_values(col, lambda k, v: _json_safe(v, dtype.valueType))
        return F.transform_keys(values, lambda k, v: k.cast(T.StringType()))
    if isinstance(dtype, T.BinaryType):
        return F.base64(col)
    if isinstance(dtype, (T.NumericType, T.BooleanType, T.StringType, T.VariantType)):
        return col
    return col.cast(T.StringType())


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON text per row: dates/timestamps as ISO text, decimals as numbers
    (double), binary as base64, other types as text, NULL fields kept as ``null``."""
    fields = [_json_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json"))


def export_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one object per row (see ``json_rows``)."""
    json_rows(df).write.mode(mode).text(path)
