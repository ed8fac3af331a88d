"""Turn whatever a table builder returned into a Spark DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def normalize_result(spark: SparkSession, result) -> DataFrame:
    """Spark DataFrame -> as is; non-empty pandas -> Spark; else an error.

    Builders in this package return Spark DataFrames; pandas is accepted for
    small hand-made inputs only (it travels through the driver).
    """
    if isinstance(result, DataFrame):
        return result
    try:  # Spark Connect DataFrames are a different class
        from pyspark.sql.connect.dataframe import DataFrame as ConnectDataFrame

        if isinstance(result, ConnectDataFrame):
            return result
    except Exception:  # pragma: no cover - connect extras not installed
        pass
    try:
        import pandas as pd
    except ImportError:  # pragma: no cover
        pd = None
    if pd is not None and isinstance(result, pd.DataFrame):
        if result.empty:
            raise ValueError("the builder returned an empty pandas DataFrame")
        return spark.createDataFrame(result)
    if result is None:
        raise ValueError("the builder returned None")
    raise TypeError(f"unsupported builder result type: {type(result).__name__}")
