"""Column naming."""

from __future__ import annotations

from pyspark.sql import DataFrame


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])
