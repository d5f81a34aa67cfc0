"""Input validation that raises before any job runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def require_timestamp(df: DataFrame, column: str) -> T.DataType:
    dtype = df.schema[column].dataType
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"column '{column}' must be a timestamp, got {dtype.simpleString()}")
    return dtype
