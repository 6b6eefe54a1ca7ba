"""Typed access to the tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: A table below this many bytes on disk may be collected or broadcast as a dimension.
SMALL_BYTES = 8 * 1024 * 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table (a file or a folder of files) of a data folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def small_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a dimension whose size is checked: more than `limit` rows raise, they are never cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows, too many for a dimension")
    return rows
