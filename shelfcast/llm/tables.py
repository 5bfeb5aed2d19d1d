"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.session import table_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table, so that later steps and retries do not run the earlier ones again."""
    path = table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
