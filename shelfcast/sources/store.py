"""Parquet feature store, weight store and forecast sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.schema import ANCHORS, TERMS


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> DataFrame:
    """Write a frame as Parquet and return the frame that reads it back.

    This is also how a plan is cut between stages: the table lies in shared
    storage, so a lost executor never causes the earlier stages to run again.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(_table_schema(df, partition_by)).parquet(path)


def _table_schema(df: DataFrame, partition_by: Sequence[str]):
    fields = {f.name: f for f in df.schema.fields}
    schema = type(df.schema)([f for n, f in fields.items() if n not in partition_by])
    for name in partition_by:
        schema = schema.add(fields[name])
    return schema


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the listed columns of a table (S6): Parquet reads nothing else."""
    return spark.read.parquet(path).select(*columns)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, key: str = "id", order: str = "d", path: str | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Table bucketed by series: joins and windows by ``key`` need no shuffle, and tables of as many buckets meet as they are.

    The rows are dealt to the buckets before they are written, so a bucket is one file per partition value. ``path`` puts
    the files there and leaves the name to the catalog. An existing table is an error.
    """
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key, *([order] if order in df.columns else []))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_predictions(df: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Prediction table by (term, anchor); the partitions that ``df`` holds are replaced, the others stay.

    The future term has no anchor: its partition is that of NULL. Readers that filter on term or anchor read those partitions only. With
    ``files``, a number for each partition, the rows are dealt out by partition and id, so that what a task sorts does not grow with the table.
    """
    if files is not None:
        slots = 1 + (len(TERMS) - 1) * len(ANCHORS)
        df = df.repartition(files * slots, "term", "anchor", F.pmod(F.xxhash64("id"), F.lit(files)))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("term", "anchor").parquet(path)
    return read_predictions(df.sparkSession, path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions (term, anchor, id, d, pred, target and whatever else was written)."""
    return spark.read.parquet(path).withColumn("anchor", F.col("anchor").cast("int"))


WEIGHT_TABLES = ("membership", "scale", "weight")


def write_weights(path: str, membership: DataFrame, scale: DataFrame, weight: DataFrame) -> None:
    """Weight store (S7): one table each, partitioned by store; the stores that a frame holds are replaced, the others stay."""
    for name, df in zip(WEIGHT_TABLES, (membership, scale, weight)):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("store_id").parquet(f"{path}/{name}")


def read_weights(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(membership, scale, weight) as written; a filter on ``store_id`` reads its partitions only."""
    return tuple(spark.read.parquet(f"{path}/{name}").withColumn("store_id", F.col("store_id").cast("string")) for name in WEIGHT_TABLES)


def write_forecast(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Forecast table as CSV with a header."""
    df.write.mode(mode).option("header", True).csv(path)
