"""Source scans with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.forecast import horizon_columns
from shelfcast.operators.reshape import nan_to_null
from shelfcast.schema import HORIZON

SALES_KEYS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]

CALENDAR_SCHEMA = (
    "date DATE, wm_yr_wk INT, weekday STRING, wday INT, month INT, year INT, d STRING, "
    "event_name_1 STRING, event_type_1 STRING, event_name_2 STRING, event_type_2 STRING, "
    "snap_CA INT, snap_TX INT, snap_WI INT"
)
PRICE_SCHEMA = "store_id STRING, item_id STRING, wm_yr_wk INT, sell_price DOUBLE"


def day_columns(df: DataFrame) -> list[str]:
    """Day columns ``d_<n>`` in day order."""
    return sorted((c for c in df.columns if c.startswith("d_")), key=lambda c: int(c[2:]))


def read_sales_wide(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Wide sales matrix (S1). The header names the columns; nothing is inferred from the data."""
    raw = spark.read.option("header", True).csv(path)
    days = day_columns(raw)
    _require(raw, SALES_KEYS if days else [*SALES_KEYS, "d_1"])
    return raw.select(*SALES_KEYS, *[F.col(c).cast("int").alias(c) for c in days])


def read_sales_wide_checked(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Wide sales matrix and its rejects (S1): (matrix, cells that hold no whole number).

    The schema comes from the header. A malformed cell is NULL in the matrix and a row (id, column, text) of the
    rejects; an empty cell is a missing value and no reject. Both frames scan the file; the rejects are found in one
    narrow pass over it.
    """
    raw = spark.read.option("header", True).csv(path)
    days = day_columns(raw)
    _require(raw, SALES_KEYS if days else [*SALES_KEYS, "d_1"])

    def number(c: str):
        return F.col(c).try_cast("int")

    good = raw.select(*SALES_KEYS, *[number(c).alias(c) for c in days])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("text")) for c in days])
    bad = F.filter(cells, lambda x: x["text"].isNotNull() & x["text"].try_cast("int").isNull())
    return good, raw.select("id", F.explode(bad).alias("x")).select("id", "x.column", "x.text")


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar dimension (S3), columns matched by the header's names."""
    return _csv_by_name(spark, path, CALENDAR_SCHEMA)


def read_prices(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Weekly prices."""
    return _csv_by_name(spark, path, PRICE_SCHEMA)


def _csv_by_name(spark: SparkSession, path, ddl: str) -> DataFrame:
    """CSV columns picked by header name and cast to the declared types; empty text is NULL."""
    raw = spark.read.option("header", True).csv(path)
    wanted = [part.strip().split(" ") for part in ddl.split(",")]
    _require(raw, [n for n, _ in wanted])
    return nan_to_null(raw.select(*[F.col(n).cast(t).alias(n) for n, t in wanted]))


def _require(raw: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in raw.columns]
    if missing:
        raise ValueError(f"the header lacks {missing}")


def read_forecasts(spark: SparkSession, paths: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """Forecast files as one frame with the file name of each row."""
    schema = "id STRING, " + ", ".join(f"{c} DOUBLE" for c in horizon_columns(horizon))
    df = spark.read.option("header", True).schema(schema).csv(list(paths))
    return df.withColumn("file", F.col("_metadata.file_name"))


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """Ids that a submission must hold."""
    return spark.read.option("header", True).csv(path).select("id")
