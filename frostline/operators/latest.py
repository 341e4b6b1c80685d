"""First rows of each group under an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(
    df: DataFrame, keys: list[str], order: list[Column], rows: int = 1, rank: str | None = None
) -> DataFrame:
    """The first ``rows`` rows of each key.

    The filter on the row number becomes a group limit that runs before the
    shuffle, so each task sends at most ``rows`` rows per key whatever the key's size.
    """
    position = rank or "_position"
    window = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(position, F.row_number().over(window)).filter(F.col(position) <= rows)
    return out if rank else out.drop(position)


def newest_first(ts: str = "telemetry_timestamp", tie: str = "record_id") -> list[Column]:
    """Newest reading first; an unreadable clock never wins."""
    return [F.col(ts).desc_nulls_last(), F.col(tie).desc_nulls_last()]


def newest_per_container(df: DataFrame, rows: int = 1, rank: str | None = None) -> DataFrame:
    return first_rows(df, ["container_id"], newest_first(), rows, rank)


def without_retries(df: DataFrame) -> DataFrame:
    """One row per container and timestamp: the one ingested last.

    A reading without container or clock cannot be told from another, so all of them are kept. They are spread over
    the tasks by their record id.
    """
    order = [F.col("ingestion_timestamp").desc_nulls_last(), F.col("record_id").desc_nulls_last()]
    unknown = F.col("container_id").isNull() | F.col("timestamp").isNull()
    known = first_rows(df.filter(~unknown), ["container_id", "timestamp"], order)
    return known.unionByName(df.filter(unknown))
