"""Writing tables and files, and where working data goes."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for a job's tables and stream checkpoints.

    On a cluster this lies in the shared folder named by ``spark.checkpoint.dir``.
    Only a session of one process may fall back to the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/frostline-{purpose}-{uuid.uuid4().hex}"


def write_mart(df: DataFrame, path: str) -> DataFrame:
    """Replace a mart table and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_readings(
    df: DataFrame, path: str, clock: str, mode: str = "append", batch: str | int | None = None
) -> None:
    """Write readings partitioned by day and sorted by container and time.

    The rebalance hint lets Spark cut a crowded day into several files and join the
    small ones; the sort keeps a container's rows together within a file. With a ``batch``
    key the rows become that batch of the table, all or none, and take the place of any
    rows the batch had: a job that is repeated leaves one copy.
    """
    if batch is not None:
        path, mode = batch_folder(path, batch), "overwrite"
    dated = (
        df.withColumn("event_date", F.to_date(clock))
        .hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "container_id", clock)
    )
    dated.write.mode(mode).partitionBy("event_date").parquet(path)


def batch_folder(path: str, batch: str | int) -> str:
    """Where a batch of a table lies: a partition of it, named so that no key is taken for a path."""
    return f"{path.rstrip('/')}/batch={quote(str(batch), safe='')}"


def read_readings(df: DataFrame, path: str) -> DataFrame:
    """Readings written by ``write_readings``, with or without batches: the columns of ``df`` and their day."""
    schema = StructType([*df.schema.fields, StructField("event_date", DateType())])
    return df.sparkSession.read.schema(schema).parquet(path).select(schema.names)


def append_json(df: DataFrame, path: str, batch: str | int | None = None) -> None:
    """Append rows as JSON, one object per line; with a ``batch`` key, as that batch, once however often it is written."""
    mode = "append" if batch is None else "overwrite"
    path = path if batch is None else batch_folder(path, batch)
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
