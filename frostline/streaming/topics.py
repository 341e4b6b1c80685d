"""Topic sources and sinks. They need Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TELEMETRY_TOPIC = "sensor-data"
ALERT_TOPIC = "alerts"


def source_options(servers: str, topic: str, rows_per_batch: int | None = None) -> dict[str, str]:
    """Read a topic from its beginning, optionally in batches of a row count."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if rows_per_batch:
        options["maxOffsetsPerTrigger"] = str(rows_per_batch)
    return options


def trigger(seconds: float | None = None) -> dict:
    """Run every few seconds, or once over what is there and stop."""
    if seconds is None:
        return {"availableNow": True}
    return {"processingTime": f"{seconds:g} seconds"}


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str = TELEMETRY_TOPIC,
    rows_per_batch: int | None = None,
) -> DataFrame:
    """Messages of a topic as (record_id, key, value) text."""
    options = source_options(servers, topic, rows_per_batch)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.concat_ws("-", "topic", "partition", "offset").alias("record_id"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def write_topic(payload: DataFrame, servers: str, topic: str, checkpoint: str, **when):
    """Publish (key, value) rows, waiting for all replicas."""
    return (
        payload.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(**when))
        .start()
    )
