"""Critical alerts: a reading beyond a limit of its commodity's profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions import documents as doc
from frostline.functions.numeric import epoch_seconds, float_text
from frostline.sources import reference as ref


def _reason(condition: Column, *parts) -> Column:
    text = F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.when(condition, text)


def with_reasons(df: DataFrame, clock: str = "telemetry_timestamp") -> DataFrame:
    """Readings that breach a limit, with the list of reasons.

    A commodity without a profile never alerts, so the profile join is inner.
    """
    t, h, v = F.col("temperature_c"), F.col("humidity_pct"), F.col("vibration_g")
    heat, damp, shock = F.col("temp_critical"), F.col("humidity_max"), F.col("vibration_max")
    # The wording of the reasons
    reasons = F.array(
        _reason(t >= heat, "Temperature ", float_text(t), "°C exceeds critical threshold (", float_text(heat), "°C)"),
        _reason(h > damp, "Humidity ", float_text(h), "% exceeds safe ceiling (", float_text(damp), "%)"),
        _reason(v > shock, "Vibration ", float_text(v), "g exceeds mechanical limit (", float_text(shock), "g)"),
    )
    limits = ref.specs(df.sparkSession).select(
        "commodity", "temp_critical", "humidity_max", "vibration_max"
    )
    return (
        df.join(limits, "commodity")
        .filter((t >= heat) | (h > damp) | (v > shock))
        .withColumn("reasons", F.array_compact(reasons))
        .withColumn(
            "alert_id",
            F.concat(
                F.lit("ALT_"), "container_id", F.lit("_"), epoch_seconds(F.col(clock)).cast("string")
            ),
        )
    )


def alert_documents(alerts: DataFrame, clock: str = "telemetry_timestamp") -> DataFrame:
    """Alerts as nested documents."""
    return alerts.select(
        "alert_id",
        "record_id",
        F.col(clock).alias("timestamp"),
        "container_id",
        "shipment_id",
        "commodity",
        "reasons",
        F.struct("temperature_c", "humidity_pct", "vibration_g").alias("current_readings"),
        F.struct("latitude", "longitude").alias("location"),
    )


def alert_lines(documents: DataFrame) -> DataFrame:
    """Alerts flattened, with the reasons on one line."""
    return documents.select(
        "alert_id",
        "record_id",
        "timestamp",
        "container_id",
        "shipment_id",
        "commodity",
        F.size("reasons").alias("reason_count"),
        F.array_join("reasons", " | ").alias("reason_line"),
        "current_readings.temperature_c",
        "current_readings.humidity_pct",
        "current_readings.vibration_g",
        "location.latitude",
        "location.longitude",
    )


def alert_payload(documents: DataFrame) -> DataFrame:
    """Alerts as messages for the alert topic."""
    body = doc.json_object(
        {
            "alert_id": F.col("alert_id"),
            "timestamp": doc.iso_time(F.col("timestamp")),
            "container_id": F.col("container_id"),
            "shipment_id": F.col("shipment_id"),
            "commodity": F.col("commodity"),
            "reasons": F.col("reasons"),
            "current_readings": F.struct(
                doc.number(F.col("current_readings.temperature_c"), 2).alias("temperature_c"),
                doc.number(F.col("current_readings.humidity_pct"), 2).alias("humidity_pct"),
                doc.number(F.col("current_readings.vibration_g"), 3).alias("vibration_g"),
            ),
            "location": F.struct(
                doc.number(F.col("location.latitude"), 6).alias("latitude"),
                doc.number(F.col("location.longitude"), 6).alias("longitude"),
            ),
        }
    )
    return documents.select(F.col("container_id").alias("key"), body.alias("value"))
