"""Staging: trim, type and default the raw tables, and tag threshold breaches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions.numeric import flag
from frostline.sources import reference as ref

VIBRATION_ALERT_G = 0.20
VIBRATION_FAULT_G = 0.25

STAGED_COLUMNS = [
    "record_id",
    "telemetry_timestamp",
    "container_id",
    "shipment_id",
    "commodity",
    "temperature_c",
    "humidity_pct",
    "vibration_g",
    "latitude",
    "longitude",
    "origin",
    "destination",
    "quantity_kg",
    "speed_kmh",
    "door_open",
    "compressor_status",
    "anomaly_mode",
]
FLAG_COLUMNS = [
    "is_temperature_alert",
    "is_humidity_alert",
    "is_vibration_alert",
    "is_mechanical_alert",
]


def _trim(*names: str) -> list[Column]:
    return [F.trim(n).alias(n) for n in names]


def _double(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def _or_default(name: str, default, kind: str) -> Column:
    return F.coalesce(F.col(name), F.lit(default)).cast(kind).alias(name)


def _time(name: str) -> Column:
    return F.col(name).try_cast("timestamp_ntz")


def alert_flags(df: DataFrame, bands: DataFrame | None = None) -> DataFrame:
    """Add the four threshold flags; an unknown commodity or a NULL measure raises none."""
    bands = bands or ref.alert_bands(df.sparkSession)
    temperature, humidity = F.col("temperature_c"), F.col("humidity_pct")
    vibration = F.col("vibration_g")
    failing = F.col("compressor_status").isin("DEGRADED", "FAILURE")
    return (
        df.join(bands, "commodity", "left")
        .withColumns(
            {
                "is_temperature_alert": flag(
                    (temperature < F.col("temp_low")) | (temperature > F.col("temp_high"))
                ),
                "is_humidity_alert": flag(
                    (humidity < F.col("hum_low")) | (humidity > F.col("hum_high"))
                ),
                "is_vibration_alert": flag(vibration >= VIBRATION_ALERT_G),
                "is_mechanical_alert": flag(failing | (vibration >= VIBRATION_FAULT_G)),
            }
        )
        .drop("temp_low", "temp_high", "hum_low", "hum_high")
    )


def type_readings(raw: DataFrame) -> DataFrame:
    """Trim, type and default raw readings; those without container or time text are dropped."""
    return raw.filter(F.col("container_id").isNotNull() & F.col("timestamp").isNotNull()).select(
        "record_id",
        _time("timestamp").alias("telemetry_timestamp"),
        *_trim("container_id", "shipment_id", "commodity"),
        *_double("temperature_c", "humidity_pct", "vibration_g", "latitude", "longitude"),
        *_trim("origin", "destination"),
        F.col("quantity_kg").cast("bigint").alias("quantity_kg"),
        _or_default("speed_kmh", 50.0, "double"),
        _or_default("door_open", False, "boolean"),
        F.coalesce(F.trim("compressor_status"), F.lit("NORMAL")).alias("compressor_status"),
        F.coalesce(F.trim("anomaly_mode"), F.lit("NORMAL")).alias("anomaly_mode"),
        "ingestion_timestamp",
    )


def stage_telemetry(raw: DataFrame, bands: DataFrame | None = None) -> DataFrame:
    """Raw readings to 22 typed columns."""
    return alert_flags(type_readings(raw), bands).select(*STAGED_COLUMNS, "ingestion_timestamp", *FLAG_COLUMNS)


def stage_prices(raw: DataFrame, as_of: Column) -> DataFrame:
    """Price quotes with a market, a commodity and a positive price."""
    usable = (
        F.col("market").isNotNull() & F.col("commodity").isNotNull() & (F.col("price_per_kg") > 0)
    )
    return raw.filter(usable).select(
        *_trim("market", "commodity"),
        *_double("price_per_kg"),
        F.coalesce(F.trim("currency"), F.lit("INR")).alias("currency"),
        F.coalesce(_time("last_updated"), as_of.cast("timestamp_ntz")).alias("price_timestamp"),
    )


def stage_markets(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("market_id").isNotNull()).select(
        *_trim("market_id", "market_name"),
        *_double("latitude", "longitude"),
        *_trim("state", "tier"),
        _or_default("handling_fee_pct", 0.02, "double"),
        _or_default("cold_storage_capacity_tons", 3000, "bigint"),
    )


def stage_routes(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("route_id").isNotNull()).select(
        *_trim("route_id", "origin", "destination"),
        *_double("distance_km", "estimated_transit_hours"),
        _or_default("toll_cost_inr", 0.0, "double"),
        _or_default("road_condition_index", 0.85, "double"),
    )
