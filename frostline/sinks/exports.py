"""Export shapes: topic messages and the reporting bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.functions import documents as doc
from frostline.functions.numeric import float_text


def kafka_payload(readings: DataFrame) -> DataFrame:
    """Readings as topic messages keyed by container."""
    body = doc.json_object(
        {
            "timestamp": doc.iso_time(F.col("timestamp")),
            "container_id": F.col("container_id"),
            "shipment_id": F.col("shipment_id"),
            "commodity": F.col("commodity"),
            "temperature_c": doc.number(F.col("temperature_c"), 2),
            "humidity_pct": doc.number(F.col("humidity_pct"), 2),
            "vibration_g": doc.number(F.col("vibration_g"), 3),
            "latitude": doc.number(F.col("latitude"), 6),
            "longitude": doc.number(F.col("longitude"), 6),
            "origin": F.col("origin"),
            "destination": F.col("destination"),
            "quantity_kg": F.col("quantity_kg"),
        }
    )
    return readings.select(F.col("container_id").alias("key"), body.alias("value"))


def export_telemetry(readings: DataFrame) -> DataFrame:
    return readings.select(
        F.col("timestamp").alias("recorded_at"),
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
    )


def export_health(decisions: DataFrame) -> DataFrame:
    return decisions.select(
        "container_id",
        "shipment_id",
        "commodity",
        "latitude",
        "longitude",
        "temperature_c",
        "humidity_pct",
        "vibration_g",
        "spoilage_risk_score",
        "risk_level",
        "time_to_spoilage_hours",
    )


def export_arbitrage(decisions: DataFrame) -> DataFrame:
    return decisions.withColumnsRenamed(
        {
            "current_price": "current_dest_price_per_kg",
            "recommended_price": "recommended_market_price",
            "action": "recommendation_action",
        }
    )


def write_bundle(
    readings: DataFrame, decisions: DataFrame, dimensions: dict[str, DataFrame], folder: str
) -> dict[str, str]:
    """Replace the reporting bundle: telemetry, health, arbitrage and the dimensions."""
    bundle = {
        "stg_sensor_telemetry": export_telemetry(readings),
        "fct_container_health": export_health(decisions),
        "fct_spoilage_arbitrage": export_arbitrage(decisions),
        **{f"dim_{name}": df for name, df in dimensions.items()},
    }
    for name, df in bundle.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return {name: f"{folder}/{name}" for name in bundle}


def decision_report(decisions: DataFrame) -> DataFrame:
    """Decisions as text for a printed table: units, thousands and signs."""

    def measure(column: str, unit: str):
        return F.concat(float_text(F.col(column)), F.lit(unit)).alias(column)

    def money(column: str, signed: bool = False):
        amount = F.bround(F.col(column).cast("decimal(20,2)"), 0)
        sign = F.when(amount >= 0, "+").otherwise("") if signed else F.lit("")
        return F.concat(F.lit("INR "), sign, F.format_number(amount, 0)).alias(column)

    return decisions.select(
        "container_id",
        "commodity",
        measure("temperature_c", "°C"),
        measure("humidity_pct", "%"),
        measure("vibration_g", "g"),
        measure("spoilage_risk_score", "/100"),
        "risk_level",
        measure("time_to_spoilage_hours", " hrs"),
        "current_destination",
        money("current_expected_value"),
        money("potential_loss"),
        "recommended_destination",
        money("reroute_expected_value"),
        money("reroute_cost"),
        money("spoilage_arbitrage_inr", signed=True),
        "action",
    )
