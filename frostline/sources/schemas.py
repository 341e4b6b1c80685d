"""Schemas of the wire event and of the raw tables, and the raw tables' defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.functions.documents import iso_time

REQUIRED_FIELDS = [
    "timestamp",
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
]
OPTIONAL_FIELDS = ["speed_kmh", "door_open", "compressor_status", "anomaly_mode"]
EVENT_FIELDS = REQUIRED_FIELDS + OPTIONAL_FIELDS

EVENT_SCHEMA = (
    "timestamp string, container_id string, shipment_id string, commodity string,"
    " temperature_c double, humidity_pct double, vibration_g double,"
    " latitude double, longitude double, origin string, destination string,"
    " quantity_kg bigint, speed_kmh double, door_open boolean,"
    " compressor_status string, anomaly_mode string"
)

SENSOR_TELEMETRY = (
    "record_id string, ingestion_timestamp timestamp_ntz, timestamp timestamp_ntz,"
    " container_id string, shipment_id string, commodity string,"
    " temperature_c decimal(5,2), humidity_pct decimal(5,2), vibration_g decimal(5,2),"
    " latitude decimal(9,6), longitude decimal(9,6), origin string, destination string,"
    " quantity_kg decimal(10,0), speed_kmh decimal(5,2), door_open boolean,"
    " compressor_status string, anomaly_mode string"
)
COMMODITY_PRICES = (
    "market string, commodity string, price_per_kg decimal(10,2), currency string,"
    " last_updated string"
)
MARKETS = (
    "market_id string, market_name string, latitude decimal(9,6), longitude decimal(9,6),"
    " state string, tier string, handling_fee_pct decimal(4,3),"
    " cold_storage_capacity_tons decimal(10,0)"
)
ROUTES = (
    "route_id string, origin string, destination string, distance_km decimal(8,2),"
    " estimated_transit_hours decimal(6,2), toll_cost_inr decimal(10,2),"
    " road_condition_index decimal(4,2)"
)

RAW_TABLES = {
    "sensor_telemetry": SENSOR_TELEMETRY,
    "commodity_prices": COMMODITY_PRICES,
    "markets": MARKETS,
    "routes": ROUTES,
}

# Column defaults of the raw tables. A missing speed stays NULL here:
# staging knows it as "not reported" and assumes 50 km/h.
RAW_DEFAULTS = {
    "sensor_telemetry": {
        "door_open": False,
        "compressor_status": "NORMAL",
        "anomaly_mode": "NORMAL",
    },
    "commodity_prices": {"currency": "INR"},
    "markets": {"handling_fee_pct": 0.020, "cold_storage_capacity_tons": 3000},
    "routes": {"toll_cost_inr": 0.0, "road_condition_index": 0.85},
}


def natural_record_id() -> F.Column:
    """Stable id of a reading that came without one."""
    return F.md5(F.concat_ws("|", "container_id", iso_time(F.col("timestamp"))))


def apply_defaults(df: DataFrame, table: str, as_of: F.Column | None = None) -> DataFrame:
    """Fill the raw table's column defaults and conform to its declared types.

    ``as_of`` replaces the warehouse clock, so that a rerun gives the same rows.
    """
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in RAW_DEFAULTS[table].items()}
    if table == "sensor_telemetry":
        filled["record_id"] = F.coalesce(F.col("record_id"), natural_record_id())
        if as_of is not None:
            filled["ingestion_timestamp"] = F.coalesce("ingestion_timestamp", as_of)
    if table == "commodity_prices" and as_of is not None:
        filled["last_updated"] = F.coalesce("last_updated", as_of.cast("string"))
    df = df.withColumns(filled)
    columns = [part.strip().rsplit(" ", 1) for part in RAW_TABLES[table].split(", ")]
    return df.select([F.col(name).cast(kind).alias(name) for name, kind in columns])
