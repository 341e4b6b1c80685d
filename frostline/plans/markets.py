"""What each container would earn at each market it could go to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions.numeric import flag, greatest_strict, least_strict, round_half_up, round_positive

KM_PER_DEGREE = 111.0
PI_DIGITS = 3.14159265359
FREIGHT_PER_KM_KG = 0.015


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Equirectangular distance."""
    north = lat2 - lat1
    east = (lon2 - lon1) * F.cos(lat1 * F.lit(PI_DIGITS) / 180.0)
    return round_positive(KM_PER_DEGREE * F.sqrt(F.pow(north, F.lit(2)) + F.pow(east, F.lit(2))), 1)


def market_offers(markets: DataFrame, prices: DataFrame) -> DataFrame:
    """Markets with a price, one row per commodity: what a container can be matched with."""
    return markets.join(prices, markets["market_name"] == prices["market"]).select(
        "commodity",
        F.col("market_id").alias("candidate_market_id"),
        F.col("market_name").alias("candidate_market"),
        F.col("latitude").alias("candidate_lat"),
        F.col("longitude").alias("candidate_lon"),
        F.col("tier").alias("market_tier"),
        F.col("price_per_kg").alias("candidate_price_per_kg"),
    )


def market_options(risk: DataFrame, markets: DataFrame, prices: DataFrame) -> DataFrame:
    """Every priced market of each container's commodity but the one it came from.

    Matching on the commodity replaces the product of containers and markets. The
    offers are few, so Spark broadcasts them and keeps the containers' partitioning.
    """
    containers = risk.select(
        "container_id",
        "shipment_id",
        "commodity",
        "origin",
        F.col("destination").alias("current_destination"),
        "quantity_kg",
        F.col("latitude").alias("current_lat"),
        F.col("longitude").alias("current_lon"),
        "speed_kmh",
        "spoilage_risk_score",
        "risk_category",
        "time_to_spoilage_hours",
    )
    paired = containers.join(market_offers(markets, prices), "commodity").filter(
        F.col("candidate_market") != F.col("origin")
    )
    hours, left = F.col("estimated_transit_hours"), F.col("time_to_spoilage_hours")
    kg, price = F.col("quantity_kg"), F.col("candidate_price_per_kg")
    late_rate = least_strict(F.lit(1.0), 0.35 + (0.65 * (hours - left) / hours))
    value = kg * price * (1.0 - F.col("projected_spoilage_rate"))
    return (
        paired.withColumn(
            "distance_km",
            distance_km(
                F.col("current_lat"),
                F.col("current_lon"),
                F.col("candidate_lat"),
                F.col("candidate_lon"),
            ),
        )
        .withColumns(
            {
                "estimated_transit_hours": round_positive(
                    greatest_strict(
                        F.lit(0.5),
                        F.col("distance_km") / greatest_strict(F.lit(25.0), F.col("speed_kmh")),
                    ),
                    1,
                ),
                "estimated_freight_cost_inr": round_positive(
                    F.col("distance_km") * FREIGHT_PER_KM_KG * kg, 2
                ),
            }
        )
        .withColumns(
            {
                "projected_spoilage_rate": F.when(hours >= left, late_rate).otherwise(
                    round_positive((F.col("spoilage_risk_score") / 100.0) * 0.15, 3)
                ),
                "is_feasible_within_shelf_life": flag(hours < left),
            }
        )
        .withColumns(
            {
                "projected_gross_value_inr": round_positive(value, 2),
                "net_realizable_value_inr": round_half_up(
                    value - F.col("estimated_freight_cost_inr"), 2
                ),
            }
        )
    )
