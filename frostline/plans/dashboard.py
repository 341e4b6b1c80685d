"""Dashboard queries over the marts: indicators, charts, datasets and dispatch lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions.numeric import round_positive, round_total
from frostline.plans.kinetics import AT_RISK
from frostline.plans.staging import FLAG_COLUMNS

RISK_ORDER = ["Critical Risk", "High Risk", "Moderate Risk", "Low Risk"]


def _rerouted(name: str) -> Column:
    return F.when(F.col("is_reroute_recommended"), F.col(name)).otherwise(0.0)


def _containers(condition: Column | None = None) -> Column:
    """Distinct containers, optionally only those meeting a condition."""
    counted = F.col("container_id")
    return F.countDistinct(counted if condition is None else F.when(condition, counted))


def _at_risk() -> Column:
    return F.col("risk_category").isin(*AT_RISK)


def _critical() -> Column:
    return F.col("risk_category") == "Critical Risk"


# Indicators


def active_containers(arbitrage: DataFrame) -> DataFrame:
    return arbitrage.agg(_containers().alias("total_active_containers"))


def containers_at_risk(arbitrage: DataFrame) -> DataFrame:
    return arbitrage.filter(_at_risk()).agg(_containers().alias("containers_at_risk"))


def critical_containers(arbitrage: DataFrame) -> DataFrame:
    return arbitrage.filter(_critical()).agg(_containers().alias("critical_containers"))


def average_temperature(readings: DataFrame) -> DataFrame:
    return readings.agg(round_total(F.avg("temperature_c"), 1).alias("avg_temperature_c"))


def average_humidity(readings: DataFrame) -> DataFrame:
    return readings.agg(round_total(F.avg("humidity_pct"), 1).alias("avg_humidity_pct"))


def total_arbitrage(arbitrage: DataFrame) -> DataFrame:
    return arbitrage.filter("is_reroute_recommended").agg(
        round_total(F.sum("spoilage_arbitrage_inr"), 0).alias("total_arbitrage_opportunity_inr")
    )


def total_loss_avoided(arbitrage: DataFrame) -> DataFrame:
    return arbitrage.filter("is_reroute_recommended").agg(
        round_total(F.sum("spoilage_avoided_value_inr"), 0).alias("total_loss_avoided_inr")
    )


def _container_climate(readings: DataFrame) -> DataFrame:
    """Readings reduced to one row per container; combines before the shuffle."""
    return readings.groupBy("container_id").agg(
        F.count("*").alias("n"),
        F.sum("temperature_c").alias("sum_t"),
        F.count("temperature_c").alias("n_t"),
        F.sum("humidity_pct").alias("sum_h"),
        F.count("humidity_pct").alias("n_h"),
    )


def _overview(joined: DataFrame, weight: Column) -> DataFrame:
    return joined.agg(
        _containers().alias("total_active_containers"),
        _containers(_at_risk()).alias("containers_at_risk"),
        _containers(_critical()).alias("critical_containers"),
        round_total(F.sum("sum_t") / F.sum("n_t"), 1).alias("fleet_avg_temp_c"),
        round_total(F.sum("sum_h") / F.sum("n_h"), 1).alias("fleet_avg_humidity_pct"),
        round_total(
            F.coalesce(F.sum(_rerouted("spoilage_arbitrage_inr") * weight), F.lit(0.0)), 0
        ).alias("total_arbitrage_opportunity_inr"),
        round_total(
            F.coalesce(F.sum(_rerouted("spoilage_avoided_value_inr") * weight), F.lit(0.0)), 0
        ).alias("total_loss_avoided_inr"),
    )


def executive_overview(arbitrage: DataFrame, readings: DataFrame) -> DataFrame:
    """One row of indicators as a join of mart and readings gives them.

    Such a join counts a container's money once per reading. Weighting by the number
    of readings gives the same totals without producing the joined rows.
    """
    joined = arbitrage.join(_container_climate(readings), "container_id", "left")
    return _overview(joined, F.coalesce("n", F.lit(1)))


def executive_overview_once(arbitrage: DataFrame, readings: DataFrame) -> DataFrame:
    """The same row with each container's money counted once."""
    joined = arbitrage.join(_container_climate(readings), "container_id", "left")
    return _overview(joined, F.lit(1))


# Charts


def fleet_map(arbitrage: DataFrame) -> DataFrame:
    return arbitrage.select(
        "container_id",
        "shipment_id",
        "commodity",
        "latitude",
        "longitude",
        "risk_category",
        "spoilage_risk_score",
        "time_to_spoilage_hours",
        "current_destination",
        "recommended_destination",
        "spoilage_arbitrage_inr",
        "is_reroute_recommended",
    )


def _trend(readings: DataFrame, measure: str, alert: str) -> DataFrame:
    columns = ["telemetry_timestamp", "container_id", "commodity", measure, alert]
    return (
        readings.select(*columns, "record_id")
        .orderBy(F.col("telemetry_timestamp").asc_nulls_last(), "record_id")
        .select(*columns)
    )


def temperature_trend(readings: DataFrame) -> DataFrame:
    return _trend(readings, "temperature_c", "is_temperature_alert")


def humidity_trend(readings: DataFrame) -> DataFrame:
    return _trend(readings, "humidity_pct", "is_humidity_alert")


def risk_leaderboard(arbitrage: DataFrame) -> DataFrame:
    return arbitrage.select(
        F.concat("container_id", F.lit(" ("), "commodity", F.lit(")")).alias("container_label"),
        "container_id",
        "commodity",
        "spoilage_risk_score",
        "risk_category",
        "time_to_spoilage_hours",
    ).orderBy(F.col("spoilage_risk_score").desc_nulls_last(), "container_id")


def opportunity_matrix(arbitrage: DataFrame) -> DataFrame:
    return arbitrage.select(
        F.col("container_id").alias("container"),
        F.col("commodity").alias("cargo"),
        F.col("risk_category").alias("risk_state"),
        F.col("time_to_spoilage_hours").alias("shelf_life_hrs"),
        F.col("current_destination").alias("current_dest"),
        F.col("current_expected_value_inr").alias("current_nrv"),
        F.col("recommended_destination").alias("recommended_dest"),
        F.col("reroute_expected_value_inr").alias("reroute_nrv"),
        F.col("spoilage_arbitrage_inr").alias("arbitrage_benefit"),
        F.col("recommendation_reason").alias("trader_recommendation"),
    ).orderBy(F.col("arbitrage_benefit").desc_nulls_last(), "container")


def revenue_comparison(arbitrage: DataFrame) -> DataFrame:
    return arbitrage.select(
        "container_id",
        "commodity",
        F.col("current_expected_value_inr").alias("current_planned_destination"),
        F.col("reroute_expected_value_inr").alias("alternative_rerouted_destination"),
        F.col("spoilage_arbitrage_inr").alias("net_arbitrage_uplift"),
    ).orderBy("container_id")


def corridor_bubbles(options: DataFrame) -> DataFrame:
    return options.select(
        "container_id",
        "commodity",
        F.col("candidate_market").alias("destination"),
        "distance_km",
        "estimated_transit_hours",
        round_positive(F.col("projected_spoilage_rate") * 100.0, 1).alias("projected_spoilage_pct"),
        "quantity_kg",
        "is_feasible_within_shelf_life",
    )


# Datasets


def fleet_dataset(arbitrage: DataFrame, markets: DataFrame) -> DataFrame:
    attributes = markets.select(
        F.col("market_name").alias("recommended_destination"),
        F.col("state").alias("destination_state"),
        F.col("tier").alias("destination_market_tier"),
        "cold_storage_capacity_tons",
    )
    return arbitrage.join(attributes, "recommended_destination", "left")


def alert_feed(readings: DataFrame) -> DataFrame:
    raised = F.lit(False)
    for name in FLAG_COLUMNS:
        raised = raised | (F.col(name) == 1)
    return (
        readings.filter(raised)
        .select(
            "record_id",
            "telemetry_timestamp",
            "container_id",
            "commodity",
            "origin",
            "destination",
            "temperature_c",
            "humidity_pct",
            "vibration_g",
            "compressor_status",
            "door_open",
            *FLAG_COLUMNS,
            "instant_risk_score",
            "instant_risk_category",
        )
        .orderBy(F.col("telemetry_timestamp").desc_nulls_last(), "record_id")
    )


def commodity_value_at_risk(arbitrage: DataFrame) -> DataFrame:
    return (
        arbitrage.groupBy("commodity")
        .agg(
            _containers().alias("total_containers"),
            F.sum("quantity_kg").alias("total_cargo_kg"),
            round_total(F.avg("spoilage_risk_score"), 1).alias("avg_spoilage_risk"),
            F.sum(F.when(_at_risk(), 1).otherwise(0)).alias("at_risk_container_count"),
            round_total(F.sum("current_expected_value_inr"), 0).alias("total_current_nrv_inr"),
            round_total(F.sum("current_potential_loss_inr"), 0).alias("total_potential_loss_inr"),
            round_total(F.sum(_rerouted("spoilage_arbitrage_inr")), 0).alias(
                "total_reroute_arbitrage_inr"
            ),
            round_total(F.sum(_rerouted("spoilage_avoided_value_inr")), 0).alias(
                "total_spoilage_prevented_inr"
            ),
        )
        .orderBy(F.col("total_potential_loss_inr").desc_nulls_last(), "commodity")
    )


def corridor_vulnerability(routes: DataFrame, readings: DataFrame) -> DataFrame:
    """Climate per corridor, empty corridors included.

    Readings are first reduced per corridor and container, so a busy corridor is
    never gathered row by row and the distinct count needs no second pass.
    """
    per_container = readings.groupBy("origin", "destination", "container_id").agg(
        F.sum("temperature_c").alias("sum_t"),
        F.count("temperature_c").alias("n_t"),
        F.sum("humidity_pct").alias("sum_h"),
        F.count("humidity_pct").alias("n_h"),
    )
    climate = per_container.groupBy("origin", "destination").agg(
        F.count("container_id").alias("active"),
        round_total(F.sum("sum_t") / F.sum("n_t"), 1).alias("avg_corridor_temp_c"),
        round_total(F.sum("sum_h") / F.sum("n_h"), 1).alias("avg_corridor_humidity_pct"),
    )
    return (
        routes.join(climate, ["origin", "destination"], "left")
        .select(
            "route_id",
            "origin",
            "destination",
            "distance_km",
            "estimated_transit_hours",
            "toll_cost_inr",
            "road_condition_index",
            F.coalesce("active", F.lit(0)).alias("active_shipments_in_corridor"),
            "avg_corridor_temp_c",
            "avg_corridor_humidity_pct",
        )
        .orderBy("distance_km", "route_id")
    )


# Dispatch


def dispatch_manifest(arbitrage: DataFrame, markets: DataFrame) -> DataFrame:
    target = markets.select(
        F.col("market_name").alias("recommended_destination"),
        F.col("latitude").alias("target_market_lat"),
        F.col("longitude").alias("target_market_lon"),
        F.col("state").alias("target_state"),
        F.col("tier").alias("target_tier"),
    )
    return (
        arbitrage.filter("is_reroute_recommended")
        .join(target, "recommended_destination")
        .orderBy(F.col("spoilage_arbitrage_inr").desc_nulls_last(), "container_id")
        .select(
            "container_id",
            "shipment_id",
            "commodity",
            "quantity_kg",
            F.col("latitude").alias("current_latitude"),
            F.col("longitude").alias("current_longitude"),
            "current_destination",
            "recommended_destination",
            "target_market_lat",
            "target_market_lon",
            "target_state",
            "target_tier",
            "reroute_distance_km",
            "reroute_transit_hours",
            F.col("time_to_spoilage_hours").alias("remaining_shelf_life_hours"),
            round_positive(F.col("spoilage_arbitrage_inr"), 0).alias("net_arbitrage_profit_inr"),
            "recommendation_reason",
        )
    )


def audit_trail(readings: DataFrame, container_id: str | None = None) -> DataFrame:
    """History of every container, or of one."""
    if container_id is not None:
        readings = readings.filter(F.col("container_id") == container_id)
    return readings.select(
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
        "speed_kmh",
        "door_open",
        "compressor_status",
        "anomaly_mode",
        "instant_risk_score",
        "instant_risk_category",
    ).orderBy("container_id", F.col("telemetry_timestamp").asc_nulls_last(), "record_id")
