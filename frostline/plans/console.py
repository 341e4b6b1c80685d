"""Fleet console: records, history series, indicators and the document parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostline.functions import documents as doc
from frostline.functions.numeric import round_half_up, round_positive, round_total
from frostline.operators.latest import newest_per_container
from frostline.plans.rolling import (
    ALARM_LEVELS,
    best_market,
    best_or_zero,
    rolling_decision,
)
from frostline.sources import reference as ref

HISTORY_ROWS = 30
REROUTED_MARK = " (Rerouted)"


def console_state(readings: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    return rolling_decision(readings, ref.CONSOLE_DESK, overrides)


def fleet_records(state: DataFrame) -> DataFrame:
    marked = F.concat(best_market(), F.lit(REROUTED_MARK))
    return state.select(
        "container_id",
        "shipment_id",
        "commodity",
        "origin",
        F.when(F.col("is_rerouted"), marked).otherwise(F.col("destination")).alias("destination"),
        "quantity_kg",
        "temperature_c",
        "humidity_pct",
        "vibration_g",
        "latitude",
        "longitude",
        round_half_up(F.col("avg_temp"), 2).alias("rolling_avg_temp"),
        round_half_up(F.col("avg_hum"), 2).alias("rolling_avg_hum"),
        *[
            round_positive(F.col(c), 1).alias(c)
            for c in ("temp_penalty", "hum_penalty", "vib_penalty", "exp_penalty")
        ],
        "spoilage_risk_score",
        "risk_level",
        "time_to_spoilage_hours",
        "action",
        "is_rerouted",
        F.col("temp_min").alias("min_safe_temp"),
        F.col("temp_max").alias("max_safe_temp"),
        F.col("humidity_min").alias("min_safe_hum"),
        F.col("humidity_max").alias("max_safe_hum"),
    )


def planned_market(destination: str = "destination") -> F.Column:
    """Name of a destination without the reroute mark."""
    return F.regexp_replace(destination, r" \(Rerouted\)$", "")


def arbitrage_records(state: DataFrame) -> DataFrame:
    return state.select(
        "container_id",
        "commodity",
        "quantity_kg",
        F.when(F.col("is_rerouted"), best_market())
        .otherwise(F.col("destination"))
        .alias("current_destination"),
        F.col("current_expected_value").alias("status_quo_value"),
        "potential_loss",
        best_market().alias("recommended_market"),
        best_or_zero("price").alias("recommended_price"),
        best_or_zero("hours").alias("reroute_transit_hours"),
        best_or_zero("value").alias("reroute_expected_value"),
        best_or_zero("cost").alias("diversion_cost"),
        best_or_zero("avoided").alias("spoilage_loss_avoided"),
        best_or_zero("net").alias("net_arbitrage_inr"),
        F.coalesce("best.viable", F.lit(False)).alias("is_viable"),
        F.col("action").alias("directive"),
    )


def console_table(arbitrage: DataFrame, fleet: DataFrame) -> DataFrame:
    """Arbitrage records with the fleet's score and level; absent containers count as low."""
    seen = fleet.select(
        "container_id", "spoilage_risk_score", F.col("risk_level").alias("fleet_level")
    )
    return (
        arbitrage.join(seen, "container_id", "left")
        .withColumn("risk_level", F.coalesce("fleet_level", F.lit("Low")))
        .drop("fleet_level")
    )


def reroute_status(state: DataFrame) -> DataFrame:
    fleet = fleet_records(state)
    return fleet.select(
        "container_id",
        "is_rerouted",
        "action",
        "destination",
        planned_market().alias("destination_market"),
    )


def console_kpis(state: DataFrame) -> DataFrame:
    alarm = F.col("risk_level").isin(*ALARM_LEVELS)
    critical = F.col("risk_level") == "Critical"

    def gains(field: str):
        value = best_or_zero(field)
        total = F.sum(F.when(value > 0, value).otherwise(0.0))
        return round_total(F.coalesce(total, F.lit(0.0)), 2)

    def average(column: str):
        return round_total(F.coalesce(F.avg(column), F.lit(0.0)), 1)

    return state.agg(
        F.count("*").alias("total_containers"),
        F.coalesce(F.sum(F.when(alarm, 1).otherwise(0)), F.lit(0)).alias("at_risk_count"),
        F.coalesce(F.sum(F.when(critical, 1).otherwise(0)), F.lit(0)).alias("critical_count"),
        average("temperature_c").alias("average_temp_c"),
        average("humidity_pct").alias("average_humidity_pct"),
        gains("net").alias("total_potential_arbitrage_inr"),
        gains("avoided").alias("total_loss_avoided_inr"),
    )


def history_series(readings: DataFrame) -> DataFrame:
    """The last readings of each container, numbered, with labels aligned at the newest."""
    last = newest_per_container(
        readings.select(
            "container_id",
            "telemetry_timestamp",
            "record_id",
            "temperature_c",
            "humidity_pct",
            "vibration_g",
        ),
        HISTORY_ROWS,
        rank="_back",
    )
    # Counting needs no sort, so the longest series is cheaper to find this way.
    counts = readings.groupBy("container_id").count()
    longest = counts.agg(F.least(F.max("count"), F.lit(HISTORY_ROWS))).scalar()
    length = F.max("_back").over(Window.partitionBy("container_id"))
    return (
        last.withColumn("step", length - F.col("_back") + 1)
        .select(
            "container_id",
            "step",
            F.concat(F.lit("T-"), (longest - F.col("step")).cast("string"), F.lit("m")).alias("label"),
            F.col("temperature_c").alias("temp"),
            F.col("humidity_pct").alias("hum"),
            F.col("vibration_g").alias("vib"),
            doc.time_of_day(F.col("telemetry_timestamp")).alias("time"),
        )
    )


def _numbers(places: dict[str, int]) -> dict:
    return {c: doc.number(F.col(c), n) for c, n in places.items()}


def _texts(*columns: str) -> dict:
    return {c: F.col(c) for c in columns}


def _part(df: DataFrame, section: str, key, fields: dict) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        key.cast("string").alias("entry"),
        doc.json_object(fields).alias("body"),
    )


def console_document(state: DataFrame, history: DataFrame) -> DataFrame:
    """The console document as one row per entry.

    A document in one value would gather the fleet in one task. Here each container,
    its history of at most thirty rows, each market and the indicators are entries.
    """
    fleet, arbitrage, kpis = fleet_records(state), arbitrage_records(state), console_kpis(state)
    points = F.array_sort(
        F.collect_list(
            F.struct(
                "step",
                *[
                    doc.number(F.col(c), n).alias(c)
                    for c, n in (("temp", 2), ("hum", 2), ("vib", 3))
                ],
                "time",
            )
        )
    )
    history = history.groupBy("container_id").agg(points.alias("points"))
    name = F.col("container_id")
    parts = [
        _part(
            kpis,
            "kpis",
            F.lit("kpis"),
            _texts("total_containers", "at_risk_count", "critical_count")
            | _numbers(
                {
                    "average_temp_c": 1,
                    "average_humidity_pct": 1,
                    "total_potential_arbitrage_inr": 2,
                    "total_loss_avoided_inr": 2,
                }
            ),
        ),
        _part(
            fleet,
            "fleet",
            name,
            _texts("container_id", "shipment_id", "commodity", "origin", "destination")
            | _texts("quantity_kg")
            | _numbers(
                {
                    "temperature_c": 2,
                    "humidity_pct": 2,
                    "vibration_g": 3,
                    "latitude": 4,
                    "longitude": 4,
                    "rolling_avg_temp": 2,
                    "rolling_avg_hum": 2,
                    "temp_penalty": 1,
                    "hum_penalty": 1,
                    "vib_penalty": 1,
                    "exp_penalty": 1,
                    "spoilage_risk_score": 1,
                }
            )
            | _texts("risk_level")
            | _numbers({"time_to_spoilage_hours": 1})
            | _texts("action", "is_rerouted")
            | _numbers(
                {"min_safe_temp": 1, "max_safe_temp": 1, "min_safe_hum": 1, "max_safe_hum": 1}
            ),
        ),
        _part(
            arbitrage,
            "arbitrage",
            name,
            _texts("container_id", "commodity", "quantity_kg", "current_destination")
            | _numbers({"status_quo_value": 2, "potential_loss": 2})
            | _texts("recommended_market")
            | _numbers(
                {
                    "recommended_price": 2,
                    "reroute_transit_hours": 1,
                    "reroute_expected_value": 2,
                    "diversion_cost": 2,
                    "spoilage_loss_avoided": 2,
                    "net_arbitrage_inr": 2,
                }
            )
            | _texts("is_viable", "directive"),
        ),
        history.select(
            F.lit("history").alias("section"),
            name.alias("entry"),
            F.to_json("points", {"ignoreNullFields": "false"}).alias("body"),
        ),
        _part(
            ref.console_markets(state.sparkSession),
            "markets",
            F.col("market_name"),
            {
                "lat": doc.number(F.col("latitude"), 4),
                "lon": doc.number(F.col("longitude"), 4),
                "state": F.col("state"),
            },
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
