"""Kinetic risk model: latest state per container, penalties, score and shelf life."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions.numeric import all_present, clamp, round_positive
from frostline.operators.latest import newest_per_container
from frostline.plans.staging import FLAG_COLUMNS, STAGED_COLUMNS
from frostline.sources import reference as ref

AT_RISK = ("High Risk", "Critical Risk")

ENVELOPE_COLUMNS = [
    "optimal_temp_center",
    "optimal_temp_max",
    "optimal_temp_min",
    "baseline_shelf_life_hours",
]


def compressor_penalty() -> Column:
    status = F.col("compressor_status")
    return F.when(status == "FAILURE", 25.0).when(status == "DEGRADED", 12.0).otherwise(0.0)


def risk_band(score: Column) -> Column:
    """Risk category; an unknown score counts as critical."""
    return (
        F.when(score <= 25.0, "Low Risk")
        .when(score <= 50.0, "Moderate Risk")
        .when(score <= 75.0, "High Risk")
        .otherwise("Critical Risk")
    )


def shelf_life_left(shelf: Column, score: Column) -> Column:
    left = F.greatest(F.lit(0.01), 1.0 - score / 100.0)
    hours = F.greatest(F.lit(1.0), shelf * F.pow(left, F.lit(1.85)))
    return F.when(score.isNotNull(), round_positive(hours, 1))


def container_health(
    staged: DataFrame, envelopes: DataFrame | None = None, one_each: bool = False
) -> DataFrame:
    """Latest reading of each container with its commodity's envelope and excursion.

    ``one_each`` says that ``staged`` holds the latest readings only.
    """
    low, high, centre, shelf = ref.DEFAULT_ENVELOPE
    defaults = dict(zip(ENVELOPE_COLUMNS, (centre, high, low, shelf)))
    temperature = F.col("temperature_c")
    rows = staged.select(*STAGED_COLUMNS, *FLAG_COLUMNS)
    return (
        (rows if one_each else newest_per_container(rows))
        .join(envelopes or ref.envelopes(staged.sparkSession), "commodity", "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
        .withColumn(
            "temp_excursion_c",
            F.when(
                temperature.isNotNull(),
                F.greatest(
                    F.lit(0.0),
                    temperature - F.col("optimal_temp_max"),
                    F.col("optimal_temp_min") - temperature,
                ),
            ),
        )
        .select(*STAGED_COLUMNS, *FLAG_COLUMNS, *ENVELOPE_COLUMNS, "temp_excursion_c")
    )


def spoilage_risk(health: DataFrame) -> DataFrame:
    """Risk score 0..100, its category and the hours of shelf life left."""
    scored = health.withColumns(
        {
            "penalty_temp": F.least(F.lit(50.0), F.col("temp_excursion_c") * 8.5),
            "penalty_humidity": F.when(F.col("is_humidity_alert") == 1, 20.0).otherwise(0.0),
            "penalty_vibration": clamp((F.col("vibration_g") - 0.15) * 60.0, 0.0, 20.0),
            "penalty_compressor": compressor_penalty(),
        }
    ).withColumn(
        "raw_score",
        F.when(
            all_present(F.col("temp_excursion_c"), F.col("vibration_g")),
            clamp(
                F.col("penalty_temp")
                + F.col("penalty_humidity")
                + F.col("penalty_vibration")
                + F.col("penalty_compressor"),
                0.0,
                100.0,
            ),
        ),
    )
    kept = [c for c in STAGED_COLUMNS if c != "door_open"]
    return scored.select(
        *kept,
        "baseline_shelf_life_hours",
        "temp_excursion_c",
        round_positive(F.col("raw_score"), 1).alias("spoilage_risk_score"),
        risk_band(F.col("raw_score")).alias("risk_category"),
        shelf_life_left(F.col("baseline_shelf_life_hours"), F.col("raw_score")).alias(
            "time_to_spoilage_hours"
        ),
    )
