"""What-if evaluation: what a reading would mean, and what a diversion would bring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions.numeric import all_present, clamp, least_strict, round_positive
from frostline.plans.rolling import exact_hours_left, risk_level, with_specs

# Hours of the planned route, speed and costs of a diversion, price premium
PLANNED_HOURS = 8.5
DIVERSION_KMH = 50.0
COST_PER_KM = 35.0
FIXED_COST = 600.0
PREMIUM = 1.03

# Sweep: degrees added to each container's temperature, and diversion distances in km
TEMPERATURE_STEPS = [-4.0, -2.0, 0.0, 2.0, 4.0]
DISTANCES = [float(km) for km in range(50, 601, 50)]


def rounded(df: DataFrame, values: dict[str, Column], places: int) -> DataFrame:
    """Add columns rounded to ``places``.

    Each value is a column of its own before it is rounded: rounding names its argument several times, and stacked
    roundings would multiply in the plan.
    """
    exact = df.withColumns({f"_{name}": value for name, value in values.items()})
    return exact.withColumns({name: round_positive(F.col(f"_{name}"), places) for name in values}).drop(*[f"_{name}" for name in values])


def judged(cargo: DataFrame) -> DataFrame:
    """Add profile, score, level and hours left to (commodity, temperature, humidity, vibration, alerts, quantity)."""
    optimum, critical = F.col("temp_opt"), F.col("temp_critical")
    measures = all_present(*[F.col(c) for c in ("temperature_c", "humidity_pct", "vibration_g", "alerts")])
    # An unknown measure makes the score unknown, and with it all that follows.
    total = F.when(
        measures,
        clamp((F.col("temperature_c") - optimum) / (critical - optimum) * 45.0, 0.0, 45.0)
        + clamp(F.abs(F.col("humidity_pct") - 90.0) / 20.0 * 20.0, 0.0, 20.0)
        + clamp((F.col("vibration_g") - 0.10) / 0.35 * 15.0, 0.0, 15.0)
        + F.least(F.lit(20.0), F.col("alerts") * 4.0),
    )
    capped = F.when(total.isNotNull(), clamp(total, 0.0, 100.0))
    scored = rounded(with_specs(cargo), {"score": capped}, 1).withColumn("level", risk_level(F.col("score")))
    return rounded(scored, {"shelf_hours_left": exact_hours_left(F.col("shelf_hours"), F.col("score"))}, 1)


def diverted(cases: DataFrame) -> DataFrame:
    """Add what staying and a diversion of ``km`` would bring to judged cargo, and the directive."""
    score, left = F.col("score"), F.col("shelf_hours_left")
    reach, kg, price = F.col("diversion_hours"), F.col("quantity_kg"), F.col("typical_price")

    def late(on_time: Column) -> Column:
        return F.when(PLANNED_HOURS > left, 0.80).otherwise(on_time)

    stay_rate = F.when(score.isNotNull(), late(least_strict(F.lit(0.70), (score / 100.0) * 0.40)))
    divert_rate = F.when(
        left.isNotNull(), F.when(reach > left, 0.85).when(reach <= left * 0.5, 0.10).otherwise(0.25)
    )
    costed = rounded(cases, {"diversion_cost": F.col("km") * COST_PER_KM + FIXED_COST, "premium_price": price * PREMIUM}, 0)
    reached = rounded(costed, {"diversion_hours": F.col("km") / DIVERSION_KMH}, 1)
    valued = rounded(
        reached.withColumn("diversion_hours", F.greatest(F.lit(1.0), "diversion_hours")),
        {"stay_value": kg * price * (1.0 - stay_rate), "divert_value": kg * F.col("premium_price") * (1.0 - divert_rate)},
        0,
    )
    # Its parts are whole already.
    gain = F.col("divert_value") - F.col("diversion_cost") - F.col("stay_value")
    return valued.withColumn("net_gain", gain + 0.0).withColumn(
        "directive",
        F.when((F.col("net_gain") > 0) & F.coalesce(reach <= left, F.lit(False)) & (score >= 50.0), "EXECUTE_REROUTE")
        .when(F.col("net_gain") > 0, "OPPORTUNITY_IDENTIFIED")
        .otherwise("MAINTAIN_ROUTE"),
    )


_ANSWERS = [
    "score",
    "level",
    "shelf_hours_left",
    "diversion_hours",
    "stay_value",
    "divert_value",
    "diversion_cost",
    "net_gain",
    "directive",
]


def what_if(cases: DataFrame) -> DataFrame:
    """Evaluate (commodity, temperature, humidity, vibration, alerts, km, quantity) cases."""
    return diverted(judged(cases)).select(*cases.columns, *_ANSWERS)


def scenario_sweep(features: DataFrame) -> DataFrame:
    """What-if over a grid of warmer or colder cargo and diversion distances per container.

    Cargo is judged once for each temperature, before the distances multiply it.
    """
    cargo = features.withColumn("step", F.explode(F.array(*[F.lit(s) for s in TEMPERATURE_STEPS]))).select(
        "container_id",
        "commodity",
        "quantity_kg",
        (F.col("temperature_c") + F.col("step")).alias("temperature_c"),
        "humidity_pct",
        "vibration_g",
        F.col("anomaly_count").alias("alerts"),
    )
    cases = judged(cargo).withColumn("km", F.explode(F.array(*[F.lit(d) for d in DISTANCES])))
    return diverted(cases).select(*cargo.columns, "km", *_ANSWERS)
