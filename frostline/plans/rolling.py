"""Rolling risk model: trailing means, recent anomalies, score and reroute decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.functions.numeric import all_present, clamp, least_strict, round_half_up, round_positive
from frostline.operators.lags import ROWS_PER_CHUNK, with_previous
from frostline.operators.latest import newest_first, newest_per_container
from frostline.plans.staging import STAGED_COLUMNS
from frostline.sources import reference as ref

MEAN_ROWS = 3
ANOMALY_ROWS = 5
CRITICAL_SCORE = 75.0
ALARM_LEVELS = ("High", "Critical")

SENSORS = ["temperature_c", "humidity_pct", "vibration_g"]
SPEC_NAMES = [c.strip() for c in ref.SPEC_COLUMNS.split(",")]


def with_specs(df: DataFrame, commodity: str = "commodity", prefix: str = "") -> DataFrame:
    """Join the commodity profiles; an unknown commodity takes the fallback profile."""
    table = ref.specs_with_fallback(df.sparkSession)
    known = F.when(F.col(commodity).isin(*ref.COMMODITIES), F.col(commodity))
    table = table.select(
        F.col("commodity").alias(f"{prefix}spec_key"),
        *[F.col(c).alias(f"{prefix}{c}") for c in SPEC_NAMES],
    )
    return df.withColumn(f"{prefix}spec_key", F.coalesce(known, F.lit(ref.UNKNOWN))).join(
        table, f"{prefix}spec_key"
    )


def _mean(values: list[str]) -> str:
    """Mean of the values present, summed oldest first."""
    total = " + ".join(f"coalesce({v}, 0d)" for v in values)
    present = " + ".join(f"int({v} IS NOT NULL)" for v in values)
    return f"({total}) / nullif({present}, 0)"


def window_of(rows: list[str], prefix: str = "") -> dict[str, Column]:
    """Features of a reading from its row and those before it, newest first."""
    recent = list(reversed(rows[:MEAN_ROWS]))
    anomalies = [
        f"CASE WHEN {r}.temperature_c > {prefix}temp_max OR {r}.temperature_c < {prefix}temp_min"
        f" OR {r}.humidity_pct > {prefix}humidity_max OR {r}.vibration_g > {prefix}vibration_max"
        " THEN 1 ELSE 0 END"
        for r in rows[:ANOMALY_ROWS]
    ]
    return {
        f"{prefix}avg_temp": F.expr(_mean([f"{r}.temperature_c" for r in recent])),
        f"{prefix}avg_hum": F.expr(_mean([f"{r}.humidity_pct" for r in recent])),
        f"{prefix}anomaly_count": F.expr(" + ".join(anomalies)),
    }


def penalties(vibration: str = "vibration_g", prefix: str = "") -> dict[str, Column]:
    """The four terms of the score. They are NULL-safe only under ``rolling_score``."""
    heat = f"({prefix}avg_temp - {prefix}temp_opt) / ({prefix}temp_critical - {prefix}temp_opt)"
    terms = {
        "temp": f"least(45d, greatest(0d, {heat} * 45d))",
        "hum": f"least(20d, greatest(0d, abs({prefix}avg_hum - 90d) / 20d * 20d))",
        "vib": f"least(15d, greatest(0d, ({vibration} - 0.10d) / 0.35d * 15d))",
        "exp": f"least(20d, {prefix}anomaly_count * 4d)",
    }
    return {f"{prefix}{name}_penalty": F.expr(term) for name, term in terms.items()}


def rolling_score(vibration: str = "vibration_g", prefix: str = "") -> Column:
    measured = all_present(*[F.col(c) for c in (f"{prefix}avg_temp", f"{prefix}avg_hum", vibration)])
    total = F.expr(" + ".join(f"{prefix}{name}_penalty" for name in ("temp", "hum", "vib", "exp")))
    return F.when(measured, round_positive(clamp(total, 0.0, 100.0), 1))


def risk_level(score: Column) -> Column:
    return (
        F.when(score >= CRITICAL_SCORE, "Critical")
        .when(score >= 50.0, "High")
        .when(score >= 25.0, "Moderate")
        .when(score.isNotNull(), "Low")
    )


def exact_hours_left(shelf: Column, score: Column) -> Column:
    left = F.greatest(F.lit(0.05), 1.0 - score / 100.0)
    return F.when(score.isNotNull(), F.greatest(F.lit(1.0), shelf * F.pow(left, F.lit(1.6))))


def hours_left(shelf: Column, score: Column) -> Column:
    return round_positive(exact_hours_left(shelf, score), 1)


def _this_row() -> Column:
    return F.struct(*SENSORS)


def add_features(df: DataFrame) -> DataFrame:
    """Features of readings that carry the readings before them."""
    df = df.withColumn("_now", _this_row())
    window = ["_now", *[f"previous_{i}" for i in range(1, ANOMALY_ROWS)]]
    return with_specs(df).withColumns(window_of(window)).drop("_now")


def rolling_features(
    readings: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK, extra: int = 0
) -> DataFrame:
    """Trailing means and anomaly count at every reading."""
    lagged = with_previous(
        readings.select(*STAGED_COLUMNS),
        "container_id",
        ["telemetry_timestamp", "record_id"],
        [*SENSORS, "commodity"],
        ANOMALY_ROWS - 1 + extra,
        rows_per_chunk,
    )
    return add_features(lagged)


def latest_features(readings: DataFrame) -> DataFrame:
    """The same at each container's newest reading only, from its last five rows."""
    last = newest_per_container(readings.select(*STAGED_COLUMNS), ANOMALY_ROWS, rank="_rank")
    older = Window.partitionBy("container_id").orderBy(*newest_first())
    lagged = last.withColumns(
        {f"previous_{i}": F.lead(_this_row(), i).over(older) for i in range(1, ANOMALY_ROWS)}
    )
    older_rows = [f"previous_{i}" for i in range(1, ANOMALY_ROWS)]
    return add_features(lagged.filter(F.col("_rank") == 1)).drop("_rank", *older_rows)


def with_risk(features: DataFrame) -> DataFrame:
    """Add the four penalties, the score, its level and the hours left."""
    return (
        features.withColumns(penalties())
        .withColumn("spoilage_risk_score", rolling_score())
        .withColumns(
            {
                "risk_level": risk_level(F.col("spoilage_risk_score")),
                "time_to_spoilage_hours": hours_left(
                    F.col("shelf_hours"), F.col("spoilage_risk_score")
                ),
            }
        )
    )


def feature_columns(features: DataFrame) -> DataFrame:
    return features.select(
        "record_id",
        "container_id",
        "telemetry_timestamp",
        "commodity",
        round_half_up(F.col("avg_temp"), 2).alias("rolling_avg_temp"),
        round_half_up(F.col("avg_hum"), 2).alias("rolling_avg_hum"),
        "anomaly_count",
    )


def risk_columns(scored: DataFrame) -> DataFrame:
    return scored.select(
        "record_id",
        "container_id",
        "telemetry_timestamp",
        *[
            round_positive(F.col(c), 1).alias(c)
            for c in ("temp_penalty", "hum_penalty", "vib_penalty", "exp_penalty")
        ],
        "spoilage_risk_score",
        "risk_level",
        "time_to_spoilage_hours",
    )


def with_previous_score(features: DataFrame) -> DataFrame:
    """Add the score of the reading before, scored with that reading's own profile."""
    before = [f"previous_{i}" for i in range(1, ANOMALY_ROWS + 1)]
    known = features.withColumn("_old_commodity", F.col("previous_1.commodity"))
    return (
        with_specs(known, "_old_commodity", "old_")
        .withColumns(window_of(before, "old_"))
        .withColumns(penalties("previous_1.vibration_g", "old_"))
        .withColumn("previous_score", rolling_score("previous_1.vibration_g", "old_"))
    )


def transitions(scored: DataFrame) -> DataFrame:
    """Readings at which a container becomes critical."""
    before = F.col("previous_score")
    turned = (F.col("spoilage_risk_score") >= CRITICAL_SCORE) & (
        F.coalesce(before, F.lit(0.0)) < CRITICAL_SCORE
    )
    return scored.filter(turned).select(
        "record_id",
        "container_id",
        "telemetry_timestamp",
        "commodity",
        "latitude",
        "longitude",
        F.coalesce(risk_level(before), F.lit("none")).alias("previous_level"),
        "risk_level",
        "spoilage_risk_score",
    )


def risk_transitions(readings: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    features = rolling_features(readings, rows_per_chunk, extra=1)
    return transitions(with_previous_score(with_risk(features)))


def decide(state: DataFrame, desk: ref.Desk, overrides: DataFrame | None = None) -> DataFrame:
    """Value of staying and of the best diversion for each container.

    ``state`` has one row per container with score, level and hours left. ``overrides``
    lists containers whose reroute was authorised already.
    """
    spark = state.sparkSession
    planned = state.withColumn("current_destination", F.col("destination"))
    prices = ref.desk_prices(spark, desk).withColumnRenamed("market", "current_destination")
    routes = ref.scheduled_routes(spark).withColumnRenamed("destination", "current_destination")
    score, left = F.col("spoilage_risk_score"), F.col("time_to_spoilage_hours")
    hours, kg = F.col("current_transit_hours"), F.col("quantity_kg")
    # An unknown score leaves the loss unknown, and the container on its route.
    loss_rate = F.when(
        score.isNotNull(),
        F.when(hours > left, 0.80).otherwise(least_strict(F.lit(0.70), (score / 100.0) * 0.40)),
    )
    if "current_transit_hours" not in state.columns:
        planned = planned.join(routes, ["origin", "current_destination"], "left").withColumn(
            "current_transit_hours", F.coalesce("scheduled_hours", F.lit(desk.default_hours))
        )
    planned = (
        planned.join(prices, ["current_destination", "commodity"], "left")
        .withColumn("current_price", F.coalesce("price", "typical_price"))
        .withColumn("_loss_rate", loss_rate)
        .withColumns(
            {
                "current_expected_value": round_positive(
                    kg * F.col("current_price") * (1.0 - F.col("_loss_rate")), 2
                ),
                "potential_loss": round_positive(
                    kg * F.col("current_price") * F.col("_loss_rate"), 2
                ),
            }
        )
        .drop("price", "_loss_rate", "scheduled_km", "scheduled_hours", "scheduled_toll")
    )
    options = ref.candidates(spark, desk).withColumnRenamed("commodity", "spec_key")
    reach, price = F.col("candidate_hours"), F.col("candidate_price")
    candidate_rate = F.when(
        left.isNotNull(), F.when(reach > left, 0.85).when(reach <= left * 0.5, 0.10).otherwise(0.25)
    )
    evaluated = (
        planned.join(options, "spec_key")
        .withColumns(
            {
                "_rate": candidate_rate,
                "_cost": round_positive(F.col("candidate_km") * 35.0 + F.col("candidate_toll"), 2),
            }
        )
        .withColumn("_value", round_positive(kg * price * (1.0 - F.col("_rate")), 2))
        .withColumns(
            {
                "_net": round_half_up(
                    (F.col("_value") - F.col("_cost")) - F.col("current_expected_value"), 2
                ),
                "_avoided": round_half_up(
                    F.col("potential_loss") - (kg * price * F.col("_rate")), 2
                ),
                "_viable": reach <= left,
            }
        )
    )
    allowed = (F.col("candidate_market") != F.col("origin")) & (
        F.col("candidate_market") != F.col("current_destination")
    )
    preference = F.struct(~F.col("_viable"), -F.col("_net"), F.col("candidate_rank"))
    option = F.struct(
        F.col("candidate_market").alias("market"),
        F.col("candidate_price").alias("price"),
        F.col("candidate_hours").alias("hours"),
        F.col("_viable").alias("viable"),
        F.col("_cost").alias("cost"),
        F.col("_value").alias("value"),
        F.col("_avoided").alias("avoided"),
        F.col("_net").alias("net"),
    )
    own = [c for c in planned.columns if c != "container_id"]
    best = (
        evaluated.groupBy("container_id")
        .agg(
            F.first(F.struct(*own)).alias("own"),
            F.min_by(F.when(allowed, option), F.when(allowed, preference)).alias("best"),
        )
        .select("container_id", "own.*", "best")
    )
    if overrides is None:
        best = best.withColumn("is_rerouted", F.lit(False))
    else:
        marks = overrides.select("container_id").distinct().withColumn("_mark", F.lit(True))
        best = (
            best.join(marks, "container_id", "left")
            .withColumn("is_rerouted", F.col("_mark").isNotNull())
            .drop("_mark")
        )
    gain = F.coalesce(F.col("best.net") > 0, F.lit(False))
    alarm = F.col("risk_level").isin(*ALARM_LEVELS)
    return best.withColumn(
        "action",
        F.when(F.col("is_rerouted"), "REROUTED")
        .when(gain & F.col("best.viable") & alarm, "EXECUTE_REROUTE")
        .when(gain, "OPPORTUNITY_IDENTIFIED")
        .otherwise(desk.stay_label),
    )


def best_or_zero(field: str) -> Column:
    return F.coalesce(F.col(f"best.{field}"), F.lit(0.0))


def best_market() -> Column:
    return F.coalesce("best.market", F.lit("N/A"))


def decision_columns(decided: DataFrame) -> DataFrame:
    return decided.select(
        "container_id",
        "shipment_id",
        "commodity",
        "quantity_kg",
        "temperature_c",
        "humidity_pct",
        "vibration_g",
        "latitude",
        "longitude",
        round_half_up(F.col("avg_temp"), 2).alias("rolling_avg_temp"),
        "spoilage_risk_score",
        "risk_level",
        "time_to_spoilage_hours",
        "current_destination",
        "current_transit_hours",
        "current_price",
        "current_expected_value",
        "potential_loss",
        best_market().alias("recommended_destination"),
        best_or_zero("price").alias("recommended_price"),
        best_or_zero("hours").alias("recommended_transit_hours"),
        best_or_zero("cost").alias("reroute_cost"),
        best_or_zero("value").alias("reroute_expected_value"),
        best_or_zero("avoided").alias("spoilage_avoided"),
        best_or_zero("net").alias("spoilage_arbitrage_inr"),
        "action",
    )


def rolling_decision(
    readings: DataFrame, desk: ref.Desk = ref.DESK, overrides: DataFrame | None = None
) -> DataFrame:
    return decide(with_risk(latest_features(readings)), desk, overrides)


def reading_status(readings: DataFrame) -> DataFrame:
    """Temperature status of every reading."""
    t = F.col("temperature_c")
    status = F.when(t <= 8.0, "OPTIMAL").when(t <= 12.0, "WARNING").otherwise("CRITICAL RISK")
    return readings.select(
        "record_id", "container_id", "telemetry_timestamp", "temperature_c", status.alias("status")
    )
