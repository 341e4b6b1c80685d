"""Fact and dimension tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.functions.numeric import (
    greatest_strict,
    round_half_up,
    round_positive,
    short_text,
    whole_text,
)
from frostline.operators.latest import newest_per_container
from frostline.plans.kinetics import (
    AT_RISK,
    compressor_penalty,
    container_health,
    risk_band,
    spoilage_risk,
)
from frostline.plans.markets import market_options
from frostline.plans.staging import (
    FLAG_COLUMNS,
    STAGED_COLUMNS,
    alert_flags,
    stage_markets,
    stage_prices,
    stage_routes,
    stage_telemetry,
    type_readings,
)
from frostline.sinks.tables import read_readings, write_mart, write_readings
from frostline.sources import reference as ref

REROUTE_THRESHOLD_INR = 1000.0


def best_and_current(options: DataFrame) -> DataFrame:
    """One row per container: its planned market beside the best alternative.

    The options keep the containers' partitioning, so both come out of one grouping
    without another shuffle. Best means reachable in time, then worth most, then by name.
    """
    at_current = F.col("candidate_market") == F.col("current_destination")
    elsewhere = F.col("candidate_market") != F.col("current_destination")
    planned = F.struct(
        F.col("candidate_price_per_kg").alias("price"),
        F.col("estimated_transit_hours").alias("hours"),
        F.col("projected_spoilage_rate").alias("rate"),
        F.col("net_realizable_value_inr").alias("value"),
        "shipment_id",
        "commodity",
        "quantity_kg",
        "current_destination",
        F.col("current_lat").alias("latitude"),
        F.col("current_lon").alias("longitude"),
        "spoilage_risk_score",
        "risk_category",
        "time_to_spoilage_hours",
    )
    other = F.struct(
        F.col("candidate_market").alias("market"),
        F.col("candidate_price_per_kg").alias("price"),
        F.col("distance_km").alias("km"),
        F.col("estimated_transit_hours").alias("hours"),
        F.col("estimated_freight_cost_inr").alias("freight"),
        F.col("projected_spoilage_rate").alias("rate"),
        F.col("net_realizable_value_inr").alias("value"),
        F.col("is_feasible_within_shelf_life").alias("feasible"),
    )
    preference = F.struct(
        -F.col("is_feasible_within_shelf_life"),
        F.coalesce(-F.col("net_realizable_value_inr"), F.lit(float("inf"))),
        F.col("candidate_market"),
    )
    return (
        options.groupBy("container_id")
        .agg(
            F.max(F.when(at_current, planned)).alias("now"),
            F.min_by(F.when(elsewhere, other), F.when(elsewhere, preference)).alias("alt"),
        )
        .filter(F.col("now").isNotNull() & F.col("alt").isNotNull())
    )


def spoilage_arbitrage(options: DataFrame) -> DataFrame:
    """Gain of the best alternative over the plan, and whether to reroute."""
    kg = F.col("now.quantity_kg")
    uplift = F.col("alt.value") - F.col("now.value")
    loss = round_positive(kg * F.col("now.price") * F.col("now.rate"), 2)
    at_risk = F.col("now.risk_category").isin(*AT_RISK)
    reroute = F.coalesce(
        (uplift > REROUTE_THRESHOLD_INR) & at_risk & (F.col("alt.feasible") == 1), F.lit(False)
    )
    # The wording of the reasons
    reason = (
        F.when(
            reroute,
            F.concat(
                F.lit("Closer terminal ("),
                "alt.market",
                F.lit(" in "),
                short_text(F.col("alt.hours")),
                F.lit("h) prevents decay; unlocks +"),
                whole_text(round_half_up(uplift, 0)),
                F.lit(" INR net arbitrage."),
            ),
        )
        .when(
            at_risk & (F.col("alt.feasible") == 0),
            "Critical deterioration but alternative terminal transit exceeds remaining"
            " shelf life. Expedite current delivery.",
        )
        .otherwise("Conditions nominal. Proceed along primary planned corridor.")
    )
    return best_and_current(options).select(
        "container_id",
        "now.shipment_id",
        "now.commodity",
        "now.quantity_kg",
        "now.latitude",
        "now.longitude",
        "now.spoilage_risk_score",
        "now.risk_category",
        "now.time_to_spoilage_hours",
        "now.current_destination",
        F.col("now.hours").alias("current_transit_hours"),
        F.col("now.price").alias("current_market_price"),
        F.col("now.value").alias("current_expected_value_inr"),
        loss.alias("current_potential_loss_inr"),
        F.col("alt.market").alias("recommended_destination"),
        F.col("alt.km").alias("reroute_distance_km"),
        F.col("alt.hours").alias("reroute_transit_hours"),
        F.col("alt.price").alias("reroute_market_price"),
        F.col("alt.freight").alias("reroute_freight_cost_inr"),
        F.col("alt.value").alias("reroute_expected_value_inr"),
        round_positive(greatest_strict(F.lit(0.0), uplift), 2).alias("spoilage_arbitrage_inr"),
        round_positive(
            greatest_strict(F.lit(0.0), loss - (kg * F.col("alt.price") * F.col("alt.rate"))), 2
        ).alias("spoilage_avoided_value_inr"),
        reroute.alias("is_reroute_recommended"),
        reason.alias("recommendation_reason"),
    )


def fct_container_health(staged: DataFrame) -> DataFrame:
    """Every reading with its instant score. The terms are whole numbers: no rounding needed."""
    score = F.least(
        F.lit(100.0),
        F.col("is_temperature_alert") * 45.0
        + F.col("is_humidity_alert") * 20.0
        + F.col("is_vibration_alert") * 20.0
        + compressor_penalty(),
    )
    return staged.select(
        *STAGED_COLUMNS, *FLAG_COLUMNS, score.alias("instant_risk_score")
    ).withColumn("instant_risk_category", risk_band(F.col("instant_risk_score")))


def dim_container(health: DataFrame) -> DataFrame:
    """Master row per container: attributes of its newest reading."""
    return health.select(
        "container_id",
        "shipment_id",
        "commodity",
        "quantity_kg",
        "origin",
        "destination",
        "compressor_status",
        F.col("telemetry_timestamp").alias("last_reported_at"),
    )


def dim_market(staged_markets: DataFrame) -> DataFrame:
    return staged_markets.select(
        "market_id",
        "market_name",
        "latitude",
        "longitude",
        "state",
        "tier",
        "handling_fee_pct",
        "cold_storage_capacity_tons",
    )


class Marts:
    """The layered tables over one set of raw readings; every property is a lazy plan."""

    def __init__(
        self,
        raw_telemetry: DataFrame,
        raw_markets: DataFrame | None = None,
        raw_prices: DataFrame | None = None,
        raw_routes: DataFrame | None = None,
        bands: DataFrame | None = None,
        envelopes: DataFrame | None = None,
        prices_as_of: Column | None = None,
    ):
        """``prices_as_of`` is the clock of prices that have none; without it, the time of the query."""
        spark = raw_telemetry.sparkSession
        self.spark = spark
        self.typed = type_readings(raw_telemetry)
        self.staged = stage_telemetry(raw_telemetry, bands)
        self.bands, self.envelopes = bands, envelopes
        self.markets = stage_markets(raw_markets or ref.raw_markets(spark))
        self.prices = stage_prices(
            raw_prices or ref.raw_prices(spark),
            F.current_timestamp() if prices_as_of is None else prices_as_of,
        )
        self.routes = stage_routes(raw_routes or ref.raw_routes(spark))

        self.stored_health: DataFrame | None = None

    def store_health(self, folder: str) -> Marts:
        """Write the state per container once, for jobs that use several tables above it."""
        self.stored_health = write_mart(self.health, folder)
        return self

    @property
    def health(self) -> DataFrame:
        if self.stored_health is not None:
            return self.stored_health
        # Flags and bands only for the one reading of each container that counts.
        newest = newest_per_container(self.typed.select(*STAGED_COLUMNS))
        return container_health(alert_flags(newest, self.bands), self.envelopes, one_each=True)

    @property
    def risk(self) -> DataFrame:
        return spoilage_risk(self.health)

    @property
    def options(self) -> DataFrame:
        return market_options(self.risk, self.markets, self.prices)

    @property
    def arbitrage(self) -> DataFrame:
        return spoilage_arbitrage(self.options)

    @property
    def readings(self) -> DataFrame:
        return fct_container_health(self.staged)

    @property
    def market_dim(self) -> DataFrame:
        return dim_market(self.markets)

    @property
    def container_dim(self) -> DataFrame:
        return dim_container(self.health)


class StoredMarts:
    """The four marts as tables: each is written when it is first asked for, and read from then on.

    What lies below them (routes, options, risk) stays a plan.
    """

    def __init__(self, marts: Marts, folder: str):
        self.below, self.folder = marts, folder

    def _table(self, name: str, rows: DataFrame) -> DataFrame:
        return write_mart(rows, f"{self.folder}/{name}")

    @cached_property
    def arbitrage(self) -> DataFrame:
        return self._table("fct_spoilage_arbitrage", self.below.arbitrage)

    @cached_property
    def container_dim(self) -> DataFrame:
        return self._table("dim_container", self.below.container_dim)

    @cached_property
    def market_dim(self) -> DataFrame:
        return self._table("dim_market", self.below.market_dim)

    @cached_property
    def dated_readings(self) -> DataFrame:
        """With the day, by which the table is partitioned."""
        rows, path = self.below.readings, f"{self.folder}/fct_container_health"
        write_readings(rows, path, "telemetry_timestamp", "overwrite")
        return read_readings(rows, path)

    @property
    def readings(self) -> DataFrame:
        return self.dated_readings.drop("event_date")

    @property
    def routes(self) -> DataFrame:
        return self.below.routes

    @property
    def options(self) -> DataFrame:
        return self.below.options

    @property
    def risk(self) -> DataFrame:
        return self.below.risk
