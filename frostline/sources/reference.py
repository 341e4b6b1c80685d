"""Reference tables: markets, prices, corridors and commodity profiles.

Every table here has a fixed, known size, so Spark sees it as a local relation
and its size check lets it broadcast the table by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# market_id, name, latitude, longitude, state, tier, handling fee, storage tons
MARKETS = [
    ("MKT_MUM", "Mumbai", 19.0760, 72.8777, "Maharashtra", "Tier-1", 0.025, 5000),
    ("MKT_PUN", "Pune", 18.5204, 73.8567, "Maharashtra", "Tier-1", 0.020, 3500),
    ("MKT_HYD", "Hyderabad", 17.3850, 78.4867, "Telangana", "Tier-1", 0.022, 4000),
    ("MKT_BLR", "Bengaluru", 12.9716, 77.5946, "Karnataka", "Tier-1", 0.025, 4800),
    ("MKT_MAA", "Chennai", 13.0827, 80.2707, "Tamil Nadu", "Tier-1", 0.023, 3800),
    ("MKT_DEL", "Delhi", 28.6139, 77.2090, "Delhi", "Tier-1", 0.028, 6500),
    ("MKT_SUR", "Surat", 21.1702, 72.8311, "Gujarat", "Tier-2", 0.018, 2500),
    ("MKT_NSK", "Nashik", 19.9975, 73.7898, "Maharashtra", "Tier-2", 0.015, 3000),
    ("MKT_NGP", "Nagpur", 21.1458, 79.0882, "Maharashtra", "Tier-2", 0.019, 2800),
]

# Commodity names in the order used by every price list below
COMMODITIES = ["Avocado", "Banana", "Tomato", "Mango", "Apple"]

# Price per kg by market
KINETIC_PRICES = {
    "Mumbai": [180.0, 35.0, 40.0, 140.0, 130.0],
    "Pune": [195.0, 32.0, 38.0, 145.0, 125.0],
    "Hyderabad": [190.0, 30.0, 45.0, 130.0, 135.0],
    "Bengaluru": [210.0, 38.0, 42.0, 150.0, 140.0],
    "Chennai": [185.0, 34.0, 44.0, 135.0, 138.0],
    "Delhi": [220.0, 40.0, 50.0, 160.0, 150.0],
}

# route_id, origin, destination, km, hours, toll, road condition
ROUTES = [
    ("RT_NSK_MUM", "Nashik", "Mumbai", 165.0, 4.5, 450.0, 0.88),
    ("RT_NSK_PUN", "Nashik", "Pune", 210.0, 5.5, 520.0, 0.85),
    ("RT_NSK_SUR", "Nashik", "Surat", 240.0, 6.0, 600.0, 0.82),
    ("RT_PUN_MUM", "Pune", "Mumbai", 150.0, 3.5, 400.0, 0.95),
    ("RT_PUN_HYD", "Pune", "Hyderabad", 560.0, 11.0, 1200.0, 0.84),
    ("RT_HYD_BLR", "Hyderabad", "Bengaluru", 575.0, 10.5, 1300.0, 0.90),
    ("RT_BLR_MAA", "Bengaluru", "Chennai", 350.0, 7.0, 850.0, 0.92),
    ("RT_DEL_MUM", "Delhi", "Mumbai", 1400.0, 28.0, 3200.0, 0.87),
    ("RT_NGP_MUM", "Nagpur", "Mumbai", 820.0, 16.0, 1800.0, 0.86),
    ("RT_NGP_HYD", "Nagpur", "Hyderabad", 500.0, 10.0, 1100.0, 0.85),
    ("RT_SUR_MUM", "Surat", "Mumbai", 280.0, 6.0, 650.0, 0.89),
]

# Fixed values of the kinetic model: commodity, optimum min, max, centre, shelf hours
ENVELOPES = [
    ("Avocado", 4.0, 7.0, 5.5, 168.0),
    ("Banana", 13.0, 15.0, 14.0, 120.0),
    ("Tomato", 10.0, 13.0, 11.5, 144.0),
    ("Mango", 10.0, 13.0, 11.5, 120.0),
    ("Apple", 0.0, 4.0, 2.0, 720.0),
]
# Fixed values for a commodity without a row above
DEFAULT_ENVELOPE = (8.0, 12.0, 10.0, 168.0)

# Commodity, temperature low and high, humidity low and high (staging alerts)
ALERT_BANDS = [
    ("Avocado", 2.0, 12.0, 75.0, 95.0),
    ("Banana", 11.5, 18.0, 80.0, 98.0),
    ("Tomato", 8.0, 18.0, 75.0, 95.0),
    ("Mango", 9.0, 16.0, 75.0, 95.0),
    ("Apple", -1.0, 8.0, 80.0, 98.0),
]

# Fixed values of the rolling model: commodity, temperature optimum, min, max, critical,
# humidity min, max, vibration max, shelf hours, typical price
SPECS = [
    ("Avocado", 6.0, 4.0, 8.0, 12.0, 80.0, 95.0, 0.25, 120.0, 185.0),
    ("Banana", 14.0, 13.0, 15.0, 18.0, 85.0, 95.0, 0.20, 96.0, 48.0),
    ("Tomato", 12.0, 10.0, 14.0, 18.0, 85.0, 95.0, 0.25, 144.0, 32.0),
    ("Mango", 12.5, 10.0, 14.0, 17.0, 85.0, 95.0, 0.20, 168.0, 95.0),
    ("Apple", 2.0, 0.0, 4.0, 8.0, 88.0, 96.0, 0.30, 720.0, 155.0),
]
# Fixed value: profile used for a commodity without a row above
FALLBACK_COMMODITY = "Tomato"
# Join key of such a commodity
UNKNOWN = "?"

# Fixed values of the rolling model: origin, destination, km, hours, toll
SCHEDULED_ROUTES = [
    ("Nashik", "Mumbai", 168.0, 4.5, 450.0),
    ("Nashik", "Pune", 208.0, 5.0, 500.0),
    ("Nashik", "Delhi", 1250.0, 24.0, 3200.0),
    ("Hyderabad", "Bengaluru", 570.0, 10.0, 1400.0),
    ("Bengaluru", "Chennai", 345.0, 7.0, 900.0),
]

# Fixed values of the rolling model: km, hours and toll of a diversion
DIVERSION_NEAR = {"Pune": (145.0, 2.8, 600.0)}
DIVERSION_OTHER = (550.0, 10.5, 2100.0)

# Price per kg by market, desk catalogue
DESK_PRICES = {
    "Mumbai": [195.0, 45.0, 38.0, 125.0, 155.0],
    "Pune": [185.0, 42.0, 34.0, 115.0, 150.0],
    "Hyderabad": [175.0, 40.0, 32.0, 110.0, 148.0],
    "Bengaluru": [190.0, 44.0, 36.0, 120.0, 152.0],
    "Chennai": [180.0, 43.0, 35.0, 118.0, 150.0],
    "Delhi": [215.0, 52.0, 44.0, 145.0, 138.0],
}

# Price per kg by market, console catalogue
CONSOLE_PRICES = {
    "Mumbai": [180.0, 48.0, 32.0, 95.0, 155.0],
    "Pune": [185.0, 45.0, 28.0, 90.0, 150.0],
    "Delhi": [210.0, 52.0, 36.0, 115.0, 160.0],
    "Bengaluru": [175.0, 42.0, 30.0, 85.0, 165.0],
    "Chennai": [190.0, 46.0, 34.0, 92.0, 170.0],
    "Hyderabad": [182.0, 44.0, 31.0, 88.0, 158.0],
}

# Name, latitude, longitude, state of the console's market map
CONSOLE_MARKETS = [
    ("Nashik", 19.9975, 73.7898, "Maharashtra"),
    ("Mumbai", 19.0760, 72.8777, "Maharashtra"),
    ("Pune", 18.5204, 73.8567, "Maharashtra"),
    ("Hyderabad", 17.3850, 78.4867, "Telangana"),
    ("Bengaluru", 12.9716, 77.5946, "Karnataka"),
    ("Chennai", 13.0827, 80.2707, "Tamil Nadu"),
    ("Delhi", 28.7041, 77.1025, "Delhi NCR"),
]

# First readings of the sample fleet
SEED_READINGS = [
    ("2026-09-21 10:00:00", "CONT_001", "SHIP_001", "Avocado", 5.80, 86.40, 0.08, 19.9975, 73.7898, "Nashik", "Mumbai", 12000, 62.5, False, "NORMAL", "GRADUAL_THERMAL_RISE"),
    ("2026-09-21 11:00:00", "CONT_001", "SHIP_001", "Avocado", 8.50, 91.20, 0.12, 19.5500, 73.4500, "Nashik", "Mumbai", 12000, 58.0, False, "DEGRADED", "GRADUAL_THERMAL_RISE"),
    ("2026-09-21 12:00:00", "CONT_001", "SHIP_001", "Avocado", 13.80, 96.50, 0.28, 19.2000, 73.2000, "Nashik", "Mumbai", 12000, 45.0, False, "FAILURE", "GRADUAL_THERMAL_RISE"),
    ("2026-09-21 12:00:00", "CONT_002", "SHIP_002", "Banana", 13.90, 92.00, 0.05, 18.5204, 73.8567, "Pune", "Hyderabad", 15000, 65.0, False, "NORMAL", "NORMAL"),
    ("2026-09-21 12:00:00", "CONT_003", "SHIP_003", "Mango", 11.20, 88.00, 0.09, 21.1458, 79.0882, "Nagpur", "Mumbai", 9500, 70.0, False, "NORMAL", "NORMAL"),
    ("2026-09-21 12:00:00", "CONT_004", "SHIP_004", "Tomato", 11.50, 88.50, 0.10, 19.9975, 73.7898, "Nashik", "Pune", 14000, 60.0, False, "NORMAL", "NORMAL"),
    ("2026-09-21 12:00:00", "CONT_005", "SHIP_005", "Apple", 2.50, 93.00, 0.07, 17.3850, 78.4867, "Hyderabad", "Bengaluru", 18000, 68.0, False, "NORMAL", "NORMAL"),
]


def price_rows(catalogue: dict[str, list[float]]) -> list[tuple[str, str, float]]:
    return [(m, c, p) for m, prices in catalogue.items() for c, p in zip(COMMODITIES, prices)]


@dataclass(frozen=True)
class Desk:
    """Settings of the rolling decision model."""

    prices: dict[str, list[float]]
    candidates: tuple[str, ...]
    default_hours: float
    stay_label: str


# The priced markets, with the default hours of the console
DESK = Desk(DESK_PRICES, tuple(DESK_PRICES), 6.0, "MAINTAIN_ORIGINAL_ROUTE")
# Every market of the map; one without a price is valued at the typical price
CATALOGUE_DESK = Desk(
    DESK_PRICES, tuple(m[0] for m in CONSOLE_MARKETS), 4.5, "MAINTAIN_ORIGINAL_ROUTE"
)
CONSOLE_DESK = Desk(CONSOLE_PRICES, tuple(CONSOLE_PRICES), 6.0, "MAINTAIN_ROUTE")


def diversion(market: str) -> tuple[float, float, float]:
    return DIVERSION_NEAR.get(market, DIVERSION_OTHER)


def candidate_rows(desk: Desk) -> list[tuple]:
    """(rank, market, commodity, price, km, hours, toll) for every candidate and commodity."""
    listed = {(m, c): p for m, c, p in price_rows(desk.prices)}
    typical = {row[0]: row[9] for row in SPECS}
    typical[UNKNOWN] = typical[FALLBACK_COMMODITY]
    return [
        (rank, market, c, listed.get((market, c), typical[c]), *diversion(market))
        for rank, market in enumerate(desk.candidates)
        for c in typical
    ]


def sql_literal(value) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("'", "''") + "'"


def local_table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A literal table that Catalyst knows the exact size of."""
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def raw_markets(spark: SparkSession) -> DataFrame:
    return local_table(
        spark,
        "market_id, market_name, latitude, longitude, state, tier,"
        " handling_fee_pct, cold_storage_capacity_tons",
        MARKETS,
    )


def raw_prices(spark: SparkSession) -> DataFrame:
    rows = [(m, c, p, "INR", "2026-09-21T06:00:00Z") for m, c, p in price_rows(KINETIC_PRICES)]
    return local_table(spark, "market, commodity, price_per_kg, currency, last_updated", rows)


def raw_routes(spark: SparkSession) -> DataFrame:
    return local_table(
        spark,
        "route_id, origin, destination, distance_km, estimated_transit_hours,"
        " toll_cost_inr, road_condition_index",
        ROUTES,
    )


def envelopes(spark: SparkSession) -> DataFrame:
    return local_table(
        spark,
        "commodity, optimal_temp_min, optimal_temp_max, optimal_temp_center,"
        " baseline_shelf_life_hours",
        ENVELOPES,
    )


def alert_bands(spark: SparkSession) -> DataFrame:
    return local_table(spark, "commodity, temp_low, temp_high, hum_low, hum_high", ALERT_BANDS)


SPEC_COLUMNS = (
    "temp_opt, temp_min, temp_max, temp_critical, humidity_min, humidity_max,"
    " vibration_max, shelf_hours, typical_price"
)


def specs(spark: SparkSession) -> DataFrame:
    return local_table(spark, f"commodity, {SPEC_COLUMNS}", SPECS)


def specs_with_fallback(spark: SparkSession) -> DataFrame:
    """Profiles plus one under the key of the unknown commodity."""
    fallback = next(row for row in SPECS if row[0] == FALLBACK_COMMODITY)
    return local_table(spark, f"commodity, {SPEC_COLUMNS}", [*SPECS, (UNKNOWN, *fallback[1:])])


def scheduled_routes(spark: SparkSession) -> DataFrame:
    return local_table(
        spark,
        "origin, destination, scheduled_km, scheduled_hours, scheduled_toll",
        SCHEDULED_ROUTES,
    )


def desk_prices(spark: SparkSession, desk: Desk) -> DataFrame:
    return local_table(spark, "market, commodity, price", price_rows(desk.prices))


def candidates(spark: SparkSession, desk: Desk) -> DataFrame:
    return local_table(
        spark,
        "candidate_rank, candidate_market, commodity, candidate_price,"
        " candidate_km, candidate_hours, candidate_toll",
        candidate_rows(desk),
    )


def console_markets(spark: SparkSession) -> DataFrame:
    return local_table(spark, "market_name, latitude, longitude, state", CONSOLE_MARKETS)
