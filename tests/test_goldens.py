"""Hand-computed values of both models on the sample readings."""

import pytest
from pyspark.sql import functions as F

from frostline.plans import alerts, dashboard, kinetics, rolling, scenario
from frostline.plans.marts import Marts
from frostline.sources import reference as ref
from frostline.sources import telemetry as feed


@pytest.fixture(scope="module")
def marts(spark):
    return Marts(feed.seed_readings(spark))


# container: score, category, hours, current (market, hours, value, loss),
# alternative (market, km, hours, value), gain, reroute
SEED_MART = {
    "CONT_001": (100.0, "Critical Risk", 1.0, "Mumbai", 0.8, 1829430.0, 324000.0, "Pune", 102.1, 2.3, 642926.35, 0.0, False),
    "CONT_002": (0.0, "Low Risk", 120.0, "Hyderabad", 7.7, 336757.5, 0.0, "Mumbai", 120.1, 1.8, 497977.5, 161220.0, False),
    "CONT_003": (0.0, "Low Risk", 120.0, "Mumbai", 9.8, 1232701.0, 0.0, "Delhi", 851.5, 12.2, 1398661.25, 165960.25, False),
    "CONT_004": (0.0, "Low Risk", 144.0, "Pune", 2.7, 497539.0, 0.0, "Mumbai", 139.7, 2.3, 530663.0, 33124.0, False),
    "CONT_005": (0.0, "Low Risk", 720.0, "Bengaluru", 7.3, 2385297.0, 0.0, "Delhi", 1253.7, 18.4, 2361501.0, 0.0, False),
}


def test_seed_mart(marts):
    rows = marts.arbitrage.select(
        "container_id",
        "spoilage_risk_score",
        "risk_category",
        "time_to_spoilage_hours",
        "current_destination",
        "current_transit_hours",
        "current_expected_value_inr",
        "current_potential_loss_inr",
        "recommended_destination",
        "reroute_distance_km",
        "reroute_transit_hours",
        "reroute_expected_value_inr",
        "spoilage_arbitrage_inr",
        "is_reroute_recommended",
    ).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == SEED_MART
    reasons = {r[0]: r[1] for r in marts.arbitrage.select("container_id", "recommendation_reason").collect()}
    assert reasons["CONT_001"].startswith("Critical deterioration but")
    assert all(v.startswith("Conditions nominal") for c, v in reasons.items() if c != "CONT_001")


def test_seed_instant_scores(marts):
    rows = marts.readings.orderBy("container_id", "telemetry_timestamp").collect()
    assert [r["instant_risk_score"] for r in rows] == [0.0, 12.0, 100.0, 0.0, 0.0, 0.0, 0.0]
    assert rows[2]["instant_risk_category"] == "Critical Risk"
    assert rows[1]["is_mechanical_alert"] == 1


def test_seed_indicators(marts):
    one = lambda df: tuple(df.first())
    assert one(dashboard.active_containers(marts.arbitrage)) == (5,)
    assert one(dashboard.containers_at_risk(marts.arbitrage)) == (1,)
    assert one(dashboard.critical_containers(marts.arbitrage)) == (1,)
    assert one(dashboard.average_temperature(marts.readings)) == (9.6,)
    assert one(dashboard.average_humidity(marts.readings)) == (90.8,)
    assert one(dashboard.total_arbitrage(marts.arbitrage)) == (None,)
    assert one(dashboard.total_loss_avoided(marts.arbitrage)) == (None,)
    assert one(dashboard.executive_overview(marts.arbitrage, marts.readings))[-2:] == (0.0, 0.0)


def test_seed_corridors(marts):
    rows = dashboard.corridor_vulnerability(marts.routes, marts.readings).collect()
    seen = {r["route_id"]: tuple(r[7:]) for r in rows if r["active_shipments_in_corridor"]}
    assert len(rows) == 11
    assert seen == {
        "RT_NSK_MUM": (1, 9.4, 91.4),
        "RT_PUN_HYD": (1, 13.9, 92.0),
        "RT_NGP_MUM": (1, 11.2, 88.0),
        "RT_NSK_PUN": (1, 11.5, 88.5),
        "RT_HYD_BLR": (1, 2.5, 93.0),
    }


def test_seed_alert(marts):
    found = alerts.alert_documents(alerts.with_reasons(marts.typed)).collect()
    assert len(found) == 1
    assert found[0]["alert_id"] == "ALT_CONT_001_1789992000"
    assert found[0]["reasons"] == [
        "Temperature 13.8°C exceeds critical threshold (12.0°C)",
        "Humidity 96.5% exceeds safe ceiling (95.0%)",
        "Vibration 0.28g exceeds mechanical limit (0.25g)",
    ]


@pytest.mark.parametrize(
    "sf, rows, reroutes, gain",
    [("0.001", 13, 2, 226970.0), ("0.01", 136, 14, 1781962.0), ("0.1", 1363, 145, 17578159.65)],
)
def test_mart_totals(spark, sf, rows, reroutes, gain):
    mart = Marts(feed.readings(spark, f"/root/testdata/sf{sf}")).arbitrage
    found = mart.agg(
        F.count("*"),
        F.count_if("is_reroute_recommended"),
        F.round(F.sum(F.when(F.col("is_reroute_recommended"), F.col("spoilage_arbitrage_inr"))), 2),
    ).first()
    assert tuple(found) == (rows, reroutes, gain)


# container, shipment, commodity, origin, destination, kg, score, level, hours left, transit hours,
# then: price, value, loss, market, market price, cost, reroute value, avoided, net, action
DESK_CASES = [
    ("CONT_001", "Avocado", "Nashik", "Mumbai", 12000, 67.4, "High", 20.0, 8.5,
     195.0, 1709136.0, 630864.0, "Pune", 185.0, 5675.0, 1998000.0, 408864.0, 283189.0, "EXECUTE_REROUTE"),
    ("CONT_002", "Banana", "Nashik", "Pune", 15000, 62.5, "High", 20.0, 5.0,
     42.0, 472500.0, 157500.0, "Delhi", 52.0, 21350.0, 585000.0, -37500.0, 91150.0, "EXECUTE_REROUTE"),
    ("CONT_003", "Tomato", "Hyderabad", "Bengaluru", 10000, 1.3, "Low", 141.0, 10.5,
     36.0, 358128.0, 1872.0, "Delhi", 44.0, 21350.0, 396000.0, -42128.0, 16522.0, "OPPORTUNITY_IDENTIFIED"),
    ("CONT_004", "Mango", "Bengaluru", "Chennai", 8000, 6.6, "Low", 150.6, 6.5,
     118.0, 919078.4, 24921.6, "Delhi", 145.0, 21350.0, 1044000.0, -91078.4, 103571.6, "OPPORTUNITY_IDENTIFIED"),
    ("CONT_005", "Apple", "Shimla", "Delhi", 14000, 2.0, "Low", 697.1, 22.0,
     138.0, 1916544.0, 15456.0, "Mumbai", 155.0, 21350.0, 1953000.0, -201544.0, 15106.0, "OPPORTUNITY_IDENTIFIED"),
]


def test_desk_decisions(spark):
    state = spark.createDataFrame(
        [c[:9] for c in DESK_CASES],
        "container_id string, commodity string, origin string, destination string, quantity_kg bigint,"
        " spoilage_risk_score double, risk_level string, time_to_spoilage_hours double,"
        " current_transit_hours double",
    )
    decided = rolling.decide(rolling.with_specs(state), ref.DESK).orderBy("container_id")
    rows = decided.select(
        "current_price",
        "current_expected_value",
        "potential_loss",
        "best.market",
        "best.price",
        "best.cost",
        "best.value",
        "best.avoided",
        "best.net",
        "action",
    ).collect()
    assert [tuple(r) for r in rows] == [c[9:] for c in DESK_CASES]
    hours = [
        r[0]
        for r in state.orderBy("container_id")
        .transform(rolling.with_specs)
        .orderBy("container_id")
        .select(rolling.hours_left(F.col("shelf_hours"), F.col("spoilage_risk_score")))
        .collect()
    ]
    assert hours == [c[7] for c in DESK_CASES]


def test_scenario_presets(spark):
    cases = spark.createDataFrame(
        [
            ("Avocado", 6.2, 90.0, 0.08, 0, 145.0, 12000),
            ("Banana", 16.5, 85.0, 0.15, 1, 210.0, 15000),
            ("Avocado", 14.2, 91.5, 0.18, 3, 145.0, 12000),
            ("Tomato", 22.0, 98.0, 0.45, 5, 180.0, 10000),
        ],
        "commodity string, temperature_c double, humidity_pct double, vibration_g double, alerts int,"
        " km double, quantity_kg bigint",
    )
    rows = scenario.what_if(cases).select(
        "score", "level", "shelf_hours_left", "diversion_hours", "stay_value", "divert_value",
        "diversion_cost", "net_gain", "directive",
    ).collect()
    assert sorted(tuple(r) for r in rows) == [
        (1.5, "Low", 117.1, 2.9, 2206680.0, 2062800.0, 5675.0, -149555.0, "MAINTAIN_ROUTE"),
        (39.3, "Moderate", 43.2, 4.2, 606816.0, 661500.0, 7950.0, 46734.0, "OPPORTUNITY_IDENTIFIED"),
        (61.9, "High", 25.6, 2.9, 1670328.0, 2062800.0, 5675.0, 386797.0, "EXECUTE_REROUTE"),
        (88.0, "Critical", 4.8, 3.6, 64000.0, 247500.0, 6900.0, 176600.0, "EXECUTE_REROUTE"),
    ]


def test_risk_bands(spark):
    scores = spark.createDataFrame(
        [(25.0,), (25.1,), (50.0,), (50.1,), (75.0,), (75.1,), (None,)], "s double"
    )
    bands = [r[0] for r in scores.select(kinetics.risk_band(F.col("s"))).collect()]
    assert [b.split()[0] for b in bands] == [
        "Low", "Moderate", "Moderate", "High", "High", "Critical", "Critical",
    ]
    levels = [r[0] for r in scores.select(rolling.risk_level(F.col("s"))).collect()]
    assert levels == ["Moderate", "Moderate", "High", "High", "Critical", "Critical", None]


def test_other_envelopes(spark):
    """The kinetic formula under envelopes and bands of the user's own."""
    bands = ref.local_table(
        spark, "commodity, temp_low, temp_high, hum_low, hum_high", [("Avocado", 4.5, 7.5, 80.0, 95.0)]
    )
    envelopes = ref.local_table(
        spark,
        "commodity, optimal_temp_min, optimal_temp_max, optimal_temp_center, baseline_shelf_life_hours",
        [("Avocado", 4.5, 7.5, 6.0, 120.0)],
    )
    seeds = feed.seed_readings(spark).filter("record_id = 'SEED_CONT_001_12'")
    good = seeds.withColumns(
        {
            "container_id": F.lit("good"),
            "temperature_c": F.lit(5.5),
            "humidity_pct": F.lit(87.0),
            "vibration_g": F.lit(0.08),
            "compressor_status": F.lit("NORMAL"),
        }
    )
    bad = seeds.withColumns({"temperature_c": F.lit(14.8), "humidity_pct": F.lit(97.0)})
    marts = Marts(good.unionByName(bad), bands=bands, envelopes=envelopes)
    risk = {
        r["container_id"]: (r["spoilage_risk_score"], r["time_to_spoilage_hours"])
        for r in marts.risk.collect()
    }
    assert risk == {"good": (0.0, 120.0), "CONT_001": (100.0, 1.0)}
