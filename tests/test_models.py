"""Edge cases and properties of the models."""

import itertools
import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frostline.functions import numeric
from frostline.operators.latest import without_retries
from frostline.plans import dashboard, filters, quality, rolling, scenario, staging
from frostline.plans.marts import Marts
from frostline.sources import reference as ref
from frostline.sources import telemetry as feed

NOON = datetime(2026, 9, 21, 12)
BASE = {
    "record_id": "r1",
    "ingestion_timestamp": NOON,
    "timestamp": NOON,
    "container_id": "C1",
    "shipment_id": "S1",
    "commodity": "Avocado",
    "temperature_c": 5.5,
    "humidity_pct": 87.0,
    "vibration_g": 0.08,
    "latitude": 19.9975,
    "longitude": 73.7898,
    "origin": "Nashik",
    "destination": "Mumbai",
    "quantity_kg": 12000,
    "speed_kmh": 60.0,
    "door_open": False,
    "compressor_status": "NORMAL",
    "anomaly_mode": "NORMAL",
}
SCHEMA = (
    "record_id string, ingestion_timestamp timestamp_ntz, timestamp timestamp_ntz, container_id string,"
    " shipment_id string, commodity string, temperature_c double, humidity_pct double,"
    " vibration_g double, latitude double, longitude double, origin string, destination string,"
    " quantity_kg bigint, speed_kmh double, door_open boolean, compressor_status string,"
    " anomaly_mode string"
)


def marts_of(spark, *changes):
    rows = []
    for i, change in enumerate(changes):
        row = {**BASE, "record_id": f"r{i}", "container_id": f"C{i}", **change}
        rows.append(tuple(row[c] for c in BASE))
    return Marts(spark.createDataFrame(rows, SCHEMA))


def test_missing_temperature_is_critical_not_healthy(spark):
    risk = marts_of(spark, {"temperature_c": None}).risk.first()
    assert risk["spoilage_risk_score"] is None
    assert risk["time_to_spoilage_hours"] is None
    assert risk["risk_category"] == "Critical Risk"


def test_unknown_commodity_uses_default_envelope_and_never_alerts(spark):
    marts = marts_of(spark, {"commodity": "Durian", "temperature_c": 30.0})
    health = marts.health.first()
    assert (health["optimal_temp_min"], health["optimal_temp_max"]) == (8.0, 12.0)
    assert health["is_temperature_alert"] == 0
    assert marts.options.count() == 0


def test_destination_without_price_leaves_the_mart(spark):
    marts = marts_of(spark, {"destination": "Surat"}, {})
    assert [r["container_id"] for r in marts.arbitrage.collect()] == ["C1"]


def test_standing_container_travels_at_25(spark):
    option = marts_of(spark, {"speed_kmh": 0.0}).options.filter("candidate_market = 'Pune'").first()
    assert option["estimated_transit_hours"] == round(option["distance_km"] / 25 + 1e-9, 1)


def test_padded_names_and_defaults(spark):
    staged = marts_of(spark, {"destination": " Pune ", "speed_kmh": None, "door_open": None}).staged
    row = staged.first()
    assert (row["destination"], row["speed_kmh"], row["door_open"]) == ("Pune", 50.0, False)


def test_equal_clocks_pick_one_row(spark):
    marts = marts_of(spark, {"container_id": "C"}, {"container_id": "C", "temperature_c": 9.0})
    assert [r["record_id"] for r in marts.health.collect()] == ["r1"]


def test_unreadable_clock_is_kept_but_never_latest(spark):
    raw = spark.createDataFrame(
        [("a", "nonsense"), ("b", "2026-09-21T10:00:00Z"), ("c", None)], "record_id string, timestamp string"
    )
    for name, value in BASE.items():
        if name not in ("record_id", "timestamp"):
            raw = raw.withColumn(name, F.lit(value))
    marts = Marts(raw)
    assert marts.staged.count() == 2
    assert marts.health.first()["record_id"] == "b"


def test_prices_must_be_positive(spark):
    raw = ref.local_table(
        spark,
        "market, commodity, price_per_kg, currency, last_updated",
        [("Pune", "Apple", 0.0, "INR", "x"), ("Pune", "Apple", -1.0, "INR", "x"), (" Pune ", "Apple", 2.0, "INR", "x")],
    )
    rows = staging.stage_prices(raw, F.lit("2024-01-01")).collect()
    assert [(r["market"], r["price_per_kg"]) for r in rows] == [("Pune", 2.0)]
    assert rows[0]["price_timestamp"] == datetime(2024, 1, 1)


def test_retries_leave_one_row(spark):
    later = datetime(2026, 9, 21, 13)
    df = marts_of(spark, {"container_id": "C"}, {"container_id": "C", "ingestion_timestamp": later})
    raw = df.staged.withColumnRenamed("telemetry_timestamp", "timestamp")
    assert [r["record_id"] for r in without_retries(raw).collect()] == ["r1"]


def test_strict_helpers_and_texts(spark):
    row = spark.sql("SELECT 1d AS a, CAST(NULL AS DOUBLE) AS n, 2.0d AS two, 12345678.4d AS big").select(
        numeric.greatest_strict(F.col("a"), F.col("n")),
        numeric.least_strict(F.col("a"), F.col("two")),
        numeric.short_text(F.col("two")),
        numeric.whole_text(F.col("big")),
        numeric.float_text(F.col("two")),
        numeric.round_half_up(F.lit(1.005), 2),
    ).first()
    assert tuple(row) == (None, 1.0, "2", "12345678", "2.0", 1.01)


def test_options_equal_the_full_product(spark, small):
    """Matching on the commodity gives the pairs a product with all markets would."""
    marts = Marts(feed.readings(spark, small))
    risk = {r["container_id"]: r for r in marts.risk.collect()}
    priced = {(m, c) for m, c, _ in ref.price_rows(ref.KINETIC_PRICES)}
    expected = {
        (c, m[1])
        for c, m in itertools.product(risk, ref.MARKETS)
        if m[1] != risk[c]["origin"] and (m[1], risk[c]["commodity"]) in priced
    }
    found = {(r[0], r[1]) for r in marts.options.select("container_id", "candidate_market").collect()}
    assert found == expected


def test_one_grouping_equals_join_of_branches(spark, small):
    """The mart from one grouping equals ranking the alternatives and joining them."""
    options = Marts(feed.readings(spark, small)).options.toPandas()
    now = options[options.candidate_market == options.current_destination].set_index("container_id")
    other = options[options.candidate_market != options.current_destination].sort_values(
        ["is_feasible_within_shelf_life", "net_realizable_value_inr", "candidate_market"],
        ascending=[False, False, True],
    )
    best = other.groupby("container_id").first()
    mart = Marts(feed.readings(spark, small)).arbitrage.toPandas().set_index("container_id")
    assert set(mart.index) == set(now.index) & set(best.index)
    assert (mart.recommended_destination == best.candidate_market.loc[mart.index]).all()
    assert (mart.current_expected_value_inr == now.net_realizable_value_inr.loc[mart.index]).all()


def test_mart_properties(spark, small):
    marts = Marts(feed.readings(spark, small))
    mart, shelf = marts.arbitrage, {e[0]: e[4] for e in ref.ENVELOPES}
    for r in mart.collect():
        assert 0 <= r["spoilage_risk_score"] <= 100
        assert 1 <= r["time_to_spoilage_hours"] <= shelf[r["commodity"]]
        assert r["spoilage_arbitrage_inr"] >= 0
        if r["is_reroute_recommended"]:
            assert r["risk_category"] in ("High Risk", "Critical Risk")
            assert r["reroute_transit_hours"] < r["time_to_spoilage_hours"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.floats(-30, 60), st.floats(0, 100), st.floats(0, 5),
            st.sampled_from(["NORMAL", "DEGRADED", "FAILURE"]),
        ),
        min_size=2, max_size=20,
    )
)
def test_hours_fall_as_score_rises(spark, readings):
    changes = [
        {"temperature_c": t, "humidity_pct": h, "vibration_g": v, "compressor_status": c}
        for t, h, v, c in readings
    ]
    rows = marts_of(spark, *changes).risk.collect()
    points = sorted((r["spoilage_risk_score"], -r["time_to_spoilage_hours"]) for r in rows)
    assert all(0 <= s <= 100 and -168 <= h <= -1 for s, h in points)
    assert [h for _, h in points] == sorted(h for _, h in points) or all(
        abs(a[1] - b[1]) <= 2 for a, b in itertools.pairwise(points) if a[1] > b[1]
    )


def test_adding_a_market_never_lowers_the_best_alternative(spark, small):
    raw = feed.readings(spark, small)
    prices = ref.raw_prices(spark)
    few = Marts(raw, raw_prices=prices.filter("market <> 'Delhi'")).options
    best = lambda df: {
        r[0]: (r[1], r[2])
        for r in df.filter("candidate_market <> current_destination")
        .groupBy("container_id")
        .agg(F.max(F.struct("is_feasible_within_shelf_life", "net_realizable_value_inr")).alias("b"))
        .select("container_id", "b.*")
        .collect()
    }
    more, less = best(Marts(raw).options), best(few)
    assert all(more[c] >= less[c] for c in less)


def test_latest_features_equal_all_features(spark, small):
    readings = staging.type_readings(feed.readings(spark, small))
    everywhere = rolling.risk_columns(rolling.with_risk(rolling.rolling_features(readings)))
    latest = rolling.risk_columns(rolling.with_risk(rolling.latest_features(readings)))
    newest = everywhere.groupBy("container_id").agg(
        F.max_by("record_id", F.struct("telemetry_timestamp", "record_id")).alias("record_id")
    )
    expected = everywhere.join(newest, ["container_id", "record_id"], "left_semi")
    assert sorted(map(tuple, expected.select(latest.columns).collect())) == sorted(
        map(tuple, latest.collect())
    )


def test_cut_containers_give_equal_transitions(spark, small):
    readings = staging.type_readings(feed.readings(spark, small))
    whole = sorted(map(tuple, rolling.risk_transitions(readings).collect()))
    cut = sorted(map(tuple, rolling.risk_transitions(readings, rows_per_chunk=3).collect()))
    assert whole == cut and whole


def test_unknown_commodity_takes_the_fallback_profile(spark):
    decided = rolling.rolling_decision(
        marts_of(spark, {"commodity": "Durian", "temperature_c": 12.0}).typed, ref.CONSOLE_DESK
    ).first()
    assert decided["current_price"] == 32.0
    assert decided["best"]["price"] == 32.0
    assert decided["action"] in ("MAINTAIN_ROUTE", "OPPORTUNITY_IDENTIFIED")


def test_overview_counts_money_per_reading(spark, small):
    marts = Marts(feed.readings(spark, small))
    literal = dashboard.executive_overview(marts.arbitrage, marts.readings).first()
    once = dashboard.executive_overview_once(marts.arbitrage, marts.readings).first()
    joined = (
        marts.arbitrage.join(marts.readings.select("container_id", "record_id"), "container_id", "left")
        .filter("is_reroute_recommended")
        .agg(F.sum("spoilage_arbitrage_inr"))
        .first()[0]
    )
    assert literal["total_arbitrage_opportunity_inr"] == round(joined)
    assert literal["total_arbitrage_opportunity_inr"] > once["total_arbitrage_opportunity_inr"]


def test_filters(spark):
    df = spark.createDataFrame(
        [("C1", "Apple", 80.0), ("C2", "Mango", 75.0), ("C3", "Mango", 50.0), ("C4", "Mango", None)],
        "container_id string, commodity string, spoilage_risk_score double",
    )
    ids = lambda d: sorted(r[0] for r in d.collect())
    assert ids(filters.filter_fleet(df, commodity=["Mango"], container_id=[])) == ["C2", "C3", "C4"]
    assert ids(filters.filter_text(df, "MANG", ["container_id", "commodity"])) == ["C2", "C3", "C4"]
    assert ids(filters.filter_text(df, "", ["commodity"])) == ["C1", "C2", "C3", "C4"]
    bands = {b: ids(filters.filter_bucket(df, risk=b)) for b in ("Critical", "High", "Moderate", "Low")}
    assert bands == {"Critical": ["C1", "C2"], "High": ["C3"], "Moderate": [], "Low": ["C4"]}


@pytest.mark.parametrize("hours, expected", [(1, 1), (2, 2), (24, 3)])
def test_recent_filter(spark, hours, expected):
    clocks = [datetime(2026, 9, 21, h) for h in (10, 11, 12)]
    readings = marts_of(spark, *[{"timestamp": c} for c in clocks]).readings
    assert filters.filter_recent(readings, hours).count() == expected


def test_rounding_forms_agree(spark):
    values = spark.range(0, 20000).select(
        (F.rand(1) * 2e6 - 1e6).alias("any"),
        (F.floor(F.rand(2) * 2e6 - 1e6) / 1000).alias("thousandths"),
        (F.floor(F.rand(3) * 2e4 - 1e4) / 8).alias("eighths"),
    )
    for column in values.columns:
        for places in (0, 1, 2, 4):
            value = F.col(column)
            unequal = values.filter(
                (numeric.round_total(value, places) != numeric.round_half_up(value, places))
                | (numeric.round_total(F.abs(value), places) != numeric.round_positive(F.abs(value), places))
            )
            assert unequal.count() == 0
    nothing = spark.sql("SELECT CAST(NULL AS DOUBLE) AS v, -0.2d AS low")
    row = nothing.select(
        numeric.round_half_up(F.col("v"), 1), numeric.round_half_up(F.col("low"), 0).cast("string")
    ).first()
    assert tuple(row) == (None, "0.0")


def test_rounding_holds_for_any_value(spark):
    values = [0.125, -0.125, 214280.005, -214280.005, 1e12 + 0.25, float("nan"), float("inf"), None, -0.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for rounded in (numeric.round_positive, numeric.round_half_up, numeric.round_total):
        got = [r[0] for r in df.orderBy("i").select(rounded(F.col("v"), 2)).collect()]
        assert got == [0.13, -0.13, 214280.01, -214280.01, 1e12 + 0.25, None, None, None, 0.0]


def test_a_bad_row_leaves_the_others_as_they_are(spark, small):
    readings = feed.readings(spark, small)
    before = Marts(readings).arbitrage.toPandas().set_index("container_id").sort_index()
    names = [r[0] for r in readings.select("container_id").distinct().orderBy("container_id").limit(3).collect()]
    bad = readings.withColumns(
        {
            "latitude": F.when(F.col("container_id") == names[0], float("nan")).otherwise(F.col("latitude")),
            "quantity_kg": F.when(F.col("container_id") == names[1], 10**12)
            .when(F.col("container_id") == names[2], -1000)
            .otherwise(F.col("quantity_kg")),
        }
    )
    after = Marts(bad).arbitrage.toPandas().set_index("container_id").sort_index()
    others = before.index.difference(names)
    assert set(before.index) == set(after.index) and before.loc[others].equals(after.loc[others])


def test_events_of_wrong_kind_are_rejected(spark):
    event = {
        "timestamp": "2024-01-01T00:00:00Z", "container_id": "C", "shipment_id": "S", "commodity": "Mango",
        "temperature_c": 5.0, "humidity_pct": 80.0, "vibration_g": 0.1, "latitude": 10.0, "longitude": 20.0,
        "origin": "Pune", "destination": "Delhi", "quantity_kg": 10,
    }
    cases = [{}, {"commodity": 5}, {"container_id": " "}, {"latitude": 999.0}, {"longitude": -181}, {"origin": ""}]
    texts = [(str(i), "k", json.dumps(event | c)) for i, c in enumerate(cases)]
    texts.append((str(len(cases)), "k", json.dumps(event).replace("10.0", "NaN")))
    out = quality.validate_events(spark.createDataFrame(texts, "record_id string, key string, value string"))
    errors = {int(r["record_id"]): r["errors"] for r in out.collect()}
    assert errors[0] == []
    assert [errors[i] for i in range(1, 6)] == [
        ["invalid commodity"], ["invalid container_id"], ["latitude out of range"], ["longitude out of range"], ["invalid origin"],
    ]
    assert errors[6]


def test_an_unknown_measure_makes_no_money(spark, small):
    state = rolling.latest_features(staging.type_readings(feed.readings(spark, small)))
    blind = state.withColumn("temperature_c", F.lit(None).cast("double"))
    for r in scenario.scenario_sweep(blind).limit(50).collect():
        assert r["score"] is r["level"] is r["stay_value"] is r["divert_value"] is r["net_gain"] is None
        assert r["directive"] == "MAINTAIN_ROUTE"
    readings = staging.type_readings(feed.readings(spark, small))
    hidden = readings.withColumn("temperature_c", F.lit(None).cast("double")).withColumn("commodity", F.lit("Durian"))
    for r in rolling.decision_columns(rolling.rolling_decision(hidden, ref.DESK)).collect():
        assert r["spoilage_risk_score"] is None and r["potential_loss"] is None
        assert r["action"] == ref.DESK.stay_label
