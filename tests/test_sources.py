"""Validation, file sources, upserts, sinks and message shapes."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from frostline.functions import documents, numeric
from frostline.operators.upsert import upsert, upsert_into
from frostline.plans import filters, quality
from frostline.plans.marts import Marts
from frostline.sinks import exports, tables
from frostline.sinks.keyed import KeyedTable
from frostline.sources import files, schemas
from frostline.sources import reference as ref
from frostline.sources import telemetry as feed
from frostline.streaming import topics

# A valid event and the ways to break it
EVENT = {
    "timestamp": "2026-09-21T12:00:00Z",
    "container_id": "CONT_001",
    "shipment_id": "SHIP_001",
    "commodity": "Avocado",
    "temperature_c": 6.2,
    "humidity_pct": 87.5,
    "vibration_g": 0.09,
    "latitude": 19.9975,
    "longitude": 73.7898,
    "origin": "Nashik",
    "destination": "Mumbai",
    "quantity_kg": 12000,
}
FULL = {
    "speed_kmh": 60.0,
    "door_open": False,
    "compressor_status": "NORMAL",
    "anomaly_mode": "NORMAL",
}


def errors_of(spark, value: str) -> list[str]:
    messages = spark.createDataFrame([("r", "k", value)], "record_id string, key string, value string")
    return quality.validate_events(messages).first()["errors"]


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, []),
        (FULL, []),
        ({"temperature_c": 125.0}, ["temperature_c out of range"]),
        ({"humidity_pct": -1.0}, ["humidity_pct out of range"]),
        ({"vibration_g": 5.5}, ["vibration_g out of range"]),
        ({"timestamp": "noon"}, ["invalid timestamp"]),
        ({"quantity_kg": 0}, ["quantity_kg out of range"]),
        ({"temperature_c": "not_a_number"}, ["invalid temperature_c"]),
        ({"temperature_c": None}, ["missing temperature_c"]),
        ({"temperature_c": 60.0, "humidity_pct": 100.0, "vibration_g": 5.0}, []),
    ],
)
def test_event_validation(spark, change, expected):
    assert errors_of(spark, json.dumps({**EVENT, **change})) == expected


def test_incomplete_event(spark):
    found = errors_of(spark, json.dumps({"container_id": "CONT_BROKEN", "temperature_c": "not_a_number"}))
    assert "invalid temperature_c" in found and "missing timestamp" in found and len(found) == 11


@pytest.mark.parametrize("text", ["garbage", "[1, 2]", '"text"', "", "12"])
def test_text_that_is_no_event(spark, text):
    found = errors_of(spark, text)
    assert found == ["malformed"] or len(found) == 12


def test_dead_letter_keeps_payload(spark):
    broken = json.dumps({"container_id": "CONT_BROKEN", "temperature_c": "not_a_number"})
    messages = spark.createDataFrame(
        [("1", "a", json.dumps(EVENT)), ("2", "b", broken)], "record_id string, key string, value string"
    )
    checked = quality.validate_events(messages)
    assert [r["record_id"] for r in quality.valid_events(checked).collect()] == ["1"]
    dead = quality.dead_letters(checked).collect()
    assert [(r["record_id"], r["raw_payload"]) for r in dead] == [("2", broken)]


def test_planted_defects_are_counted(spark, small):
    landed = feed.resent(feed.raw_feed(feed.readings(spark, small)))
    found = {r["check_name"]: r["failures"] for r in quality.not_null_checks(Marts(landed)).collect()}
    assert len(found) == 33
    assert found["stg_telemetry.temperature_c"] > 0
    assert found["stg_telemetry.container_id"] == 0
    unique = {r["check_name"]: r["failures"] for r in quality.unique_checks(Marts(landed)).collect()}
    assert unique["fct_container_health.record_id"] > 0
    assert unique["spoilage_risk.container_id"] == 0


def test_upsert_updates_only_named_columns(spark):
    columns = "market_id, market_name, tier"
    target = ref.local_table(spark, columns, [("A", "old", "1"), ("B", "keep", "1"), ("N", None, None)])
    source = ref.local_table(spark, columns, [("A", "new", "2"), ("C", "add", "3"), ("N", "set", "4")])
    rows = upsert(target, source, ["market_id"], ["market_name"]).collect()
    assert sorted(map(tuple, rows)) == [
        ("A", "new", "1"), ("B", "keep", "1"), ("C", "add", "3"), ("N", "set", None),
    ]


def test_upsert_can_set_null(spark):
    target = ref.local_table(spark, "k, v", [("A", "x")])
    source = ref.local_table(spark, "k, v", [("A", None)])
    assert [tuple(r) for r in upsert(target, source, ["k"], ["v"]).collect()] == [("A", None)]


def test_json_array_source(spark, tmp_path):
    (tmp_path / "events.json").write_text(json.dumps([EVENT, {**EVENT, **FULL}], indent=2))
    rows = files.read_event_arrays(spark, str(tmp_path)).collect()
    assert [r["speed_kmh"] for r in rows] == [None, 60.0]
    assert len(rows[0]) == 16


def test_csv_headers(spark, tmp_path):
    (tmp_path / "p1.csv").write_text("market,commodity,price_per_kg,timestamp\nPune,Apple,1.5,2026\n")
    (tmp_path / "p2.csv").write_text(
        "market,commodity,price_per_kg,currency,last_updated\nPune,Apple,1.5,INR,2026\n"
    )
    (tmp_path / "r.csv").write_text(
        "origin,destination,distance_km,estimated_transit_hours,toll_charges_inr,road_condition_index\n"
        "Nashik,Mumbai,167,4.5,850,0.85\n"
    )
    (tmp_path / "m.csv").write_text(
        "market_id,market_name,latitude,longitude,state,storage_capacity_mt,tier\n"
        "MKT_NSK,Nashik,19.9975,73.7898,Maharashtra,15000,Origin\n"
    )
    read = lambda f, t: files.read_reference_csv(spark, str(tmp_path / f), t).first()
    assert read("p1.csv", "commodity_prices")["last_updated"] == "2026"
    assert read("p2.csv", "commodity_prices")["currency"] == "INR"
    route, market = read("r.csv", "routes"), read("m.csv", "markets")
    assert route["route_id"] == "RT_Nashik_Mumbai" and float(route["toll_cost_inr"]) == 850.0
    assert int(market["cold_storage_capacity_tons"]) == 15000 and market["handling_fee_pct"] is None


def test_raw_defaults(spark):
    as_of = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    markets = ref.local_table(spark, "market_id", [("M",)]).selectExpr(
        "market_id", "'n' AS market_name", "1d AS latitude", "2d AS longitude", "'s' AS state",
        "'t' AS tier", "CAST(NULL AS DOUBLE) AS handling_fee_pct",
        "CAST(NULL AS INT) AS cold_storage_capacity_tons",
    )
    row = schemas.apply_defaults(markets, "markets").first()
    assert float(row["handling_fee_pct"]) == 0.02 and int(row["cold_storage_capacity_tons"]) == 3000
    reading = feed.seed_readings(spark).withColumns(
        {"record_id": F.lit(None).cast("string"), "ingestion_timestamp": F.lit(None).cast("timestamp_ntz")}
    )
    filled = schemas.apply_defaults(reading, "sensor_telemetry", as_of).collect()
    assert len({r["record_id"] for r in filled}) == 7
    assert {r["ingestion_timestamp"] for r in filled} == {datetime(2024, 1, 1)}


def test_messages_are_json(spark):
    row = exports.kafka_payload(feed.seed_readings(spark)).first()
    event = json.loads(row["value"])
    assert row["key"] == "CONT_001" and event["temperature_c"] == 5.8 and len(event) == 12


def test_appended_days_are_partitions(spark, tmp_path):
    readings = feed.seed_readings(spark)
    for _ in range(2):
        tables.write_readings(readings, str(tmp_path / "raw"), "timestamp")
    assert (tmp_path / "raw" / "event_date=2026-09-21").exists()
    assert tables.read_readings(readings, str(tmp_path / "raw")).count() == 14


def test_a_repeated_batch_leaves_one_copy(spark, tmp_path):
    readings = feed.seed_readings(spark)
    raw, lines = str(tmp_path / "raw"), str(tmp_path / "json")
    for batch in ("2024-01-01/a", 7, "2024-01-01/a"):
        tables.write_readings(readings, raw, "timestamp", batch=batch)
        tables.append_json(readings.select("record_id", "container_id"), lines, batch=batch)
    assert tables.read_readings(readings, raw).columns == [*readings.columns, "event_date"]
    assert tables.read_readings(readings, raw).count() == spark.read.json(lines).count() == 14
    # A batch is replaced whole: days that it no longer has are gone.
    tables.write_readings(readings.limit(0), raw, "timestamp", batch=7)
    assert tables.read_readings(readings, raw).count() == 7


def keyed_rows(table, spark):
    return sorted(tuple(r) for r in table.rows(spark).collect())


def test_stored_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, v long, seen long").schema
    table = KeyedTable(str(tmp_path / "t"), ["k"], schema, buckets=16)
    assert table.rows(spark).count() == 0
    target = spark.createDataFrame([(f"k{i}", i, 1) for i in range(100)], schema)
    upsert_into(table, target, ["v"])
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "table").glob("*/*.parquet")}
    assert len({p.parent for p in files}) == 16
    source = spark.createDataFrame([("k3", -3, 2), ("new", 5, 2)], schema)
    expected = sorted([(f"k{i}", i if i != 3 else -3, 1) for i in range(100)] + [("new", 5, 2)])
    for _ in range(2):
        upsert_into(table, source, ["v"])
        assert keyed_rows(table, spark) == expected
    kept = {p.parent for p, at in files.items() if p.exists() and p.stat().st_mtime_ns == at}
    assert len(kept) >= 14


def test_a_merge_that_broke_off_is_repeated_from_its_journal(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v long").schema
    table = KeyedTable(str(tmp_path / "t"), ["k"], schema, buckets=4)

    def add(held, new):
        return held.unionByName(new).groupBy("k").agg(F.sum("v").alias("v"))

    table.merge(spark.createDataFrame([(i, 1) for i in range(20)], schema), add, batch=0)
    changes = spark.createDataFrame([(i, 10) for i in range(20)], schema)
    table.merge(changes, add, batch=1)
    # As if it had broken off after it deleted a bucket: the journal of the batch still has it whole.
    gone = next((tmp_path / "t" / "table").glob("_bucket=*"))
    for file in list(gone.iterdir()):
        file.unlink()
    assert table.rows(spark).count() < 20
    table.merge(changes, add, batch=1)
    assert keyed_rows(table, spark) == [(i, 11) for i in range(20)]
    table.merge(spark.createDataFrame([(3, 100)], schema), add, batch=2)
    assert keyed_rows(table, spark)[3] == (3, 111)


def test_work_folder_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (tables.work_folder(spark, "x") for _ in range(2))
    assert first.startswith(shared) and first != second


def test_topic_options():
    options = topics.source_options("host:9092", topics.TELEMETRY_TOPIC, 10)
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "sensor-data",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
    }
    assert topics.trigger() == {"availableNow": True}
    assert topics.trigger(5) == {"processingTime": "5 seconds"}


def test_recent_readings_skip_days(spark, small, tmp_path, capsys):
    readings = Marts(feed.readings(spark, small)).readings
    path = str(tmp_path / "readings")
    tables.write_readings(readings, path, "telemetry_timestamp")
    stored = tables.read_readings(readings, path)
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    recent = filters.filter_recent(stored, 24, as_of)
    recent.explain()
    assert "PartitionFilters: [isnotnull(event_date" in capsys.readouterr().out.replace("\n", "")
    assert recent.count() == filters.filter_recent(readings, 24, as_of).count() > 0


def test_clock_change_does_not_shift_text(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        clock = F.lit("2024-03-10 02:30:00.5").cast("timestamp_ntz")
        row = spark.range(1).select(
            documents.iso_time(clock), documents.time_of_day(clock), numeric.epoch_seconds(clock)
        ).first()
        assert tuple(row) == ("2024-03-10T02:30:00.500000", "02:30:00", 1710037800)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_the_newest_clock_is_looked_for_in_the_newest_day(spark, small, tmp_path, capsys):
    readings = Marts(feed.readings(spark, small)).readings
    path = str(tmp_path / "readings")
    tables.write_readings(readings, path, "telemetry_timestamp")
    stored = tables.read_readings(readings, path)
    recent = filters.filter_recent(stored, 24)
    recent.explain("formatted")
    plan = capsys.readouterr().out.replace("\n", " ")
    assert "ReadSchema: struct<>" in plan and plan.count("event_date") > 3
    assert recent.count() == filters.filter_recent(readings, 24).count() > 0
