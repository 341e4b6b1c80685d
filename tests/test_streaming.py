"""Streams over several files equal the batch queries, also after a restart."""

import os
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row

from checks.compare import difference
from frostline.operators.latest import without_retries
from frostline.plans import rolling, staging
from frostline.plans.marts import Marts
from frostline.sources import telemetry as feed
from frostline.streaming import jobs
from frostline.streaming.state import BUNDLE_SHARES, TrailingRows, bundle_of_reading

FILES = 4


def put_file(folder, table, number):
    path = folder / f"events-{number}.parquet"
    pq.write_table(table, path)
    os.utime(path, (1_700_000_000 + number * 60,) * 2)


@pytest.fixture(scope="module")
def slices(small):
    """The events cut into files by time."""
    table = pq.read_table(f"{small}/events.parquet").sort_by([("ts", "ascending")])
    size = table.num_rows // FILES
    cuts = [table.slice(i * size, None if i == FILES - 1 else size) for i in range(FILES)]
    return [c.replace_schema_metadata(None) for c in cuts]


@pytest.fixture
def landing(tmp_path, slices):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, part in enumerate(slices):
        put_file(folder, part, i)
    return folder


def stream(spark, folder):
    return feed.from_events(feed.events_stream(spark, str(folder), files_per_trigger=1))


def same(ours, theirs):
    assert difference(ours.toPandas(), theirs.toPandas()) is None


def test_rolling_over_batches_and_a_restart(spark, small, tmp_path, slices):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    readings = staging.type_readings(feed.readings(spark, small))
    for half in ((0, 1), (2, 3)):
        for i in half:
            put_file(folder, slices[i], i)
        job = jobs.rolling_stream(staging.type_readings(stream(spark, folder)), out)
        last = jobs.run_to_end(job)
    assert last == FILES - 1
    scored = jobs.scored_readings(spark, out)
    assert scored.filter("is_late").count() == 0
    same(
        rolling.risk_columns(scored),
        rolling.risk_columns(rolling.with_risk(rolling.rolling_features(readings))),
    )
    same(jobs.transition_alerts(spark, out), rolling.risk_transitions(readings))


def test_late_reading_is_scored_and_marked(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    start = datetime(2024, 1, 10)
    schema = pa.schema(
        [("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()),
         ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())]
    )

    def rows(*items):
        data = [
            dict(event_id=i, ts=start + timedelta(hours=h), user_id=1, event_type="view", value=0.0, props='{"k": 5}')
            for i, h in items
        ]
        return pa.Table.from_pylist(data, schema)

    put_file(folder, rows((1, 0), (2, 1)), 0)
    put_file(folder, rows((3, -48), (4, 2)), 1)
    put_file(folder, rows((5, 1.5), (6, 3)), 2)
    jobs.run_to_end(jobs.rolling_stream(staging.type_readings(stream(spark, folder)), out))
    late = {r["record_id"]: r["is_late"] for r in jobs.scored_readings(spark, out).collect()}
    assert late == {"REC_1": False, "REC_2": False, "REC_3": True, "REC_4": False, "REC_5": True, "REC_6": False}


def test_latest_over_batches(spark, small, landing, tmp_path):
    out = str(tmp_path / "out")
    jobs.run_to_end(jobs.latest_stream(staging.type_readings(stream(spark, landing)), out))
    marts = Marts(feed.readings(spark, small))
    same(jobs.latest_rows(spark, out), marts.health.select(staging.STAGED_COLUMNS))


def test_marts_over_batches(spark, small, landing, tmp_path):
    out = str(tmp_path / "out")
    marts = Marts(feed.readings(spark, small))
    job = jobs.mart_stream(stream(spark, landing), marts.markets, marts.prices, out)
    jobs.run_to_end(job)
    same(jobs.current_mart(spark, out), marts.arbitrage)
    # A start that finds nothing new leaves the mart as it is.
    jobs.run_to_end(jobs.mart_stream(stream(spark, landing), marts.markets, marts.prices, out))
    same(jobs.current_mart(spark, out), marts.arbitrage)


def test_mart_of_a_job_without_input_is_empty(spark, small, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    assert jobs.current_mart(spark, out).count() == 0


def raw_stream(spark, folder):
    return feed.resent(stream(spark, folder), corrected=True).select(feed.READING_COLUMNS)


def test_newest_retry_wins_over_files_and_restarts(spark, small, tmp_path, slices):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    batch = without_retries(feed.resent(feed.readings(spark, small), corrected=True)).select(feed.READING_COLUMNS)
    for number, part in enumerate([3, 0, 2, 1, 0, 3]):
        put_file(folder, slices[part], number)
        if number in (2, 5):  # two starts, and one more that finds nothing
            raw = raw_stream(spark, folder)
            jobs.run_to_end(jobs.dedup_stream(raw, out))
    jobs.run_to_end(jobs.dedup_stream(raw, out))
    same(jobs.fresh_readings(spark, out, raw.schema), batch)


def test_late_correction_and_missing_clocks(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    schema = "record_id string, ingestion_timestamp timestamp_ntz, timestamp timestamp_ntz, container_id string, temperature_c double"
    early, later = datetime(2024, 1, 1), datetime(2024, 1, 9)
    files = [
        [],
        [("r1", early, early, "c1", 1.0), ("r2", early, None, "c1", 5.0), ("r3", early, None, "c1", 6.0)],
        [("r1", later, early, "c1", 2.0), ("r4", later, later, "c2", 7.0)],
        [("r1", datetime(2024, 1, 2), early, "c1", 3.0)],
    ]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        raw = spark.readStream.schema(schema).parquet(str(folder))
        jobs.run_to_end(jobs.dedup_stream(raw, out))
        jobs.fresh_readings(spark, out, raw.schema).count()
    kept = {r["record_id"]: r["temperature_c"] for r in jobs.fresh_readings(spark, out, raw.schema).collect()}
    assert kept == {"r1": 2.0, "r2": 5.0, "r3": 6.0, "r4": 7.0}


def test_timed_trigger_over_files(spark, small, landing, tmp_path):
    out = str(tmp_path / "out")
    raw = raw_stream(spark, landing)
    job = jobs.dedup_stream(raw, out, seconds=0.5)
    try:
        job.processAllAvailable()
    finally:
        job.stop()
    batch = without_retries(feed.resent(feed.readings(spark, small), corrected=True)).select(feed.READING_COLUMNS)
    same(jobs.fresh_readings(spark, out, raw.schema), batch)


def test_ingest_over_batches(spark, small, landing, tmp_path):
    out = str(tmp_path / "out")
    messages = feed.messages(stream(spark, landing)).drop("event_id")
    assert jobs.run_to_end(jobs.ingest(messages, out)) == FILES - 1
    valid, dead = (jobs.read_output(spark, out, n).count() for n in ("valid", "dead"))
    assert valid + dead == 1000 and dead > 0
    assert jobs.read_output(spark, out, "alerts").count() > 0


def readings_file(spark, folder, rows):
    """Staged readings (record, container, clock, temperature) as one more file."""
    staged = spark.createDataFrame(
        [
            (r, clock, c, "s", "Bananas", t, 60.0, 0.05, 1.0, 2.0, "a", "b", 1000, 50.0, False, "ON", "none")
            for r, c, clock, t in rows
        ],
        READING_SCHEMA,
    )
    staged.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(READING_SCHEMA).parquet(str(folder))


READING_SCHEMA = ", ".join(c for c in jobs._LATEST_COLUMNS.split(", ") if "alert" not in c)


def test_a_transition_is_put_out_once_by_its_batch(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    hot, start = 60.0, datetime(2024, 1, 1)
    for i, temperature in enumerate([13.0, hot, hot, hot, hot]):
        rows = [(f"a{i}", "c1", start + timedelta(hours=i), temperature), (f"b{i}", None, start + timedelta(hours=i), 13.0)]
        jobs.run_to_end(jobs.rolling_stream(readings_file(spark, folder, rows), out))
        jobs.run_to_end(jobs.rolling_stream(readings_stream(spark, folder), out))  # finds nothing
    scored = jobs.scored_readings(spark, out)
    assert scored.count() == 10
    turned = rolling.transitions(scored).collect()
    assert len(turned) == 1
    put_out = jobs.read_output(spark, out, "transitions").collect()
    assert [r["record_id"] for r in put_out] == [turned[0]["record_id"]]
    assert put_out[0]["batch"] == int(turned[0]["record_id"][1:])
    # A batch that is repeated, as after a failure before its commit, puts out the same again and no more.
    commit = max((tmp_path / "out" / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    os.remove(commit)
    (commit.parent / f".{commit.name}.crc").unlink(missing_ok=True)
    jobs.run_to_end(jobs.rolling_stream(readings_stream(spark, folder), out))
    assert jobs.scored_readings(spark, out).count() == 10 and jobs.transition_alerts(spark, out).count() == 1


def readings_stream(spark, folder):
    return spark.readStream.schema(READING_SCHEMA).parquet(str(folder))


def test_late_rows_go_aside_and_none_is_lost(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    schema = "record_id string, ingestion_timestamp timestamp_ntz, timestamp timestamp_ntz, container_id string"
    day = [datetime(2024, 1, d) for d in range(1, 30)]
    files = [
        [("r1", day[0], day[0], "c1")],
        [("r2", day[20], day[20], "c1"), ("r2", day[21], day[20], "c1")],  # moves the watermark to the 20th
        [("r1", day[22], day[0], "c1"), ("r3", day[22], day[1], "c2"), ("r2", day[22], day[20], "c1"), ("r2", day[19], day[20], "c1")],
        [("r1", day[5], day[0], "c1")],
    ]
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        raw = spark.readStream.schema(schema).parquet(str(folder))
        jobs.run_to_end(jobs.dedup_stream(raw, out, delay="1 day"))
    late = jobs.late_readings(spark, out, raw.schema).collect()
    assert sorted((r["record_id"], r["ingestion_timestamp"].day) for r in late) == [("r1", 6), ("r1", 23), ("r3", 23)]
    kept = jobs.fresh_readings(spark, out, raw.schema).collect()
    assert sorted((r["record_id"], r["ingestion_timestamp"].day) for r in kept) == [("r1", 23), ("r2", 23), ("r3", 23)]


def test_state_of_readings_goes_after_the_delay(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    schema = "record_id string, ingestion_timestamp timestamp_ntz, timestamp timestamp_ntz, container_id string"
    held = []
    for d in range(8):
        clock = datetime(2024, 1, 1) + timedelta(days=3 * d)
        rows = [(f"r{d}-{i}", clock, clock + timedelta(minutes=i), "c1") for i in range(20)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        query = jobs.dedup_stream(spark.readStream.schema(schema).parquet(str(folder)), out, delay="1 day")
        jobs.run_to_end(query)
        held.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]))
    assert max(held[3:]) <= held[1] + 20  # a day's readings and the last file's, not all that ever came
    assert jobs.fresh_readings(spark, out, spark.read.schema(schema).parquet(str(folder)).schema).count() == 160


def test_readings_share_the_keys_of_their_state(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    schema = "record_id string, ingestion_timestamp timestamp_ntz, timestamp timestamp_ntz, container_id string"
    start = datetime(2024, 1, 1)
    rows = [(f"r{i}", start, start + timedelta(seconds=i % 900), f"c{i}") for i in range(2000)]
    spark.createDataFrame(rows, schema).write.parquet(str(folder))
    raw = spark.readStream.schema(schema).parquet(str(folder))
    query = jobs.dedup_stream(raw, out)
    jobs.run_to_end(query)
    bundles = spark.read.schema(schema).parquet(str(folder)).select(bundle_of_reading()).distinct().count()
    progress = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    # As many timers as bundles also tells that the state of a batch ran once.
    assert sum(p["customMetrics"]["numRegisteredTimers"] for p in progress) == bundles <= 2 * BUNDLE_SHARES
    assert jobs.fresh_readings(spark, out, raw.schema).count() == 2000


class Held:
    """State of one key, held in memory."""

    def __init__(self, rows=()):
        self.rows = list(rows)

    def get(self):
        return iter(self.rows)

    def exists(self):
        return bool(self.rows)

    def put(self, rows):
        self.rows = list(rows)


class HeldValue(Held):
    def get(self):
        return self.rows[0]

    def update(self, value):
        self.rows = [value]


def test_only_remembered_rows_come_out_of_rolling_state():
    columns, start = list(TrailingRows.COLUMNS), datetime(2024, 1, 1)
    state = TrailingRows(columns, 5, "")
    state.tail, state.newest = Held(), HeldValue()

    def batch(numbers):
        rows = [
            Row(record_id=f"r{i:04}", telemetry_timestamp=start + timedelta(minutes=i), temperature_c=float(i),
                humidity_pct=None, vibration_g=0.0, commodity="Mango")
            for i in numbers
        ]
        return list(state.handleInputRows(("c1",), iter(rows), None))

    assert batch(range(999, -1, -1)) == []
    given = batch([500, 2000])
    assert [(r["temperature_c"], r["_turn"]) for r in given] == [(995.0 + i, i) for i in range(5)]
    assert {r["_newest"] for r in given} == {start + timedelta(minutes=999)}
    assert [r[0] for r in state.tail.rows] == [997.0, 998.0, 999.0, 500.0, 2000.0]


def test_latest_rows_read_a_snapshot_and_the_changes_since(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    start, newest = datetime(2024, 1, 1), {}
    for i in range(11):
        rows = [(f"r{i}-{c}", f"c{c}", start + timedelta(hours=i), float(i)) for c in range(i % 3, 4)]
        newest |= {r[1]: r[0] for r in rows}
        jobs.run_to_end(jobs.latest_stream(readings_file(spark, folder, rows), out, every=3))
        assert {r["container_id"]: r["record_id"] for r in jobs.latest_rows(spark, out).collect()} == newest
    assert len(jobs._batches(spark, out, "snapshot")) <= 2 and len(jobs._batches(spark, out, "changes")) <= 6
    assert len([f for f in jobs.latest_rows(spark, out).inputFiles() if "snapshot" in f]) >= 1
    assert not any("batch=0/" in f for f in jobs.latest_rows(spark, out).inputFiles())


def test_a_batch_rewrites_the_buckets_of_its_containers_only(spark, small, tmp_path):
    marts = Marts(feed.readings(spark, small))
    folder, out = tmp_path / "in", tmp_path / "out"
    raw = feed.readings(spark, small).select(feed.READING_COLUMNS)
    one = raw.select("container_id").distinct().orderBy("container_id").first()[0]
    for i, part in enumerate([raw, raw.filter(raw.container_id == one)]):
        part.coalesce(1).write.mode("append").parquet(str(folder))
        before = {p: p.stat().st_mtime_ns for t in ("latest", "mart") for p in (out / t / "table").glob("*/*.parquet")}
        stream = spark.readStream.schema(raw.schema).parquet(str(folder))
        jobs.run_to_end(jobs.mart_stream(stream, marts.markets, marts.prices, str(out), buckets=16))
    after = {p: p.stat().st_mtime_ns for t in ("latest", "mart") for p in (out / t / "table").glob("*/*.parquet")}
    for table in ("latest", "mart"):
        kept = {p.parent for p in before if table in str(p) and after.get(p) == before[p]}
        gone = {p.parent for p in before if table in str(p) and p not in after}
        assert len(gone) == 1 and len(kept) >= 2 and not kept & gone
    same(jobs.current_mart(spark, str(out)), marts.arbitrage)


def test_batches_of_ten_rows_equal_one_batch(spark, small, tmp_path):
    folder, outs = str(tmp_path / "in"), [str(tmp_path / x) for x in ("tens", "one")]
    events = feed.events(spark, small).orderBy("event_id").limit(50).coalesce(1)
    feed.land_events(events.limit(30), folder, 10)
    raw = feed.from_events(feed.row_limited_stream(spark, folder))
    assert jobs.run_to_end(jobs.ingest(feed.messages(raw).drop("event_id"), outs[0])) == 2
    feed.land_events(events.filter("event_id not in (%s)" % ", ".join(str(r[0]) for r in events.limit(30).select("event_id").collect())), folder, 10)
    assert jobs.run_to_end(jobs.ingest(feed.messages(raw).drop("event_id"), outs[0])) == 4
    counts = {"valid": 0, "dead": 0}
    for name in counts:
        for r in jobs.read_output(spark, outs[0], name).groupBy("batch").count().collect():
            counts[name] += r["count"]
    assert sum(counts.values()) == 50
    per_batch = jobs.read_output(spark, outs[0], "valid").select("batch", "record_id").unionByName(jobs.read_output(spark, outs[0], "dead").select("batch", "record_id"))
    assert {r["count"] for r in per_batch.groupBy("batch").count().collect()} == {10}
    once = feed.from_events(feed.events(spark, small).orderBy("event_id").limit(50))
    whole = spark.readStream.schema(feed.events(spark, small).schema)
    feed.events(spark, small).orderBy("event_id").limit(50).coalesce(1).write.parquet(str(tmp_path / "once"))
    job = jobs.ingest(feed.messages(feed.from_events(whole.parquet(str(tmp_path / "once")))).drop("event_id"), outs[1])
    assert jobs.run_to_end(job) == 0 and once.count() == 50
    for name in counts:
        same(*[jobs.read_output(spark, out, name).drop("batch") for out in outs])
