"""Streaming jobs: ingestion, alerts, deduplication, rolling risk, latest state, marts.

Each job writes below one folder: its outputs and its checkpoint. Outputs of
``foreachBatch`` jobs go to a folder per batch that a repeated batch overwrites,
so a restart neither loses nor doubles rows. What a job remembers of a container or
a reading is keyed state of Spark's; a batch writes the state of what it brings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegerType, StructField, StructType

from frostline.operators.latest import first_rows, newest_first, newest_per_container, without_retries
from frostline.plans import rolling
from frostline.plans.alerts import alert_documents, alert_payload, with_reasons
from frostline.plans.kinetics import container_health, spoilage_risk
from frostline.plans.markets import market_options
from frostline.plans.marts import spoilage_arbitrage
from frostline.plans.quality import dead_letters, valid_events, validate_events
from frostline.plans.staging import (
    FLAG_COLUMNS,
    STAGED_COLUMNS,
    stage_markets,
    stage_prices,
    stage_telemetry,
)
from frostline.sinks.keyed import KeyedTable, delete, exists, replace
from frostline.sources import reference as ref
from frostline.sources.schemas import EVENT_FIELDS
from frostline.streaming.state import NewestOfReading, TrailingRows, bundle_of_reading
from frostline.streaming.topics import trigger

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _finish(query) -> None:
    query.awaitTermination()


def _each_batch(
    stream: DataFrame,
    folder: str,
    action: Callable[[DataFrame, int], None],
    mode: str = "append",
    seconds: float | None = None,
):
    # Keyed state of Python functions needs this provider; a job started before goes on with its own.
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    return (
        stream.writeStream.foreachBatch(action)
        .outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger(seconds))
        .start()
    )


def _fields(df: DataFrame, *names: str) -> str:
    return ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names)


def _put(df: DataFrame, folder: str, name: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch}")


def read_output(spark: SparkSession, folder: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Everything a job has put out, with the batch it came from.

    With a schema the job may also have put out nothing yet, or only empty batches.
    """
    if schema is None:
        return spark.read.option("mergeSchema", False).parquet(f"{folder}/{name}")
    columns = [f for f in schema.fields if f.name != "batch"]
    whole = StructType([*columns, StructField("batch", IntegerType())])
    if not exists(spark, f"{folder}/{name}"):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(f"{folder}/{name}")


# Ingestion


def ingest(messages: DataFrame, folder: str, seconds: float | None = None):
    """Decode and validate messages once; write valid events, alerts and dead letters."""

    def action(batch: DataFrame, number: int) -> None:
        checked = validate_events(batch).persist()
        valid = valid_events(checked).select(
            "record_id",
            *[
                F.col(c).try_cast("timestamp_ntz").alias(c) if c == "timestamp" else F.col(c)
                for c in EVENT_FIELDS
            ],
        )
        try:
            _put(valid, folder, "valid", number)
            alerts = alert_documents(with_reasons(valid, "timestamp"), "timestamp")
            _put(alerts, folder, "alerts", number)
            _put(dead_letters(checked), folder, "dead", number)
        finally:
            checked.unpersist()

    return _each_batch(messages, folder, action, seconds=seconds)


def alert_stream(readings: DataFrame, folder: str, seconds: float | None = None):
    """Alert messages as they occur; the profile table is joined to the stream."""
    return (
        alert_payload(alert_documents(with_reasons(readings)))
        .writeStream.format("parquet")
        .option("path", f"{folder}/alerts")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger(seconds))
        .start()
    )


def dedup_stream(raw: DataFrame, folder: str, seconds: float | None = None, delay: str = "7 days"):
    """Drop retries; the one ingested last stays, and readings that come late are kept.

    State is the newest row of each reading, and goes once the clocks seen are ``delay`` past the reading's (ten minutes
    later at most, with the bundle it is in). Until then only a newer row of a reading is put out. A row that comes later
    than that goes to the late rows, as there is nothing left to compare it with. ``fresh_readings`` takes the newest row
    of each reading out of both. Readings without container or clock are all kept.
    """
    schema, reading = raw.schema, ["container_id", "timestamp"]
    # The watermark stands on a copy of the clock that goes no further: otherwise Spark would drop late rows unseen.
    clock = F.coalesce(F.col("timestamp"), F.lit("1970-01-01").cast("timestamp_ntz")).cast("timestamp")
    marked = raw.withColumn("_clock", clock).withWatermark("_clock", delay).drop("_clock")
    known = F.col("container_id").isNotNull() & F.col("timestamp").isNotNull()
    verdicts = (
        marked.filter(known)
        .select(*NewestOfReading.COLUMNS, bundle_of_reading().alias("_bundle"))
        .groupBy("_bundle")
        .transformWithState(
            NewestOfReading(_fields(raw, *NewestOfReading.COLUMNS)),
            f"{_fields(raw, *reading)}, _late boolean",
            "append",
            "eventTime",
        )
    )
    # Whole rows go round Python; the job judges them by the verdicts that come with them.
    judged = raw.withColumn("_late", F.lit(None).cast("boolean")).withColumn("_row", F.lit(True))
    judged = judged.unionByName(verdicts.withColumn("_row", F.lit(False)), allowMissingColumns=True)

    def action(batch: DataFrame, number: int) -> None:
        # In one pass: a batch that is read twice runs its state twice.
        same = Window.partitionBy(*reading, F.when(~known, F.col("record_id")))
        newest = same.orderBy(
            F.col("_row").desc(), F.col("ingestion_timestamp").desc_nulls_last(), F.col("record_id").desc_nulls_last()
        )
        told = batch.withColumns({"_position": F.row_number().over(newest), "_verdict": F.max("_late").over(same)})
        kept = told.filter(~known | F.expr("_row AND _position = 1 AND coalesce(_verdict, true)"))
        dated = kept.select(
            *schema.names, F.col("_verdict").isNotNull().alias("is_late"), F.to_date("timestamp").alias("event_date")
        )
        dated.hint("rebalance", "event_date").write.mode("overwrite").partitionBy(
            "is_late", "event_date"
        ).parquet(f"{folder}/fresh/batch={number}")

    return _each_batch(judged, folder, action, seconds=seconds)


def _written(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    dated = StructType(
        [*schema.fields, StructField("is_late", BooleanType()), StructField("event_date", DateType())]
    )
    return read_output(spark, folder, "fresh", dated)


def late_readings(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Rows that came when their reading was no longer remembered, with all their columns."""
    return _written(spark, folder, schema).filter("is_late").select(schema.names)


def fresh_readings(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The newest row of each reading that the job has written, with all its columns."""
    return without_retries(_written(spark, folder, schema)).select(schema.names)


# Rolling risk

_BEFORE = rolling.ANOMALY_ROWS


def rolling_stream(readings: DataFrame, folder: str, seconds: float | None = None):
    """Score every reading against the readings that arrived before it, and tell which turn a container critical.

    State is the last five readings of each container and its newest clock, kept by Spark for each container; a batch
    writes that of the containers it has readings of. Within a batch readings are taken by event time; one older than
    a container's newest is scored and marked late. A batch's readings of one container are sorted in one task, so the
    source's limit on a batch (files or rows) bounds that task.
    """
    kept = readings.select(STAGED_COLUMNS)
    remembered = [c for c in kept.columns if c in TrailingRows.COLUMNS]
    held = (
        kept.select("container_id", "telemetry_timestamp", "record_id", *remembered)
        .groupBy("container_id")
        .transformWithState(
            TrailingRows(remembered, _BEFORE, _fields(kept, *remembered)),
            f"{_fields(kept, 'container_id', *remembered)}, _turn int, _newest timestamp_ntz",
            "append",
            "none",
        )
    )
    # Whole rows go round Python; a container's remembered rows come before those of the batch.
    turns = kept.withColumn("_turn", F.lit(None).cast("int")).unionByName(held, allowMissingColumns=True)

    def action(batch: DataFrame, number: int) -> None:
        order = [F.col(c).asc_nulls_first() for c in ("telemetry_timestamp", "record_id")]
        taken = Window.partitionBy("container_id").orderBy(F.col("_turn").asc_nulls_last(), *order)
        late = F.col("telemetry_timestamp") < F.max("_newest").over(taken)
        before = {f"previous_{i}": F.lag(F.struct(*remembered), i).over(taken) for i in range(1, _BEFORE + 1)}
        rows = batch.withColumns({"is_late": F.coalesce(late, F.lit(False)), **before}).filter("_turn IS NULL")
        rows = rolling.add_features(rows.drop("_turn", "_newest"))
        scored = rolling.with_previous_score(rolling.with_risk(rows)).drop(*before)
        _put(scored, folder, "scored", number)
        written = batch.sparkSession.read.schema(scored.schema).parquet(f"{folder}/scored/batch={number}")
        _put(rolling.transitions(written), folder, "transitions", number)

    return _each_batch(turns, folder, action, seconds=seconds)


def scored_readings(spark: SparkSession, folder: str) -> DataFrame:
    return read_output(spark, folder, "scored")


def transition_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Readings at which a container became critical, each put out by the batch that brought it."""
    return read_output(spark, folder, "transitions").drop("batch")


# Latest state


#: Batches of changes between two snapshots.
SNAPSHOT_EVERY = 16


def latest_stream(readings: DataFrame, folder: str, seconds: float | None = None, every: int = SNAPSHOT_EVERY):
    """Newest reading per container, kept by Spark's state store; puts out the changes.

    After every so many batches the changes since the last snapshot become part of a new one. Changes and snapshots
    that the snapshot before does without are deleted; a reader that has begun with that one still finds its files.
    """
    columns = [c for c in STAGED_COLUMNS if c != "container_id"]
    newest = readings.groupBy("container_id").agg(
        F.max_by(F.struct(*columns), F.struct("telemetry_timestamp", "record_id")).alias("row")
    )

    def action(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        _put(batch.select("container_id", "row.*"), folder, "changes", number)
        if (number + 1) % every == 0:
            # Built on an earlier snapshot, never on this batch's own, so that a repeated batch does the same.
            whole = latest_rows(spark, folder, before=number)
            whole.write.mode("overwrite").parquet(f"{folder}/snapshot/batch={number}")
            for old in _batches(spark, folder, "snapshot")[:-2]:
                delete(spark, f"{folder}/snapshot/batch={old}")
            for old in _batches(spark, folder, "changes"):
                if old <= number - every:
                    delete(spark, f"{folder}/changes/batch={old}")

    return _each_batch(newest, folder, action, "update", seconds)


def _batches(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the batches that have been written whole, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    paths = [str(status.getPath()) for status in files.listStatus(place)]
    numbers = [int(p.rpartition("batch=")[2]) for p in paths if "batch=" in p]
    return sorted(n for n in numbers if exists(spark, f"{folder}/{name}/batch={n}/_SUCCESS"))


def latest_rows(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The current row of each container: the last snapshot (before a batch) and the changes since."""
    shots = [n for n in _batches(spark, folder, "snapshot") if before is None or n < before]
    since = [n for n in _batches(spark, folder, "changes") if not shots or n > shots[-1]]
    parts = [
        spark.read.option("basePath", f"{folder}/{name}").parquet(*[f"{folder}/{name}/batch={n}" for n in numbers])
        for name, numbers in (("changes", since), ("snapshot", shots[-1:]))
        if numbers
    ]
    if not parts:
        return spark.createDataFrame([], _LATEST_COLUMNS).select(STAGED_COLUMNS)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return first_rows(rows, ["container_id"], [F.col("batch").desc(), *newest_first()]).select(STAGED_COLUMNS)


# Marts


_LATEST_COLUMNS = (
    "record_id string, telemetry_timestamp timestamp_ntz, container_id string,"
    " shipment_id string, commodity string, temperature_c double, humidity_pct double,"
    " vibration_g double, latitude double, longitude double, origin string,"
    " destination string, quantity_kg bigint, speed_kmh double, door_open boolean,"
    " compressor_status string, anomaly_mode string, is_temperature_alert int,"
    " is_humidity_alert int, is_vibration_alert int, is_mechanical_alert int"
)


def mart_stream(
    raw: DataFrame,
    markets: DataFrame,
    prices: DataFrame,
    folder: str,
    seconds: float | None = None,
    buckets: int = 64,
):
    """Recompute the reroute mart for the containers each batch brings news of.

    Latest readings and mart are stored in buckets of containers. A batch reads and rewrites the buckets of the
    containers it has readings of, and no others.
    """
    latest, mart = mart_tables(raw.sparkSession, folder, markets, prices, buckets)

    def action(batch: DataFrame, number: int) -> None:
        fresh = newest_per_container(stage_telemetry(batch).select(*STAGED_COLUMNS, *FLAG_COLUMNS)).persist()
        try:
            latest.merge(fresh, lambda held, new: newest_per_container(held.unionByName(new)), number)
            risk = spoilage_risk(container_health(latest.rows_of(fresh)))
            rows = spoilage_arbitrage(market_options(risk, markets, prices))
            mart.merge(rows, lambda held, new: replace(held, new, ["container_id"]), number)
        finally:
            fresh.unpersist()

    return _each_batch(raw, folder, action, seconds=seconds)


def mart_tables(
    spark: SparkSession, folder: str, markets: DataFrame, prices: DataFrame, buckets: int = 64
) -> tuple[KeyedTable, KeyedTable]:
    """The stored latest readings and reroute mart of a ``mart_stream`` job."""
    none = spark.createDataFrame([], _LATEST_COLUMNS)
    rows = spoilage_arbitrage(market_options(spoilage_risk(container_health(none)), markets, prices))
    return (
        KeyedTable(f"{folder}/latest", ["container_id"], none.schema, buckets),
        KeyedTable(f"{folder}/mart", ["container_id"], rows.schema, buckets),
    )


def current_mart(spark: SparkSession, folder: str) -> DataFrame:
    """Mart rows of each container's latest change, however often the job was started."""
    markets, prices = stage_markets(ref.raw_markets(spark)), stage_prices(ref.raw_prices(spark), F.current_timestamp())
    return mart_tables(spark, folder, markets, prices)[1].rows(spark)


def run_to_end(query) -> int:
    """Wait for a job over the data at hand; returns its last batch number."""
    _finish(query)
    progress = query.lastProgress
    return progress["batchId"] if progress else -1
