"""Container telemetry derived from the ``events`` table.

One event is one reading, one user is one container. The same projection runs on
a batch and on a streaming DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.functions import documents as doc
from frostline.functions.numeric import round_positive, round_total
from frostline.sources import reference as ref

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string"
)

READING_COLUMNS = [
    "record_id",
    "ingestion_timestamp",
    "timestamp",
    "container_id",
    "shipment_id",
    "commodity",
    "temperature_c",
    "humidity_pct",
    "vibration_g",
    "latitude",
    "longitude",
    "origin",
    "destination",
    "quantity_kg",
    "speed_kmh",
    "door_open",
    "compressor_status",
    "anomaly_mode",
]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Event files of a folder as a stream; the driver's folder holds other tables too."""
    return (
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("pathGlobFilter", "events*.parquet")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def land_events(events: DataFrame, folder: str, rows: int) -> None:
    """Add events to a landing folder in files of so many rows, a task's last file of fewer.

    A stream that takes one file at a time then takes as many rows in a batch, whatever size the events came in.
    """
    columns = [field.split()[0] for field in EVENTS_SCHEMA.split(", ")]
    staging = f"{folder.rstrip('/')}/events-{uuid.uuid4().hex}.parquet"
    events.select(columns).write.option("maxRecordsPerFile", rows).parquet(staging)


def row_limited_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The landed events as a stream, a file of ``land_events`` in each batch."""
    return (
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", 1)
        .parquet(folder)
    )


def _pick(values: list, index: str) -> str:
    listed = ", ".join(ref.sql_literal(v) for v in values)
    return f"element_at(array({listed}), int({index} % {len(values)} + 1))"


def from_events(df: DataFrame) -> DataFrame:
    """Readings with the raw telemetry columns, and the event's own columns beside them."""
    place = {m[1]: m for m in ref.MARKETS}
    centre = {e[0]: e[3] for e in ref.ENVELOPES}
    starts, ends = [r[1] for r in ref.ROUTES], [r[2] for r in ref.ROUTES]

    def along(axis: int) -> str:
        start = _pick([place[name][axis] for name in starts], "user_id")
        leg = _pick([place[e][axis] - place[s][axis] for s, e in zip(starts, ends)], "user_id")
        return f"{start} + {leg} * (k % 100) / 100d"

    return df.selectExpr("*", "int(regexp_extract(props, '([0-9]+)', 1)) AS k").selectExpr(
        "concat('REC_', event_id) AS record_id",
        "ts AS ingestion_timestamp",
        "ts AS timestamp",
        "concat('CONT_', user_id) AS container_id",
        "concat('SHIP_', user_id) AS shipment_id",
        _pick(ref.COMMODITIES, "user_id") + " AS commodity",
        _pick([centre[c] for c in ref.COMMODITIES], "user_id")
        + " + ((event_id * 7 + k) % 121 - 40) / 10d AS temperature_c",
        "72d + ((event_id * 13 + k) % 280) / 10d AS humidity_pct",
        "((event_id * 17 + k) % 45) / 100d AS vibration_g",
        along(2) + " AS latitude",
        along(3) + " AS longitude",
        _pick(starts, "user_id") + " AS origin",
        _pick(ends, "user_id") + " AS destination",
        f"8000 + 1000 * (user_id % {len(starts)}) AS quantity_kg",
        "double(20 + event_id % 60) AS speed_kmh",
        "event_type = 'signup' AS door_open",
        "CASE WHEN event_type <> 'error' THEN 'NORMAL' WHEN k % 2 = 0 THEN 'FAILURE'"
        " ELSE 'DEGRADED' END AS compressor_status",
        "CASE WHEN event_type = 'error' THEN 'REFRIGERATION_FAULT' ELSE 'NORMAL' END"
        " AS anomaly_mode",
        "event_id",
        "event_type",
        "k",
    ).withColumns(
        {axis: round_positive(F.col(axis), 4) for axis in ("latitude", "longitude")}
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(events(spark, sf_dir))


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def raw_feed(df: DataFrame) -> DataFrame:
    """Readings as they land: padded, partly empty, with text timestamps.

    Defects follow from the event id, so a run can be repeated and checked.
    """
    zone = F.when(_every(2), "Z").otherwise("+00:00")
    padded = F.concat(F.lit("  "), F.col("container_id"), F.lit(" "))
    return df.withColumns(
        {
            "timestamp": F.when(_every(59), F.lit(None).cast("string"))
            .when(_every(53), "not a time")
            .otherwise(F.concat(doc.iso_time(F.col("timestamp")), zone)),
            "container_id": F.when(~_every(61), F.when(_every(7), padded).otherwise(F.col("container_id"))),
            "commodity": F.when(_every(71), "Durian").otherwise(F.concat("commodity", F.lit(" "))),
            "temperature_c": F.when(~_every(67), F.col("temperature_c")),
            "speed_kmh": F.when(~_every(5), F.col("speed_kmh")),
            "door_open": F.when(~_every(6), F.col("door_open")),
            "compressor_status": F.when(~_every(8), F.concat(F.lit(" "), F.col("compressor_status"))),
            "anomaly_mode": F.when(~_every(9), F.col("anomaly_mode")),
        }
    )


def resent(df: DataFrame, corrected: bool = False) -> DataFrame:
    """Readings with retries: some arrive again, up to three times, at later times.

    With ``corrected`` each retry also corrects the temperature, so that it matters which one is kept.
    """
    copies = F.when(_every(40), 3).when(_every(10), 2).otherwise(1)
    later = F.col("ingestion_timestamp") + F.make_dt_interval(mins="copy")
    sent = df.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).withColumn(
        "ingestion_timestamp", later
    )
    if corrected:
        sent = sent.withColumn("temperature_c", F.col("temperature_c") + F.col("copy") * 0.5)
    return sent.drop("copy")


def unclocked(df: DataFrame) -> DataFrame:
    """Readings some of which come without a clock."""
    return df.withColumn("timestamp", F.when(~_every(59), F.col("timestamp")))


def messages(df: DataFrame) -> DataFrame:
    """Wire messages (key, value) of readings, some of them broken on purpose."""
    temperature = (
        F.when(_every(50), F.lit("125.00"))
        .when(_every(51), F.lit('"not_a_number"'))
        .otherwise(doc.number(F.col("temperature_c"), 2).cast("string"))
    )
    shipment = F.when(_every(52), F.lit("")).otherwise(
        F.concat(F.lit('"shipment_id":"'), F.col("shipment_id"), F.lit('",'))
    )
    parts = [
        F.lit('{"timestamp":"'), doc.iso_time(F.col("timestamp")),
        F.lit('Z","container_id":"'), F.col("container_id"), F.lit('",'),
        shipment,
        F.lit('"commodity":"'), F.col("commodity"),
        F.lit('","temperature_c":'), temperature,
        F.lit(',"humidity_pct":'), doc.number(F.col("humidity_pct"), 2),
        F.lit(',"vibration_g":'), doc.number(F.col("vibration_g"), 3),
        F.lit(',"latitude":'), doc.number(F.col("latitude"), 6),
        F.lit(',"longitude":'), doc.number(F.col("longitude"), 6),
        F.lit(',"origin":"'), F.col("origin"),
        F.lit('","destination":"'), F.col("destination"),
        F.lit('","quantity_kg":'), F.col("quantity_kg"),
        F.lit(',"compressor_status":"'), F.col("compressor_status"),
        F.lit('"}'),
    ]
    value = F.when(_every(53), F.concat(F.lit("garbage "), "record_id")).otherwise(F.concat(*parts))
    return df.select(
        "record_id", F.col("container_id").alias("key"), value.alias("value"), "event_id"
    )


def price_quotes(df: DataFrame) -> DataFrame:
    """Raw price quotes: one per purchase event, with empty and zero prices among them."""
    return df.filter(F.col("event_type") == "purchase").select(
        F.when(_every(7), F.concat(F.lit(" "), "destination", F.lit(" ")))
        .otherwise(F.col("destination"))
        .alias("market"),
        F.when(~_every(41), F.col("commodity")).alias("commodity"),
        ((F.col("event_id") * 3 + F.col("k")) % 200 - 1).cast("double").alias("price_per_kg"),
        F.when(~_every(3), F.lit("INR ")).alias("currency"),
        F.when(_every(19), "unknown")
        .otherwise(F.concat(doc.iso_time(F.col("timestamp")), F.lit("Z")))
        .alias("last_updated"),
        "event_id",
    )


def market_registrations(df: DataFrame) -> DataFrame:
    """Raw market rows: one per signup event, located where the container is."""
    short = F.upper(F.substring("destination", 1, 3))
    return df.filter(F.col("event_type") == "signup").select(
        F.when(~_every(23), F.concat(F.lit(" MKT_"), short)).alias("market_id"),
        F.concat("destination", F.lit("  ")).alias("market_name"),
        "latitude",
        "longitude",
        F.lit(" State").alias("state"),
        F.lit("Tier-2 ").alias("tier"),
        F.when(~_every(2), F.col("k") / 1000.0).alias("handling_fee_pct"),
        F.when(~_every(3), F.col("k") * 100).alias("cold_storage_capacity_tons"),
        "event_id",
    )


def route_surveys(df: DataFrame) -> DataFrame:
    """Raw corridor rows: one per view event."""
    km = {f"{r[1]}>{r[2]}": r[3] for r in ref.ROUTES}
    corridor = F.concat("origin", F.lit(">"), "destination")
    base = F.coalesce(*[F.when(corridor == name, v) for name, v in km.items()])
    return df.filter(F.col("event_type") == "view").select(
        F.when(~_every(29), F.concat_ws("_", F.lit(" RT"), "origin", "destination")).alias("route_id"),
        F.concat(F.lit(" "), "origin").alias("origin"),
        F.concat("destination", F.lit(" ")).alias("destination"),
        (base + F.col("k") % 10).alias("distance_km"),
        (1 + F.col("k") % 12).cast("double").alias("estimated_transit_hours"),
        F.when(~_every(4), F.col("k") * 10.0).alias("toll_cost_inr"),
        F.when(~_every(5), F.lit(0.5) + (F.col("k") % 50) / 100.0).alias("road_condition_index"),
        "event_id",
    )


def observed_markets(df: DataFrame, markets: DataFrame) -> DataFrame:
    """Market rows as seen from the fleet: located where the containers bound for it report."""
    seen = df.groupBy(F.col("destination").alias("market_name")).agg(
        round_total(F.avg("latitude"), 4).alias("latitude"),
        round_total(F.avg("longitude"), 4).alias("longitude"),
    )
    return markets.drop("latitude", "longitude").join(seen, "market_name").select(markets.columns)


def observed_routes(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Corridor rows as driven, with the way back as a corridor of its own."""
    speed = df.groupBy("origin", "destination").agg(F.avg("speed_kmh").alias("speed"))
    there = (
        routes.join(speed, ["origin", "destination"])
        .withColumn("distance_km", round_total(F.col("distance_km") * 1.01, 2))
        .withColumn(
            "estimated_transit_hours", round_total(F.col("distance_km") / F.col("speed"), 2)
        )
        .select(routes.columns)
    )
    back = there.withColumns(
        {
            "route_id": F.concat("route_id", F.lit("_R")),
            "origin": F.col("destination"),
            "destination": F.col("origin"),
        }
    )
    return there.unionByName(back)


def authorised_reroutes(df: DataFrame) -> DataFrame:
    """Reroute authorisations: containers may be named more than once."""
    return df.filter((F.col("event_type") == "purchase") & (F.col("k") == 7)).select("container_id")


def seed_readings(spark: SparkSession) -> DataFrame:
    """The sample fleet's first readings as raw rows."""
    columns = "timestamp, " + ", ".join(READING_COLUMNS[3:])
    rows = ref.local_table(spark, columns, ref.SEED_READINGS)
    clock = F.col("timestamp").cast("timestamp_ntz")
    return rows.select(
        F.concat_ws("_", F.lit("SEED"), "container_id", F.substring(clock.cast("string"), 12, 2)).alias("record_id"),
        clock.alias("ingestion_timestamp"),
        clock.alias("timestamp"),
        *READING_COLUMNS[3:],
    )
