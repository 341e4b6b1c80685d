"""Every query by name: a function of the session and the folder of the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.functions import documents as doc
from frostline.functions.numeric import round_half_up
from frostline.operators import upsert
from frostline.operators.latest import first_rows, without_retries
from frostline.plans import (
    alerts,
    console,
    dashboard,
    filters,
    quality,
    rolling,
    scenario,
    staging,
)
from frostline.plans.marts import Marts, StoredMarts, dim_market
from frostline.sinks import exports, tables
from frostline.sinks.keyed import KeyedTable
from frostline.sources import files, schemas
from frostline.sources import reference as ref
from frostline.sources import telemetry as feed
from frostline.streaming import jobs

AS_OF = "2024-01-01 00:00:00"
EVENT_COLUMNS = schemas.EVENT_FIELDS


def _marts(spark: SparkSession, sf_dir: str) -> Marts:
    return Marts(feed.readings(spark, sf_dir), prices_as_of=_time())


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings with defects and retries."""
    return feed.resent(feed.raw_feed(feed.readings(spark, sf_dir)))


def _mart_query(build):
    return lambda spark, sf_dir: build(_marts(spark, sf_dir))


#: The dashboards' marts of a session and folder, and the state of the input that they were made from.
_STORED: dict[tuple[str, str], tuple[list, StoredMarts]] = {}


def _input_state(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of a table's files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True)
    found = []
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def _dashboard(spark: SparkSession, sf_dir: str) -> StoredMarts:
    """The marts that all dashboard queries of a session read; written once, and anew when the events change."""
    key, state = (spark.sparkContext.applicationId, sf_dir), _input_state(spark, f"{sf_dir}/events.parquet")
    if key not in _STORED or _STORED[key][0] != state:
        _STORED[key] = (state, StoredMarts(_marts(spark, sf_dir), tables.work_folder(spark, "marts")))
    return _STORED[key][1]


def _dashboard_query(build):
    return lambda spark, sf_dir: build(_dashboard(spark, sf_dir))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.type_readings(feed.readings(spark, sf_dir))


def _typed_query(build):
    return lambda spark, sf_dir: build(_typed(spark, sf_dir))


def _time() -> F.Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


# Sources


def src_json(spark, sf_dir):
    """Write events as files of one JSON array each, then read them back."""
    readings = feed.readings(spark, sf_dir)
    event = F.struct(
        doc.iso_time(F.col("timestamp")).alias("timestamp"),
        *EVENT_COLUMNS[1:],
    )
    arrays = (
        readings.withColumn("_file", F.floor(F.col("event_id") / 5000))
        .groupBy("_file")
        .agg(F.to_json(F.collect_list(event)).alias("value"))
    )
    path = tables.work_folder(spark, "json-arrays")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.read_event_arrays(spark, path)


def _doubles(df: DataFrame) -> DataFrame:
    """Fixed-point columns as doubles, for comparing results."""
    fixed = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
    return df.withColumns({c: F.col(c).cast("double") for c in fixed})


def _csv(spark, df: DataFrame, table: str) -> DataFrame:
    path = tables.work_folder(spark, f"csv-{table}")
    df.write.option("header", True).csv(path)
    return _doubles(files.read_reference_csv(spark, path, table))


def src_csv_prices(spark, sf_dir):
    quotes = feed.price_quotes(feed.readings(spark, sf_dir))
    columns = ["market", "commodity", "price_per_kg", F.col("last_updated").alias("timestamp")]
    return _csv(spark, quotes.select(columns), "commodity_prices")


def src_csv_markets(spark, sf_dir):
    markets = feed.market_registrations(feed.readings(spark, sf_dir))
    capacity = F.col("cold_storage_capacity_tons").alias("storage_capacity_mt")
    return _csv(
        spark,
        markets.select(
            "market_id", "market_name", "latitude", "longitude", "state", capacity, "tier"
        ),
        "markets",
    )


def src_csv_routes(spark, sf_dir):
    routes = feed.route_surveys(feed.readings(spark, sf_dir))
    toll = F.col("toll_cost_inr").alias("toll_charges_inr")
    return _csv(
        spark,
        routes.select(
            F.trim("origin").alias("origin"),
            F.trim("destination").alias("destination"),
            "distance_km",
            "estimated_transit_hours",
            toll,
            "road_condition_index",
        ),
        "routes",
    )


def raw_defaults(spark, sf_dir):
    every = lambda n: F.col("event_id") % n == 0
    sparse = feed.readings(spark, sf_dir).withColumns(
        {
            "record_id": F.when(~every(11), F.col("record_id")),
            "ingestion_timestamp": F.when(~every(4), F.col("ingestion_timestamp")),
            "speed_kmh": F.when(~every(5), F.col("speed_kmh")),
            "door_open": F.when(~every(6), F.col("door_open")),
            "compressor_status": F.when(~every(8), F.col("compressor_status")),
            "anomaly_mode": F.when(~every(9), F.col("anomaly_mode")),
        }
    )
    filled = schemas.apply_defaults(sparse, "sensor_telemetry", _time())
    return _doubles(filled)


def dim_reference(spark, sf_dir):
    """Every reference row with the readings that use it."""
    used = (
        feed.readings(spark, sf_dir).groupBy("origin", "destination", "commodity").count()
    )
    pair = lambda a, b: F.concat_ws("/", a, b)
    parts = [
        (ref.raw_markets(spark).select("market_name"), "market", "destination", "market_name"),
        (ref.raw_prices(spark), "price", pair("destination", "commodity"), pair("market", "commodity")),
        (ref.raw_routes(spark), "route", pair("origin", "destination"), pair("origin", "destination")),
        (ref.envelopes(spark), "commodity", "commodity", "commodity"),
    ]

    def part(table, kind, use, name):
        use = F.col(use) if isinstance(use, str) else use
        name = F.col(name) if isinstance(name, str) else name
        counts = used.groupBy(use.alias("name")).agg(F.sum("count").alias("n"))
        return (
            table.select(name.alias("name"))
            .join(counts, "name", "left")
            .select(F.lit(kind).alias("kind"), "name", F.coalesce("n", F.lit(0)).alias("readings"))
        )

    return reduce(DataFrame.unionByName, [part(*p) for p in parts])


# Sinks


def kafka_payload(spark, sf_dir):
    return exports.kafka_payload(feed.readings(spark, sf_dir))


def sink_append(spark, sf_dir):
    """Append two batches of the 16 event columns to the raw table, one of them twice; read it back."""
    readings = feed.readings(spark, sf_dir)
    path = tables.work_folder(spark, "raw")
    batch = readings.select(*EVENT_COLUMNS)
    for alarm in (True, False, False):
        part = readings.filter((F.col("event_type") == "error") == alarm).select(*EVENT_COLUMNS)
        tables.write_readings(part, path, "timestamp", batch=f"alarm {alarm}")
    return tables.read_readings(batch, path).drop("event_date")


def sink_json(spark, sf_dir):
    """Append two batches as JSON lines, one of them twice; read them back."""
    readings = feed.readings(spark, sf_dir)
    path = tables.work_folder(spark, "json")
    text = doc.iso_time(F.col("timestamp")).alias("timestamp")
    for alarm in (True, False, False):
        part = readings.filter((F.col("event_type") == "error") == alarm)
        tables.append_json(part.select(text, *EVENT_COLUMNS[1:]), path, batch=f"alarm {alarm}")
    return files.read_event_lines(spark, path)


def _upserted(spark, purpose, target, source, rule):
    """A stored table after it was filled and upserted into, as read back. The second upsert changes nothing."""
    keys, update = rule
    table = KeyedTable(tables.work_folder(spark, purpose), keys, target.schema, buckets=8)
    for rows in (target, source, source):
        upsert.upsert_into(table, rows.select(target.columns), update)
    return table.rows(spark)


def upsert_markets(spark, sf_dir):
    readings, markets = feed.readings(spark, sf_dir), staging.stage_markets(ref.raw_markets(spark))
    return _upserted(spark, "markets", markets, feed.observed_markets(readings, markets), upsert.MARKETS)


def upsert_prices(spark, sf_dir):
    quotes = staging.stage_prices(
        feed.price_quotes(feed.readings(spark, sf_dir)), _time()
    ).withColumnRenamed("price_timestamp", "last_updated")
    newest = first_rows(
        quotes,
        ["market", "commodity"],
        [F.col("last_updated").desc(), F.col("price_per_kg").desc()],
    )
    target = staging.stage_prices(ref.raw_prices(spark), _time())
    return _upserted(spark, "prices", target.withColumnRenamed("price_timestamp", "last_updated"), newest, upsert.PRICES)


def upsert_routes(spark, sf_dir):
    routes = staging.stage_routes(ref.raw_routes(spark))
    source = feed.observed_routes(feed.readings(spark, sf_dir), routes)
    return _upserted(spark, "routes", routes, source, upsert.ROUTES)


def seed_readings(spark, sf_dir):
    readings = feed.readings(spark, sf_dir).select(*feed.READING_COLUMNS)
    return readings.unionByName(feed.seed_readings(spark))


def _bundle(spark, sf_dir):
    """Paths of the reporting bundle's tables, written."""
    readings = feed.readings(spark, sf_dir)
    decisions = rolling.decision_columns(
        rolling.rolling_decision(staging.type_readings(readings), ref.DESK)
    )
    dimensions = {
        "commodity_prices": ref.raw_prices(spark),
        "markets": ref.raw_markets(spark),
        "routes": ref.raw_routes(spark),
    }
    folder = tables.work_folder(spark, "bundle")
    return exports.write_bundle(readings, decisions, dimensions, folder)


def export_bundle(spark, sf_dir):
    """Write the reporting bundle and count the rows of each table as read back."""
    counts = [
        spark.read.parquet(path).agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, path in _bundle(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, counts)


#: Of each table of the bundle: what a row is of, what it says, and two amounts.
_CONTENTS = {
    "stg_sensor_telemetry": ("container_id", "commodity", "temperature_c", "quantity_kg"),
    "fct_container_health": ("container_id", "risk_level", "spoilage_risk_score", "time_to_spoilage_hours"),
    "fct_spoilage_arbitrage": ("container_id", "recommendation_action", "spoilage_arbitrage_inr", "reroute_expected_value"),
    "dim_commodity_prices": ("market", "commodity", "price_per_kg", "price_per_kg"),
    "dim_markets": ("market_id", "market_name", "latitude", "longitude"),
    "dim_routes": ("route_id", "destination", "distance_km", "estimated_transit_hours"),
}


def export_contents(spark, sf_dir):
    """Rows of every table of the written bundle, as read back."""
    paths = _bundle(spark, sf_dir)

    def rows(table, name, says, one, other):
        amounts = [F.col(c).cast("double").alias(a) for c, a in ((one, "amount"), (other, "other_amount"))]
        read = spark.read.parquet(paths[table])
        return read.select(F.lit(table).alias("table_name"), F.col(name).alias("name"), F.col(says).alias("says"), *amounts)

    return reduce(DataFrame.unionByName, [rows(table, *columns) for table, columns in _CONTENTS.items()])


def export_results(spark, sf_dir):
    """Write the decisions as JSON and read them back."""
    decisions = _decisions(spark, sf_dir)
    path = tables.work_folder(spark, "results")
    decisions.write.mode("overwrite").json(path)
    return spark.read.schema(decisions.schema).json(path)


def _stored_mart(name: str):
    """A mart written anew and read back."""

    def run(spark, sf_dir):
        return getattr(StoredMarts(_marts(spark, sf_dir), tables.work_folder(spark, "mart")), name)

    return run


# Validation


def _messages(spark, sf_dir):
    return feed.messages(feed.readings(spark, sf_dir)).drop("event_id")


def validate_events(spark, sf_dir):
    checked = quality.validate_events(_messages(spark, sf_dir))
    return checked.select(
        "record_id",
        "container_id",
        "temperature_c",
        F.col("quantity_kg").cast("double").alias("quantity_kg"),
        (F.size("errors") == 0).alias("is_valid"),
        F.array_join("errors", "; ").alias("cause"),
    )


def dead_letters(spark, sf_dir):
    return quality.dead_letters(quality.validate_events(_messages(spark, sf_dir)))


def dedup_telemetry(spark, sf_dir):
    retries = feed.resent(feed.readings(spark, sf_dir), corrected=True)
    return without_retries(retries).select(feed.READING_COLUMNS)


def _landed_check(check):
    """Check the tables over landed readings; the state per container is computed once."""

    def run(spark, sf_dir):
        marts = Marts(_landed(spark, sf_dir))
        return check(marts.store_health(tables.work_folder(spark, "health")))

    return run


# Staging


def stg_telemetry(spark, sf_dir):
    return staging.stage_telemetry(_landed(spark, sf_dir))


def stg_prices(spark, sf_dir):
    return staging.stage_prices(feed.price_quotes(feed.readings(spark, sf_dir)), _time())


def stg_markets(spark, sf_dir):
    return staging.stage_markets(feed.market_registrations(feed.readings(spark, sf_dir)))


def stg_routes(spark, sf_dir):
    return staging.stage_routes(feed.route_surveys(feed.readings(spark, sf_dir)))


def alert_flags(spark, sf_dir):
    return _marts(spark, sf_dir).staged.select("record_id", "commodity", *staging.FLAG_COLUMNS)


def market_options(spark, sf_dir):
    options = _marts(spark, sf_dir).options
    return options.withColumn(
        "projected_spoilage_rate", round_half_up(F.col("projected_spoilage_rate"), 6)
    )


def dim_market_query(spark, sf_dir):
    return dim_market(staging.stage_markets(upsert_markets(spark, sf_dir)))


# Rolling model and console


def _console_state(spark, sf_dir):
    readings = feed.readings(spark, sf_dir)
    return console.console_state(staging.type_readings(readings), feed.authorised_reroutes(readings))


def _stored_state(spark, sf_dir):
    """The console state written once, for queries that use it more than once."""
    return tables.write_mart(_console_state(spark, sf_dir), tables.work_folder(spark, "state"))


def _console_arbitrage(spark, sf_dir):
    return console.arbitrage_records(_console_state(spark, sf_dir))


def _console_table(spark, sf_dir):
    state = _stored_state(spark, sf_dir)
    return console.console_table(console.arbitrage_records(state), console.fleet_records(state))


def console_document(spark, sf_dir):
    history = console.history_series(_typed(spark, sf_dir))
    return console.console_document(_stored_state(spark, sf_dir), history)


def rolling_features(spark, sf_dir):
    return rolling.feature_columns(rolling.rolling_features(_typed(spark, sf_dir)))


def rolling_risk(spark, sf_dir):
    features = rolling.rolling_features(_typed(spark, sf_dir))
    return rolling.risk_columns(rolling.with_risk(features))


def rolling_decision(desk: ref.Desk):
    return lambda spark, sf_dir: rolling.decision_columns(
        rolling.rolling_decision(_typed(spark, sf_dir), desk)
    )


def _decisions(spark, sf_dir):
    return rolling_decision(ref.DESK)(spark, sf_dir)


def scenario_sweep(spark, sf_dir):
    sweep = scenario.scenario_sweep(rolling.latest_features(_typed(spark, sf_dir)))
    return sweep.withColumn("temperature_c", round_half_up(F.col("temperature_c"), 2))


def filter_bucket(spark, sf_dir):
    return filters.filter_bucket(_console_table(spark, sf_dir), "Mango", "High")


def critical_alerts(spark, sf_dir):
    raised = alerts.with_reasons(_typed(spark, sf_dir))
    return alerts.alert_lines(alerts.alert_documents(raised))


# Streams


def _stream(spark, sf_dir):
    return feed.from_events(feed.events_stream(spark, sf_dir))


def stream_ingest(spark, sf_dir):
    folder = tables.work_folder(spark, "ingest")
    messages = feed.messages(_stream(spark, sf_dir)).drop("event_id")
    jobs.run_to_end(jobs.ingest(messages, folder))
    details = {
        "valid": F.col("commodity"),
        "alerts": F.array_join("reasons", " | "),
        "dead": F.col("cause"),
    }
    parts = [
        jobs.read_output(spark, folder, name).select(
            F.lit(name).alias("sink"), "record_id", detail.alias("detail")
        )
        for name, detail in details.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def stream_alerts(spark, sf_dir):
    folder = tables.work_folder(spark, "alerts")
    staged = staging.type_readings(_stream(spark, sf_dir))
    jobs.run_to_end(jobs.alert_stream(staged, folder))
    return spark.read.parquet(f"{folder}/alerts")


def stream_dedup(spark, sf_dir):
    """The deduplication job, started again after it had seen everything."""
    folder = tables.work_folder(spark, "dedup")
    raw = feed.resent(_stream(spark, sf_dir), corrected=True).select(feed.READING_COLUMNS)
    for _ in range(2):
        jobs.run_to_end(jobs.dedup_stream(raw, folder))
    return jobs.fresh_readings(spark, folder, raw.schema)


def stream_dedup_table(spark, sf_dir):
    """The deduplication job over the feed as it lands: some clocks are missing."""
    folder = tables.work_folder(spark, "dedup-table")
    raw = feed.unclocked(feed.resent(_stream(spark, sf_dir), corrected=True)).select(feed.READING_COLUMNS)
    jobs.run_to_end(jobs.dedup_stream(raw, folder))
    return jobs.fresh_readings(spark, folder, raw.schema)


def _scored_stream(spark, sf_dir):
    folder = tables.work_folder(spark, "rolling")
    jobs.run_to_end(jobs.rolling_stream(staging.type_readings(_stream(spark, sf_dir)), folder))
    return folder


def stream_rolling(spark, sf_dir):
    scored = jobs.scored_readings(spark, _scored_stream(spark, sf_dir))
    return rolling.risk_columns(scored)


def stream_transitions(spark, sf_dir):
    return jobs.transition_alerts(spark, _scored_stream(spark, sf_dir))


def stream_latest(spark, sf_dir):
    folder = tables.work_folder(spark, "latest")
    jobs.run_to_end(jobs.latest_stream(staging.type_readings(_stream(spark, sf_dir)), folder))
    return jobs.latest_rows(spark, folder)


def stream_marts(spark, sf_dir):
    folder = tables.work_folder(spark, "marts")
    fixed = Marts(feed.readings(spark, sf_dir))
    for _ in range(2):  # the second start finds nothing new
        jobs.run_to_end(jobs.mart_stream(_stream(spark, sf_dir), fixed.markets, fixed.prices, folder))
    return jobs.current_mart(spark, folder)


QUERIES = {
    "spoilage_arbitrage": _mart_query(lambda m: m.arbitrage),
    "container_health": _mart_query(lambda m: m.health),
    "spoilage_risk": _mart_query(lambda m: m.risk),
    "market_options": market_options,
    "fct_container_health": _mart_query(lambda m: m.readings),
    "dim_container": _mart_query(lambda m: m.container_dim),
    "dim_market": dim_market_query,
    "dim_reference": dim_reference,
    "raw_defaults": raw_defaults,
    "src_json": src_json,
    "src_csv_prices": src_csv_prices,
    "src_csv_markets": src_csv_markets,
    "src_csv_routes": src_csv_routes,
    "stg_telemetry": stg_telemetry,
    "stg_prices": stg_prices,
    "stg_markets": stg_markets,
    "stg_routes": stg_routes,
    "alert_flags": alert_flags,
    "kafka_payload": kafka_payload,
    "sink_append": sink_append,
    "sink_json": sink_json,
    "seed_readings": seed_readings,
    "upsert_markets": upsert_markets,
    "upsert_prices": upsert_prices,
    "upsert_routes": upsert_routes,
    "mart_materialize": _stored_mart("arbitrage"),
    "mart_materialize_containers": _stored_mart("container_dim"),
    "mart_materialize_markets": _stored_mart("market_dim"),
    "mart_materialize_readings": _stored_mart("readings"),
    "export_telemetry": lambda s, d: exports.export_telemetry(feed.readings(s, d)),
    "export_health": lambda s, d: exports.export_health(_decisions(s, d)),
    "export_arbitrage": lambda s, d: exports.export_arbitrage(_decisions(s, d)),
    "export_bundle": export_bundle,
    "export_contents": export_contents,
    "export_results": export_results,
    "decision_report": lambda s, d: exports.decision_report(_decisions(s, d)),
    "validate_events": validate_events,
    "dead_letters": dead_letters,
    "dedup_telemetry": dedup_telemetry,
    "dq_not_null": _landed_check(quality.not_null_checks),
    "dq_unique": _landed_check(quality.unique_checks),
    "dq_accepted_values": _landed_check(quality.accepted_value_checks),
    "dq_reroute_gain": _landed_check(quality.reroute_gain_check),
    "kpi_active": _dashboard_query(lambda m: dashboard.active_containers(m.arbitrage)),
    "kpi_at_risk": _dashboard_query(lambda m: dashboard.containers_at_risk(m.arbitrage)),
    "kpi_critical": _dashboard_query(lambda m: dashboard.critical_containers(m.arbitrage)),
    "kpi_avg_temp": _dashboard_query(lambda m: dashboard.average_temperature(m.readings)),
    "kpi_avg_humidity": _dashboard_query(lambda m: dashboard.average_humidity(m.readings)),
    "kpi_arbitrage": _dashboard_query(lambda m: dashboard.total_arbitrage(m.arbitrage)),
    "kpi_loss_avoided": _dashboard_query(lambda m: dashboard.total_loss_avoided(m.arbitrage)),
    "kpi_executive": _dashboard_query(lambda m: dashboard.executive_overview(m.arbitrage, m.readings)),
    "kpi_executive_fixed": _dashboard_query(
        lambda m: dashboard.executive_overview_once(m.arbitrage, m.readings)
    ),
    "chart_map": _dashboard_query(lambda m: dashboard.fleet_map(m.arbitrage)),
    "chart_temp": _dashboard_query(lambda m: dashboard.temperature_trend(m.readings)),
    "chart_humidity": _dashboard_query(lambda m: dashboard.humidity_trend(m.readings)),
    "chart_leaderboard": _dashboard_query(lambda m: dashboard.risk_leaderboard(m.arbitrage)),
    "chart_matrix": _dashboard_query(lambda m: dashboard.opportunity_matrix(m.arbitrage)),
    "chart_revenue": _dashboard_query(lambda m: dashboard.revenue_comparison(m.arbitrage)),
    "chart_corridor_bubble": _dashboard_query(lambda m: dashboard.corridor_bubbles(m.options)),
    "vd_fleet": _dashboard_query(lambda m: dashboard.fleet_dataset(m.arbitrage, m.market_dim)),
    "vd_commodity_var": _dashboard_query(lambda m: dashboard.commodity_value_at_risk(m.arbitrage)),
    "vd_corridor": _dashboard_query(lambda m: dashboard.corridor_vulnerability(m.routes, m.readings)),
    "alert_feed": _dashboard_query(lambda m: dashboard.alert_feed(m.readings)),
    "dispatch_manifest": _dashboard_query(
        lambda m: dashboard.dispatch_manifest(m.arbitrage, m.market_dim)
    ),
    "audit_trail": _dashboard_query(lambda m: dashboard.audit_trail(m.readings)),
    "filter_fleet": _dashboard_query(
        lambda m: filters.filter_fleet(
            m.risk,
            container_id=[],
            commodity=["Avocado", "Banana", "Tomato"],
            destination=["Mumbai", "Hyderabad"],
            risk_category=["High Risk", "Critical Risk"],
        )
    ),
    "filter_recent": _dashboard_query(lambda m: filters.filter_recent(m.dated_readings, 24).drop("event_date")),
    "filter_text": lambda s, d: filters.filter_text(
        _console_arbitrage(s, d), "Pun", ["container_id", "commodity", "recommended_market"]
    ),
    "filter_bucket": filter_bucket,
    "filter_values": _dashboard_query(lambda m: filters.filter_values(m.arbitrage, m.readings)),
    "filter_values_risk": _dashboard_query(lambda m: filters.filter_values_risk(m.arbitrage)),
    "critical_alerts": critical_alerts,
    "risk_transitions": _typed_query(rolling.risk_transitions),
    "rolling_features": rolling_features,
    "rolling_risk": rolling_risk,
    "rolling_decision": rolling_decision(ref.DESK),
    "rolling_decision_catalogue": rolling_decision(ref.CATALOGUE_DESK),
    "reading_status": _typed_query(rolling.reading_status),
    "history_series": _typed_query(console.history_series),
    "console_table": _console_table,
    "console_kpis": lambda s, d: console.console_kpis(_console_state(s, d)),
    "console_document": console_document,
    "reroute_overrides": lambda s, d: console.reroute_status(_console_state(s, d)),
    "scenario_sweep": scenario_sweep,
    "stream_ingest": stream_ingest,
    "stream_alerts": stream_alerts,
    "stream_dedup": stream_dedup,
    "stream_dedup_table": stream_dedup_table,
    "stream_rolling": stream_rolling,
    "stream_transitions": stream_transitions,
    "stream_latest": stream_latest,
    "stream_marts": stream_marts,
}
