"""The checking SQL of every query, for DuckDB over the same tables."""

from __future__ import annotations

from checks.parts import FLAGS, STAGED, dec, float_text, iso, query, rnd
from frostline.queries import AS_OF
from frostline.sources import reference as ref

EVENT = """container_id, shipment_id, commodity, temperature_c, humidity_pct, vibration_g, latitude,
  longitude, origin, destination, quantity_kg, speed_kmh, door_open, compressor_status, anomaly_mode"""
EVENT_TEXT = f"SELECT {iso('\"timestamp\"')} AS \"timestamp\", {EVENT} FROM tele"
EVENT_ROWS = f'SELECT "timestamp", {EVENT} FROM tele'

GAIN = "CASE WHEN is_reroute_recommended THEN {0} ELSE 0e0 END"

EXECUTIVE = f"""
SELECT count(DISTINCT container_id) AS total_active_containers,
  count(DISTINCT CASE WHEN risk_category IN ('High Risk', 'Critical Risk') THEN container_id END)
    AS containers_at_risk,
  count(DISTINCT CASE WHEN risk_category = 'Critical Risk' THEN container_id END) AS critical_containers,
  {rnd("avg(temperature_c)", 1)} AS fleet_avg_temp_c,
  {rnd("avg(humidity_pct)", 1)} AS fleet_avg_humidity_pct,
  {rnd("coalesce(sum(" + GAIN.format("spoilage_arbitrage_inr") + "), 0)", 0)}
    AS total_arbitrage_opportunity_inr,
  {rnd("coalesce(sum(" + GAIN.format("spoilage_avoided_value_inr") + "), 0)", 0)}
    AS total_loss_avoided_inr
FROM mart LEFT JOIN (SELECT container_id, temperature_c, humidity_pct FROM readings) USING (container_id)"""

EXECUTIVE_ONCE = f"""
SELECT c.*, m.* FROM (
  SELECT count(*) AS total_active_containers,
    count(*) FILTER (risk_category IN ('High Risk', 'Critical Risk')) AS containers_at_risk,
    count(*) FILTER (risk_category = 'Critical Risk') AS critical_containers,
    {rnd("coalesce(sum(" + GAIN.format("spoilage_arbitrage_inr") + "), 0)", 0)}
      AS total_arbitrage_opportunity_inr,
    {rnd("coalesce(sum(" + GAIN.format("spoilage_avoided_value_inr") + "), 0)", 0)}
      AS total_loss_avoided_inr FROM mart) m,
  (SELECT {rnd("avg(temperature_c)", 1)} AS fleet_avg_temp_c,
    {rnd("avg(humidity_pct)", 1)} AS fleet_avg_humidity_pct
   FROM readings WHERE container_id IN (SELECT container_id FROM mart)) c"""

CHECKS = {
    "stg_telemetry": ("staged_raw", "record_id container_id commodity temperature_c humidity_pct"),
    "fct_container_health": ("readings_raw", "record_id container_id"),
    "container_health": ("health_raw", "container_id temp_excursion_c"),
    "spoilage_risk": (
        "risk_raw",
        "container_id spoilage_risk_score risk_category time_to_spoilage_hours",
    ),
    "market_options": ("options_raw", "container_id candidate_market net_realizable_value_inr"),
    "fct_spoilage_arbitrage": (
        "mart_raw",
        "container_id commodity spoilage_risk_score risk_category time_to_spoilage_hours"
        " current_destination recommended_destination spoilage_arbitrage_inr",
    ),
    "dim_container": ("containers_raw", "container_id"),
    "stg_prices": ("ref_price", "market commodity price_per_kg"),
    "stg_markets": ("ref_market", "market_id market_name"),
    "dim_market": ("ref_market", "market_id market_name"),
    "stg_routes": ("ref_route", "route_id"),
}
KEYS = [
    ("container_health", "health_raw", "container_id"),
    ("spoilage_risk", "risk_raw", "container_id"),
    ("fct_spoilage_arbitrage", "mart_raw", "container_id"),
    ("fct_container_health", "readings_raw", "record_id"),
    ("dim_container", "containers_raw", "container_id"),
    ("stg_markets", "ref_market", "market_id"),
    ("stg_markets", "ref_market", "market_name"),
    ("dim_market", "ref_market", "market_id"),
    ("dim_market", "ref_market", "market_name"),
    ("stg_routes", "ref_route", "route_id"),
]
RISKS = "'Low Risk', 'Moderate Risk', 'High Risk', 'Critical Risk'"
GOODS = ", ".join(f"'{c}'" for c in ref.COMMODITIES)

NOT_NULL = "\nUNION ALL ".join(
    f"SELECT '{check}.{c}' AS check_name, count(*) - count({c}) AS failures FROM {table}"
    for check, (table, columns) in CHECKS.items()
    for c in columns.split()
)
UNIQUE = "\nUNION ALL ".join(
    f"SELECT '{check}.{c}' AS check_name, count(*) AS failures FROM"
    f" (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
    for check, table, c in KEYS
)
ACCEPTED = "\nUNION ALL ".join(
    f"SELECT '{check}.{c}' AS check_name, count(*) FILTER ({c} NOT IN ({accepted})) AS failures"
    f" FROM {table}"
    for check, table, c, accepted in [
        ("stg_telemetry", "staged_raw", "commodity", GOODS),
        ("spoilage_risk", "risk_raw", "risk_category", RISKS),
        ("fct_spoilage_arbitrage", "mart_raw", "risk_category", RISKS),
    ]
)

TEXT = "'\"{0}\":' || coalesce('\"' || {1} || '\"', 'null')"
BARE = "'\"{0}\":' || coalesce(CAST({1} AS VARCHAR), 'null')"


def json_text(fields: list[tuple[str, int | str]]) -> str:
    """JSON object text: a field is text ('t'), bare ('b') or a number of decimals."""
    shown = []
    for name, kind in fields:
        quoted = f'"{name}"' if name in ("time", "action", "timestamp") else name
        if kind == "t":
            shown.append(TEXT.format(name, quoted))
        else:
            shown.append(BARE.format(name, quoted if kind == "b" else dec(quoted, kind)))
    return "'{' || " + " || ',' || ".join(shown) + " || '}'"


def typed(text: str) -> list[tuple[str, int | str]]:
    pairs = [item.split(":") for item in text.split()]
    return [(n, k if k in "tb" else int(k)) for n, k in pairs]


DOCUMENT = f"""
SELECT 'kpis' AS section, 'kpis' AS entry, {json_text(typed(
    "total_containers:b at_risk_count:b critical_count:b average_temp_c:1 average_humidity_pct:1"
    " total_potential_arbitrage_inr:2 total_loss_avoided_inr:2"))} AS body FROM fleet_kpis
UNION ALL SELECT 'fleet', container_id, {json_text(typed(
    "container_id:t shipment_id:t commodity:t origin:t destination:t quantity_kg:b temperature_c:2"
    " humidity_pct:2 vibration_g:3 latitude:4 longitude:4 rolling_avg_temp:2 rolling_avg_hum:2"
    " temp_penalty:1 hum_penalty:1 vib_penalty:1 exp_penalty:1 spoilage_risk_score:1 risk_level:t"
    " time_to_spoilage_hours:1 action:t is_rerouted:b min_safe_temp:1 max_safe_temp:1"
    " min_safe_hum:1 max_safe_hum:1"))} FROM fleet
UNION ALL SELECT 'arbitrage', container_id, {json_text(typed(
    "container_id:t commodity:t quantity_kg:b current_destination:t status_quo_value:2"
    " potential_loss:2 recommended_market:t recommended_price:2 reroute_transit_hours:1"
    " reroute_expected_value:2 diversion_cost:2 spoilage_loss_avoided:2 net_arbitrage_inr:2"
    " is_viable:b directive:t"))} FROM dealings
UNION ALL SELECT 'history', container_id, '[' || string_agg({json_text(typed(
    "step:b temp:2 hum:2 vib:3 time:t"))}, ',' ORDER BY step) || ']' FROM series GROUP BY container_id
UNION ALL SELECT 'markets', market_name, '{{"lat":' || {dec("latitude", 4)} || ',"lon":'
  || {dec("longitude", 4)} || ',"state":"' || state || '"}}' FROM ref_place"""

PAYLOAD = json_text(
    typed(
        "container_id:t shipment_id:t commodity:t temperature_c:2 humidity_pct:2 vibration_g:3"
        " latitude:6 longitude:6 origin:t destination:t quantity_kg:b"
    )
)

ALERT_JSON = f"""
SELECT container_id AS "key", '{{"alert_id":"' || alert_id || '","timestamp":"'
  || {iso("telemetry_timestamp")} || '","container_id":"' || container_id || '","shipment_id":"'
  || shipment_id || '","commodity":"' || commodity || '","reasons":["'
  || concat_ws('","', reason1, reason2, reason3) || '"],"current_readings":{{"temperature_c":'
  || {dec("temperature_c", 2)} || ',"humidity_pct":' || {dec("humidity_pct", 2)}
  || ',"vibration_g":' || {dec("vibration_g", 3)} || '}},"location":{{"latitude":'
  || {dec("latitude", 6)} || ',"longitude":' || {dec("longitude", 6)} || '}}}}' AS value
FROM alarms"""

SCENARIO = f"""
SELECT container_id, commodity, quantity_kg, {rnd("warm", 2)} AS temperature_c, humidity_pct,
  vibration_g, alerts, km, score, "level", shelf_hours_left, diversion_hours, stay_value,
  divert_value, diversion_cost, net_gain,
  CASE WHEN net_gain > 0 AND diversion_hours <= shelf_hours_left AND score >= 50 THEN 'EXECUTE_REROUTE'
    WHEN net_gain > 0 THEN 'OPPORTUNITY_IDENTIFIED' ELSE 'MAINTAIN_ROUTE' END AS directive
FROM (SELECT *, {rnd("divert_value - diversion_cost - stay_value", 0)} AS net_gain
  FROM (SELECT *,
      {rnd("quantity_kg * typical * (1e0 - CASE WHEN 8.5e0 > shelf_hours_left THEN 0.8e0"
           " ELSE least(0.7e0, score / 100e0 * 0.4e0) END)", 0)} AS stay_value,
      {rnd("quantity_kg * " + rnd("typical * 1.03e0", 0) + " * (1e0 - CASE"
           " WHEN diversion_hours > shelf_hours_left THEN 0.85e0"
           " WHEN diversion_hours <= shelf_hours_left * 0.5e0 THEN 0.1e0 ELSE 0.25e0 END)", 0)}
        AS divert_value
    FROM (SELECT *, CASE WHEN score >= 75 THEN 'Critical' WHEN score >= 50 THEN 'High'
          WHEN score >= 25 THEN 'Moderate' ELSE 'Low' END AS "level",
        {rnd("greatest(1e0, shelf * pow(greatest(0.05e0, 1e0 - score / 100e0), 1.6e0))", 1)}
          AS shelf_hours_left,
        greatest(1e0, {rnd("km / 50e0", 1)}) AS diversion_hours,
        {rnd("km * 35e0 + 600e0", 0)} AS diversion_cost
      FROM (SELECT *, {rnd(
          "least(100e0, greatest(0e0,"
          " least(45e0, greatest(0e0, (warm - t_opt) / (t_crit - t_opt) * 45e0))"
          " + least(20e0, greatest(0e0, abs(humidity_pct - 90e0) / 20e0 * 20e0))"
          " + least(15e0, greatest(0e0, (vibration_g - 0.1e0) / 0.35e0 * 15e0))"
          " + least(20e0, alerts * 4e0)))", 1)} AS score
        FROM (SELECT container_id, commodity, quantity_kg, temperature_c + step AS warm, humidity_pct,
            vibration_g, anomaly_count AS alerts, km, t_opt, t_crit, shelf, typical
          FROM features, unnest([-4e0, -2e0, 0e0, 2e0, 4e0]) x(step),
            (SELECT CAST(km AS DOUBLE) AS km FROM generate_series(50, 600, 50) g(km)) y
          WHERE back = 1)))))"""

SOURCE_ROUTES = f"""
SELECT r.route_id, r.origin, r.destination, {rnd("r.distance_km * 1.01e0", 2)} AS distance_km,
  {rnd(rnd("r.distance_km * 1.01e0", 2) + " / s.speed", 2)} AS estimated_transit_hours, r.toll_cost_inr,
  r.road_condition_index
FROM ref_route r JOIN (SELECT origin, destination, avg(speed_kmh) AS speed FROM tele GROUP BY ALL) s
  ON s.origin = r.origin AND s.destination = r.destination"""

BODIES = {
    "spoilage_arbitrage": "SELECT * FROM mart",
    "container_health": "SELECT * FROM health",
    "spoilage_risk": "SELECT * FROM risk",
    "market_options": f"""SELECT * REPLACE ({rnd("projected_spoilage_rate", 6)}
      AS projected_spoilage_rate) FROM options""",
    "fct_container_health": "SELECT * FROM readings",
    "dim_container": "SELECT * FROM containers",
    "dim_market": "SELECT * FROM merged_markets",
    "dim_reference": """
      SELECT 'market' AS kind, market_name AS "name", (SELECT count(*) FROM tele
        WHERE destination = market_name) AS readings FROM ref_market
      UNION ALL SELECT 'price', market || '/' || commodity, (SELECT count(*) FROM tele t
        WHERE t.destination = p.market AND t.commodity = p.commodity) FROM ref_price p
      UNION ALL SELECT 'route', origin || '/' || destination, (SELECT count(*) FROM tele t
        WHERE t.origin = r.origin AND t.destination = r.destination) FROM ref_route r
      UNION ALL SELECT 'commodity', commodity, (SELECT count(*) FROM tele t
        WHERE t.commodity = c.commodity) FROM ref_kind c""",
    "raw_defaults": f"""
      SELECT CASE WHEN event_id % 11 = 0 THEN md5(container_id || '|' || {iso('"timestamp"')})
          ELSE record_id END AS record_id,
        CASE WHEN event_id % 4 = 0 THEN TIMESTAMP '{AS_OF}' ELSE ingestion_timestamp END
          AS ingestion_timestamp, "timestamp", container_id, shipment_id, commodity,
        CAST(CAST(temperature_c AS DECIMAL(5,2)) AS DOUBLE) AS temperature_c,
        CAST(CAST(humidity_pct AS DECIMAL(5,2)) AS DOUBLE) AS humidity_pct,
        CAST(CAST(vibration_g AS DECIMAL(5,2)) AS DOUBLE) AS vibration_g,
        CAST(CAST(latitude AS DECIMAL(9,6)) AS DOUBLE) AS latitude,
        CAST(CAST(longitude AS DECIMAL(9,6)) AS DOUBLE) AS longitude, origin, destination,
        quantity_kg, CASE WHEN event_id % 5 <> 0 THEN speed_kmh END AS speed_kmh,
        event_id % 6 <> 0 AND door_open AS door_open,
        CASE WHEN event_id % 8 = 0 THEN 'NORMAL' ELSE compressor_status END AS compressor_status,
        CASE WHEN event_id % 9 = 0 THEN 'NORMAL' ELSE anomaly_mode END AS anomaly_mode FROM tele""",
    "src_json": EVENT_TEXT,
    "src_csv_prices": """
      SELECT trim(market) AS market, commodity, CAST(CAST(price_per_kg AS DECIMAL(10,2)) AS DOUBLE) AS price_per_kg,
        CAST(NULL AS VARCHAR) AS currency, last_updated FROM quotes""",
    "src_csv_markets": """
      SELECT trim(market_id) AS market_id, trim(market_name) AS market_name,
        CAST(CAST(latitude AS DECIMAL(9,6)) AS DOUBLE) AS latitude, CAST(CAST(longitude AS DECIMAL(9,6)) AS DOUBLE) AS longitude,
        trim(state) AS state, trim(tier) AS tier, CAST(NULL AS DOUBLE) AS handling_fee_pct,
        CAST(CAST(cold_storage_capacity_tons AS DECIMAL(10,0)) AS DOUBLE) AS cold_storage_capacity_tons
      FROM registrations""",
    "src_csv_routes": """
      SELECT 'RT_' || trim(origin) || '_' || trim(destination) AS route_id, trim(origin) AS origin,
        trim(destination) AS destination, CAST(CAST(distance_km AS DECIMAL(8,2)) AS DOUBLE) AS distance_km,
        CAST(CAST(estimated_transit_hours AS DECIMAL(6,2)) AS DOUBLE) AS estimated_transit_hours,
        CAST(CAST(toll_cost_inr AS DECIMAL(10,2)) AS DOUBLE) AS toll_cost_inr,
        CAST(CAST(road_condition_index AS DECIMAL(4,2)) AS DOUBLE) AS road_condition_index FROM surveys""",
    "stg_telemetry": f"SELECT {STAGED}, ingestion_timestamp, {FLAGS} FROM staged_raw",
    "stg_prices": "SELECT * FROM good_quotes",
    "stg_markets": """
      SELECT trim(market_id) AS market_id, trim(market_name) AS market_name, latitude, longitude,
        trim(state) AS state, trim(tier) AS tier, coalesce(handling_fee_pct, 0.02e0) AS handling_fee_pct,
        CAST(coalesce(cold_storage_capacity_tons, 3000) AS BIGINT) AS cold_storage_capacity_tons
      FROM registrations WHERE market_id IS NOT NULL""",
    "stg_routes": """
      SELECT trim(route_id) AS route_id, trim(origin) AS origin, trim(destination) AS destination,
        distance_km, estimated_transit_hours, coalesce(toll_cost_inr, 0e0) AS toll_cost_inr,
        coalesce(road_condition_index, 0.85e0) AS road_condition_index
      FROM surveys WHERE route_id IS NOT NULL""",
    "alert_flags": f"SELECT record_id, commodity, {FLAGS} FROM staged",
    "kafka_payload": f"""SELECT container_id AS "key", '{{"timestamp":"' || {iso('"timestamp"')}
      || '",' || substr({PAYLOAD}, 2) AS value FROM tele""",
    "sink_append": EVENT_ROWS,
    "sink_json": EVENT_TEXT,
    "seed_readings": f"""
      SELECT record_id, ingestion_timestamp, "timestamp", {EVENT} FROM tele
      UNION ALL SELECT 'SEED_' || container_id || '_' || substr(t, 12, 2), CAST(t AS TIMESTAMP),
        CAST(t AS TIMESTAMP), {EVENT}
      FROM (VALUES {", ".join(
          "(" + ", ".join(
              f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)" if isinstance(v, float)
              else str(v) for v in row) + ")"
          for row in ref.SEED_READINGS)}) s(t, {EVENT})""",
    "upsert_markets": "SELECT * FROM merged_markets",
    "upsert_prices": f"""
      SELECT market, commodity, coalesce(q.price_per_kg, p.price_per_kg) AS price_per_kg,
        CASE WHEN p.market IS NULL THEN q.currency ELSE 'INR' END AS currency,
        coalesce(q.price_timestamp, TIMESTAMP '2026-09-21 06:00:00') AS last_updated
      FROM ref_price p FULL JOIN (SELECT * FROM (SELECT *, row_number() OVER (
          PARTITION BY market, commodity ORDER BY price_timestamp DESC, price_per_kg DESC) AS rn
        FROM good_quotes) WHERE rn = 1) q USING (market, commodity)""",
    "upsert_routes": f"""
      SELECT * FROM ({SOURCE_ROUTES})
      UNION ALL SELECT route_id || '_R', destination, origin, distance_km, estimated_transit_hours,
        toll_cost_inr, road_condition_index FROM ({SOURCE_ROUTES})
      UNION ALL SELECT * EXCLUDE (i) FROM ref_route r WHERE NOT EXISTS (
        SELECT 1 FROM tele t WHERE t.origin = r.origin AND t.destination = r.destination)""",
    "mart_materialize": "SELECT * FROM mart",
    "mart_materialize_containers": "SELECT * FROM containers",
    "mart_materialize_markets": """SELECT market_id, market_name, latitude, longitude, state, tier, handling_fee_pct,
      CAST(cold_storage_capacity_tons AS BIGINT) AS cold_storage_capacity_tons FROM ref_market""",
    "mart_materialize_readings": "SELECT * FROM readings",
    "export_telemetry": """
      SELECT "timestamp" AS recorded_at, container_id, shipment_id, commodity, temperature_c,
        humidity_pct, vibration_g, latitude, longitude, origin, destination, quantity_kg FROM tele""",
    "export_health": """
      SELECT container_id, shipment_id, commodity, latitude, longitude, temperature_c, humidity_pct,
        vibration_g, spoilage_risk_score, risk_level, time_to_spoilage_hours FROM desk_rows""",
    "export_arbitrage": """
      SELECT * EXCLUDE (current_price, recommended_price, "action"),
        current_price AS current_dest_price_per_kg, recommended_price AS recommended_market_price,
        "action" AS recommendation_action FROM desk_rows""",
    "export_bundle": """
      SELECT 'stg_sensor_telemetry' AS table_name, count(*) AS row_count FROM tele
      UNION ALL SELECT 'fct_container_health', count(*) FROM desk_rows
      UNION ALL SELECT 'fct_spoilage_arbitrage', count(*) FROM desk_rows
      UNION ALL SELECT 'dim_commodity_prices', count(*) FROM ref_price
      UNION ALL SELECT 'dim_markets', count(*) FROM ref_market
      UNION ALL SELECT 'dim_routes', count(*) FROM ref_route""",
    "export_contents": """
      SELECT 'stg_sensor_telemetry' AS table_name, container_id AS name, commodity AS says,
        CAST(temperature_c AS DOUBLE) AS amount, CAST(quantity_kg AS DOUBLE) AS other_amount FROM tele
      UNION ALL SELECT 'fct_container_health', container_id, risk_level, CAST(spoilage_risk_score AS DOUBLE),
        CAST(time_to_spoilage_hours AS DOUBLE) FROM desk_rows
      UNION ALL SELECT 'fct_spoilage_arbitrage', container_id, action, CAST(spoilage_arbitrage_inr AS DOUBLE),
        CAST(reroute_expected_value AS DOUBLE) FROM desk_rows
      UNION ALL SELECT 'dim_commodity_prices', market, commodity, CAST(price_per_kg AS DOUBLE), CAST(price_per_kg AS DOUBLE) FROM ref_price
      UNION ALL SELECT 'dim_markets', market_id, market_name, CAST(latitude AS DOUBLE), CAST(longitude AS DOUBLE) FROM ref_market
      UNION ALL SELECT 'dim_routes', route_id, destination, CAST(distance_km AS DOUBLE),
        CAST(estimated_transit_hours AS DOUBLE) FROM ref_route""",
    "export_results": "SELECT * FROM desk_rows",
    "decision_report": "SELECT container_id, commodity, "
    + ", ".join(
        f"{float_text(c)} || '{unit}' AS {c}"
        for c, unit in [
            ("temperature_c", "°C"), ("humidity_pct", "%"), ("vibration_g", "g"),
            ("spoilage_risk_score", "/100"), ("time_to_spoilage_hours", " hrs"),
        ]
    )
    + ", "
    + ", ".join(
        f"'INR ' || {sign} || format('{{:,}}', CAST(round_even(CAST({c} AS DECIMAL(20,2)), 0) AS BIGINT))"
        f" AS {c}"
        for c, sign in [
            ("current_expected_value", "''"), ("potential_loss", "''"),
            ("reroute_expected_value", "''"), ("reroute_cost", "''"),
            ("spoilage_arbitrage_inr", "CASE WHEN spoilage_arbitrage_inr >= -0.5 THEN '+' ELSE '' END"),
        ]
    )
    + """, risk_level, current_destination, recommended_destination, "action" FROM desk_rows""",
    "validate_events": """
      SELECT record_id, CASE WHEN event_id % 53 <> 0 THEN container_id END AS container_id,
        parsed_temp AS temperature_c, CAST(CASE WHEN event_id % 53 <> 0 THEN quantity_kg END AS DOUBLE) AS quantity_kg,
        cause = '' AS is_valid, cause FROM messages""",
    "dead_letters": """SELECT record_id, "key", raw_payload, cause FROM messages WHERE cause <> ''""",
    "dedup_telemetry": """
      SELECT record_id, ingestion_timestamp, "timestamp", container_id, shipment_id, commodity, temperature_c,
        humidity_pct, vibration_g, latitude, longitude, origin, destination, quantity_kg, speed_kmh, door_open,
        compressor_status, anomaly_mode FROM corrected""",
    "dq_not_null": NOT_NULL,
    "dq_unique": UNIQUE,
    "dq_accepted_values": ACCEPTED,
    "dq_reroute_gain": """
      SELECT 'reroute without gain' AS check_name,
        count(*) FILTER (is_reroute_recommended AND spoilage_arbitrage_inr <= 0) AS failures FROM mart_raw
      UNION ALL SELECT 'score out of range',
        count(*) FILTER (NOT spoilage_risk_score BETWEEN 0 AND 100) FROM mart_raw""",
    "kpi_active": "SELECT count(DISTINCT container_id) AS total_active_containers FROM mart",
    "kpi_at_risk": """SELECT count(DISTINCT container_id) AS containers_at_risk FROM mart
      WHERE risk_category IN ('High Risk', 'Critical Risk')""",
    "kpi_critical": """SELECT count(DISTINCT container_id) AS critical_containers FROM mart
      WHERE risk_category = 'Critical Risk'""",
    "kpi_avg_temp": f"SELECT {rnd('avg(temperature_c)', 1)} AS avg_temperature_c FROM readings",
    "kpi_avg_humidity": f"SELECT {rnd('avg(humidity_pct)', 1)} AS avg_humidity_pct FROM readings",
    "kpi_arbitrage": f"""SELECT {rnd("sum(spoilage_arbitrage_inr)", 0)}
      AS total_arbitrage_opportunity_inr FROM mart WHERE is_reroute_recommended""",
    "kpi_loss_avoided": f"""SELECT {rnd("sum(spoilage_avoided_value_inr)", 0)}
      AS total_loss_avoided_inr FROM mart WHERE is_reroute_recommended""",
    "kpi_executive": EXECUTIVE,
    "kpi_executive_fixed": EXECUTIVE_ONCE,
    "chart_map": """
      SELECT container_id, shipment_id, commodity, latitude, longitude, risk_category,
        spoilage_risk_score, time_to_spoilage_hours, current_destination, recommended_destination,
        spoilage_arbitrage_inr, is_reroute_recommended FROM mart""",
    "chart_temp": """
      SELECT telemetry_timestamp, container_id, commodity, temperature_c, is_temperature_alert
      FROM readings ORDER BY telemetry_timestamp NULLS LAST, record_id""",
    "chart_humidity": """
      SELECT telemetry_timestamp, container_id, commodity, humidity_pct, is_humidity_alert
      FROM readings ORDER BY telemetry_timestamp NULLS LAST, record_id""",
    "chart_leaderboard": """
      SELECT container_id || ' (' || commodity || ')' AS container_label, container_id, commodity,
        spoilage_risk_score, risk_category, time_to_spoilage_hours FROM mart
      ORDER BY spoilage_risk_score DESC NULLS LAST, container_id""",
    "chart_matrix": """
      SELECT container_id AS container, commodity AS cargo, risk_category AS risk_state,
        time_to_spoilage_hours AS shelf_life_hrs, current_destination AS current_dest,
        current_expected_value_inr AS current_nrv, recommended_destination AS recommended_dest,
        reroute_expected_value_inr AS reroute_nrv, spoilage_arbitrage_inr AS arbitrage_benefit,
        recommendation_reason AS trader_recommendation FROM mart
      ORDER BY spoilage_arbitrage_inr DESC NULLS LAST, container_id""",
    "chart_revenue": """
      SELECT container_id, commodity, current_expected_value_inr AS current_planned_destination,
        reroute_expected_value_inr AS alternative_rerouted_destination,
        spoilage_arbitrage_inr AS net_arbitrage_uplift FROM mart ORDER BY container_id""",
    "chart_corridor_bubble": f"""
      SELECT container_id, commodity, candidate_market AS destination, distance_km,
        estimated_transit_hours, {rnd("projected_spoilage_rate * 100e0", 1)} AS projected_spoilage_pct,
        quantity_kg, is_feasible_within_shelf_life FROM options""",
    "vd_fleet": """
      SELECT f.*, m.state AS destination_state, m.tier AS destination_market_tier,
        m.cold_storage_capacity_tons
      FROM mart f LEFT JOIN ref_market m ON f.recommended_destination = m.market_name""",
    "vd_commodity_var": f"""
      SELECT commodity, count(DISTINCT container_id) AS total_containers,
        CAST(sum(quantity_kg) AS BIGINT) AS total_cargo_kg,
        {rnd("avg(spoilage_risk_score)", 1)} AS avg_spoilage_risk,
        CAST(sum(CASE WHEN risk_category IN ('High Risk', 'Critical Risk') THEN 1 ELSE 0 END) AS BIGINT)
          AS at_risk_container_count,
        {rnd("sum(current_expected_value_inr)", 0)} AS total_current_nrv_inr,
        {rnd("sum(current_potential_loss_inr)", 0)} AS total_potential_loss_inr,
        {rnd("sum(" + GAIN.format("spoilage_arbitrage_inr") + ")", 0)} AS total_reroute_arbitrage_inr,
        {rnd("sum(" + GAIN.format("spoilage_avoided_value_inr") + ")", 0)}
          AS total_spoilage_prevented_inr
      FROM mart GROUP BY commodity""",
    "vd_corridor": f"""
      SELECT r.route_id, r.origin, r.destination, r.distance_km, r.estimated_transit_hours,
        r.toll_cost_inr, r.road_condition_index,
        count(DISTINCT h.container_id) AS active_shipments_in_corridor,
        {rnd("avg(h.temperature_c)", 1)} AS avg_corridor_temp_c,
        {rnd("avg(h.humidity_pct)", 1)} AS avg_corridor_humidity_pct
      FROM ref_route r LEFT JOIN readings h ON r.origin = h.origin AND r.destination = h.destination
      GROUP BY ALL""",
    "alert_feed": f"""
      SELECT record_id, telemetry_timestamp, container_id, commodity, origin, destination, temperature_c,
        humidity_pct, vibration_g, compressor_status, door_open, {FLAGS}, instant_risk_score,
        instant_risk_category FROM readings
      WHERE 1 IN ({FLAGS}) ORDER BY telemetry_timestamp DESC NULLS LAST, record_id""",
    "dispatch_manifest": f"""
      SELECT container_id, shipment_id, commodity, quantity_kg, f.latitude AS current_latitude,
        f.longitude AS current_longitude, current_destination, recommended_destination,
        m.latitude AS target_market_lat, m.longitude AS target_market_lon, m.state AS target_state,
        m.tier AS target_tier, reroute_distance_km, reroute_transit_hours,
        time_to_spoilage_hours AS remaining_shelf_life_hours,
        {rnd("spoilage_arbitrage_inr", 0)} AS net_arbitrage_profit_inr, recommendation_reason
      FROM mart f JOIN ref_market m ON f.recommended_destination = m.market_name
      WHERE is_reroute_recommended""",
    "audit_trail": """
      SELECT record_id, telemetry_timestamp, container_id, shipment_id, commodity, temperature_c,
        humidity_pct, vibration_g, latitude, longitude, speed_kmh, door_open, compressor_status,
        anomaly_mode, instant_risk_score, instant_risk_category FROM readings
      ORDER BY container_id, telemetry_timestamp NULLS LAST, record_id""",
    "filter_fleet": """
      SELECT * FROM risk WHERE commodity IN ('Avocado', 'Banana', 'Tomato')
        AND destination IN ('Mumbai', 'Hyderabad') AND risk_category IN ('High Risk', 'Critical Risk')""",
    "filter_recent": """
      SELECT * FROM readings WHERE telemetry_timestamp
        > (SELECT max(telemetry_timestamp) FROM readings) - INTERVAL 24 HOUR""",
    "filter_text": """
      SELECT * FROM dealings WHERE lower(container_id) LIKE '%pun%' OR lower(commodity) LIKE '%pun%'
        OR lower(recommended_market) LIKE '%pun%'""",
    "filter_bucket": """
      SELECT * FROM console_rows WHERE commodity = 'Mango'
        AND coalesce(spoilage_risk_score, 0) >= 50 AND coalesce(spoilage_risk_score, 0) < 75""",
    "filter_values": """
      SELECT DISTINCT 'container_id' AS filter_name, container_id AS filter_value FROM mart
      UNION ALL SELECT DISTINCT 'commodity', commodity FROM mart
      UNION ALL SELECT DISTINCT 'origin', origin FROM readings
      UNION ALL SELECT DISTINCT 'destination', destination FROM readings""",
    "filter_values_risk": """
      SELECT DISTINCT risk_category, CASE risk_category WHEN 'Critical Risk' THEN 1 WHEN 'High Risk'
        THEN 2 WHEN 'Moderate Risk' THEN 3 WHEN 'Low Risk' THEN 4 ELSE 5 END AS severity_rank FROM mart
      ORDER BY severity_rank""",
    "critical_alerts": """
      SELECT alert_id, record_id, telemetry_timestamp AS "timestamp", container_id, shipment_id,
        commodity, CASE WHEN reason1 IS NULL THEN 0 ELSE 1 END + CASE WHEN reason2 IS NULL
        THEN 0 ELSE 1 END + CASE WHEN reason3 IS NULL THEN 0 ELSE 1 END AS reason_count,
        concat_ws(' | ', reason1, reason2, reason3) AS reason_line, temperature_c, humidity_pct, vibration_g,
        latitude, longitude FROM alarms""",
    "risk_transitions": "SELECT * FROM turned",
    "rolling_features": f"""
      SELECT record_id, container_id, telemetry_timestamp, commodity,
        {rnd("avg_temp", 2)} AS rolling_avg_temp, {rnd("avg_hum", 2)} AS rolling_avg_hum, anomaly_count
      FROM features""",
    "rolling_risk": "SELECT * FROM risk_rows",
    "rolling_decision": "SELECT * FROM desk_rows",
    "rolling_decision_catalogue": "SELECT * FROM catalogue_rows",
    "reading_status": """
      SELECT record_id, container_id, telemetry_timestamp, temperature_c,
        CASE WHEN temperature_c <= 8 THEN 'OPTIMAL' WHEN temperature_c <= 12 THEN 'WARNING'
          ELSE 'CRITICAL RISK' END AS status FROM staged""",
    "history_series": "SELECT * FROM series",
    "console_table": "SELECT * FROM console_rows",
    "console_kpis": "SELECT * FROM fleet_kpis",
    "console_document": DOCUMENT,
    "reroute_overrides": """
      SELECT container_id, is_rerouted, "action", destination,
        replace(destination, ' (Rerouted)', '') AS destination_market FROM fleet""",
    "scenario_sweep": SCENARIO,
    "stream_ingest": """
      SELECT 'valid' AS sink, record_id, commodity AS detail FROM messages WHERE cause = ''
      UNION ALL SELECT 'dead', record_id, cause FROM messages WHERE cause <> ''
      UNION ALL SELECT 'alerts', record_id, detail FROM message_alarms""",
    "stream_alerts": ALERT_JSON,
    "stream_dedup": """
      SELECT record_id, ingestion_timestamp, "timestamp", container_id, shipment_id, commodity, temperature_c,
        humidity_pct, vibration_g, latitude, longitude, origin, destination, quantity_kg, speed_kmh, door_open,
        compressor_status, anomaly_mode FROM corrected""",
    "stream_dedup_table": """
      SELECT record_id, ingestion_timestamp, "timestamp", container_id, shipment_id, commodity, temperature_c,
        humidity_pct, vibration_g, latitude, longitude, origin, destination, quantity_kg, speed_kmh, door_open,
        compressor_status, anomaly_mode FROM corrected WHERE event_id % 59 <> 0
      UNION ALL SELECT * REPLACE (NULL AS "timestamp") FROM (
        SELECT record_id, ingestion_timestamp, "timestamp", container_id, shipment_id, commodity, temperature_c,
        humidity_pct, vibration_g, latitude, longitude, origin, destination, quantity_kg, speed_kmh, door_open,
        compressor_status, anomaly_mode FROM corrections WHERE event_id % 59 = 0)""",
    "stream_rolling": "SELECT * FROM risk_rows",
    "stream_transitions": "SELECT * FROM turned",
    "stream_latest": f"""SELECT {STAGED} FROM (SELECT *, row_number() OVER (PARTITION BY container_id
      ORDER BY telemetry_timestamp DESC, record_id DESC) AS rn FROM staged) WHERE rn = 1""",
    "stream_marts": "SELECT * FROM mart",
}

ORACLE = {name: query(body) for name, body in BODIES.items()}
