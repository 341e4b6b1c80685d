"""Building blocks of the checking SQL: reference rows and named table expressions."""

from __future__ import annotations

import re

from frostline.sources import reference as ref


def lit(value) -> str:
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def values(name: str, columns: str, rows: list[tuple]) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def rnd(x: str, places: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {places}) AS DOUBLE)"


def dec(x: str, places: int) -> str:
    return f"CAST(CAST({x} AS DECIMAL(20,{places})) AS VARCHAR)"


def float_text(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(18,3)) AS VARCHAR), '0{{1,2}}$', '')"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%f')"


PARTS: dict[str, str] = {}


def part(name: str, body: str) -> None:
    PARTS[name] = f"{name} AS ({body})"


def query(body: str) -> str:
    """The statement with every table expression it needs, in order of definition."""
    needed, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name in PARTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(PARTS[name])
    listed = ",\n".join(PARTS[n] for n in PARTS if n in needed)
    return f"WITH {listed}\n{body}" if listed else body


# Reference rows

PARTS["ref_market"] = values(
    "ref_market",
    "market_id, market_name, latitude, longitude, state, tier, handling_fee_pct,"
    " cold_storage_capacity_tons",
    ref.MARKETS,
)
PARTS["ref_price"] = values(
    "ref_price", "market, commodity, price_per_kg", ref.price_rows(ref.KINETIC_PRICES)
)
PARTS["ref_route"] = values(
    "ref_route",
    "i, route_id, origin, destination, distance_km, estimated_transit_hours, toll_cost_inr,"
    " road_condition_index",
    [(i, *r) for i, r in enumerate(ref.ROUTES)],
)
PARTS["ref_kind"] = values(
    "ref_kind",
    "i, commodity, lo, hi, centre, shelf, t_lo, t_hi, h_lo, h_hi",
    [(i, *e, *b[1:]) for i, (e, b) in enumerate(zip(ref.ENVELOPES, ref.ALERT_BANDS))],
)
PARTS["ref_spec"] = values(
    "ref_spec",
    "commodity, t_opt, t_min, t_max, t_crit, h_min, h_max, v_max, shelf, typical",
    ref.SPECS,
)
PARTS["ref_schedule"] = values(
    "ref_schedule", "origin, destination, km, hours, toll", ref.SCHEDULED_ROUTES
)
PARTS["ref_place"] = values("ref_place", "market_name, latitude, longitude, state", ref.CONSOLE_MARKETS)
PARTS["near_market"] = values(
    "near_market", "market, km, hours, toll", [(m, *d) for m, d in ref.DIVERSION_NEAR.items()]
)
for _name, _desk in (("desk", ref.DESK), ("catalogue", ref.CATALOGUE_DESK), ("console", ref.CONSOLE_DESK)):
    PARTS[f"{_name}_price"] = values(
        f"{_name}_price", "market, commodity, price", ref.price_rows(_desk.prices)
    )
    # Unlisted markets value a cargo at its typical price, an unknown cargo like the fallback one.
    PARTS[f"{_name}_candidate"] = values(f"{_name}_candidate", "pos, market", list(enumerate(_desk.candidates)))
    part(
        f"{_name}_offer",
        f"""
        SELECT c.pos, c.market, k.commodity, coalesce(p.price, k.typical) AS price,
          coalesce(n.km, {ref.DIVERSION_OTHER[0]!r}e0) AS km, coalesce(n.hours, {ref.DIVERSION_OTHER[1]!r}e0) AS hours,
          coalesce(n.toll, {ref.DIVERSION_OTHER[2]!r}e0) AS toll
        FROM {_name}_candidate c
        CROSS JOIN (SELECT commodity, typical FROM ref_spec
          UNION ALL SELECT '{ref.UNKNOWN}', typical FROM ref_spec WHERE commodity = '{ref.FALLBACK_COMMODITY}') k
        LEFT JOIN {_name}_price p ON p.market = c.market AND p.commodity = k.commodity
        LEFT JOIN near_market n ON n.market = c.market""",
    )

# Readings

part(
    "ev",
    "SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events",
)
part(
    "tele",
    f"""
    SELECT 'REC_' || event_id AS record_id, e.ts AS ingestion_timestamp, e.ts AS "timestamp",
      'CONT_' || user_id AS container_id, 'SHIP_' || user_id AS shipment_id, c.commodity,
      c.centre + ((event_id * 7 + k) % 121 - 40) / 10e0 AS temperature_c,
      72e0 + ((event_id * 13 + k) % 280) / 10e0 AS humidity_pct,
      ((event_id * 17 + k) % 45) / 100e0 AS vibration_g,
      {rnd("o.latitude + (d.latitude - o.latitude) * (k % 100) / 100e0", 4)} AS latitude,
      {rnd("o.longitude + (d.longitude - o.longitude) * (k % 100) / 100e0", 4)} AS longitude,
      r.origin, r.destination, CAST(8000 + 1000 * r.i AS BIGINT) AS quantity_kg,
      CAST(20 + event_id % 60 AS DOUBLE) AS speed_kmh, event_type = 'signup' AS door_open,
      CASE WHEN event_type <> 'error' THEN 'NORMAL' WHEN k % 2 = 0 THEN 'FAILURE'
        ELSE 'DEGRADED' END AS compressor_status,
      CASE WHEN event_type = 'error' THEN 'REFRIGERATION_FAULT' ELSE 'NORMAL' END AS anomaly_mode,
      event_id, event_type, k
    FROM ev e
    JOIN ref_route r ON r.i = user_id % 11
    JOIN ref_kind c ON c.i = user_id % 5
    JOIN ref_market o ON o.market_name = r.origin
    JOIN ref_market d ON d.market_name = r.destination""",
)
part(
    "resent",
    """
    SELECT t.* REPLACE (ingestion_timestamp + to_minutes(n.n) AS ingestion_timestamp)
    FROM tele t JOIN (VALUES (0), (1), (2)) n(n)
      ON n.n < CASE WHEN event_id % 40 = 0 THEN 3 WHEN event_id % 10 = 0 THEN 2 ELSE 1 END""",
)
part(
    "corrected",
    """
    SELECT * EXCLUDE (last_copy) FROM (
      SELECT t.* REPLACE (ingestion_timestamp + to_minutes(n.n) AS ingestion_timestamp,
          temperature_c + n.n * 0.5e0 AS temperature_c),
        n.n = max(n.n) OVER (PARTITION BY event_id) AS last_copy
      FROM tele t JOIN (VALUES (0), (1), (2)) n(n)
        ON n.n < CASE WHEN event_id % 40 = 0 THEN 3 WHEN event_id % 10 = 0 THEN 2 ELSE 1 END)
    WHERE last_copy""",
)
part(
    "corrections",
    """
    SELECT t.* REPLACE (ingestion_timestamp + to_minutes(n.n) AS ingestion_timestamp,
      temperature_c + n.n * 0.5e0 AS temperature_c)
    FROM tele t JOIN (VALUES (0), (1), (2)) n(n)
      ON n.n < CASE WHEN event_id % 40 = 0 THEN 3 WHEN event_id % 10 = 0 THEN 2 ELSE 1 END""",
)
part(
    "landed",
    f"""
    SELECT * REPLACE (
      CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 'not a time'
        ELSE {iso('"timestamp"')} || CASE WHEN event_id % 2 = 0 THEN 'Z' ELSE '+00:00' END
        END AS "timestamp",
      CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '  ' || container_id || ' '
        ELSE container_id END AS container_id,
      CASE WHEN event_id % 71 = 0 THEN 'Durian' ELSE commodity || ' ' END AS commodity,
      CASE WHEN event_id % 67 = 0 THEN NULL ELSE temperature_c END AS temperature_c,
      CASE WHEN event_id % 5 = 0 THEN NULL ELSE speed_kmh END AS speed_kmh,
      CASE WHEN event_id % 6 = 0 THEN NULL ELSE door_open END AS door_open,
      CASE WHEN event_id % 8 = 0 THEN NULL ELSE ' ' || compressor_status END AS compressor_status,
      CASE WHEN event_id % 9 = 0 THEN NULL ELSE anomaly_mode END AS anomaly_mode)
    FROM resent""",
)

# Kinetic model, over clean readings and over landed ones

BAND = """CASE WHEN {0} <= 25 THEN 'Low Risk' WHEN {0} <= 50 THEN 'Moderate Risk'
      WHEN {0} <= 75 THEN 'High Risk' ELSE 'Critical Risk' END"""
COMPRESSOR = """CASE compressor_status WHEN 'FAILURE' THEN 25e0 WHEN 'DEGRADED' THEN 12e0
      ELSE 0e0 END"""
STAGED = """record_id, telemetry_timestamp, container_id, shipment_id, commodity, temperature_c,
      humidity_pct, vibration_g, latitude, longitude, origin, destination, quantity_kg, speed_kmh,
      door_open, compressor_status, anomaly_mode"""
FLAGS = "is_temperature_alert, is_humidity_alert, is_vibration_alert, is_mechanical_alert"
NEWEST = "ORDER BY telemetry_timestamp DESC NULLS LAST, record_id DESC NULLS LAST"


def kinetic_parts(s: str, source: str) -> None:
    part(
        f"staged{s}",
        f"""
    SELECT t.*,
      CASE WHEN temperature_c < t_lo OR temperature_c > t_hi THEN 1 ELSE 0 END AS is_temperature_alert,
      CASE WHEN humidity_pct < h_lo OR humidity_pct > h_hi THEN 1 ELSE 0 END AS is_humidity_alert,
      CASE WHEN vibration_g >= 0.2e0 THEN 1 ELSE 0 END AS is_vibration_alert,
      CASE WHEN compressor_status IN ('DEGRADED', 'FAILURE') OR vibration_g >= 0.25e0 THEN 1
        ELSE 0 END AS is_mechanical_alert
    FROM (
      SELECT record_id, TRY_CAST("timestamp" AS TIMESTAMP) AS telemetry_timestamp,
        trim(container_id) AS container_id, shipment_id, trim(commodity) AS commodity, temperature_c,
        humidity_pct, vibration_g, latitude, longitude, origin, destination, quantity_kg,
        coalesce(speed_kmh, 50e0) AS speed_kmh, coalesce(door_open, FALSE) AS door_open,
        coalesce(trim(compressor_status), 'NORMAL') AS compressor_status,
        coalesce(anomaly_mode, 'NORMAL') AS anomaly_mode, ingestion_timestamp
      FROM {source} WHERE container_id IS NOT NULL AND "timestamp" IS NOT NULL) t
    LEFT JOIN ref_kind USING (commodity)""".replace(
            "SELECT t.*,",
            f"SELECT {STAGED}, ingestion_timestamp,",
        ),
    )
    part(
        f"health{s}",
        f"""
    SELECT {STAGED}, {FLAGS}, coalesce(centre, 10e0) AS optimal_temp_center,
      coalesce(hi, 12e0) AS optimal_temp_max, coalesce(lo, 8e0) AS optimal_temp_min,
      coalesce(shelf, 168e0) AS baseline_shelf_life_hours,
      CASE WHEN temperature_c IS NOT NULL THEN greatest(0e0, temperature_c - coalesce(hi, 12e0),
        coalesce(lo, 8e0) - temperature_c) END AS temp_excursion_c
    FROM (SELECT *, row_number() OVER (PARTITION BY container_id {NEWEST}) AS rn FROM staged{s})
    LEFT JOIN ref_kind USING (commodity) WHERE rn = 1""",
    )
    part(
        f"risk{s}",
        f"""
    SELECT * EXCLUDE (raw, door_open, {FLAGS}, optimal_temp_center, optimal_temp_max, optimal_temp_min),
      {rnd("raw", 1)} AS spoilage_risk_score,
      {BAND.format("raw")} AS risk_category,
      CASE WHEN raw IS NOT NULL THEN {rnd(
          "greatest(1e0, baseline_shelf_life_hours * pow(greatest(0.01e0, 1e0 - raw / 100e0), 1.85e0))",
          1)} END AS time_to_spoilage_hours
    FROM (SELECT *, CASE WHEN temp_excursion_c IS NOT NULL AND vibration_g IS NOT NULL THEN
        least(100e0, greatest(0e0, least(50e0, temp_excursion_c * 8.5e0)
          + CASE WHEN is_humidity_alert = 1 THEN 20e0 ELSE 0e0 END
          + least(20e0, greatest(0e0, (vibration_g - 0.15e0) * 60e0)) + {COMPRESSOR})) END AS raw
      FROM health{s})""",
    )
    part(
        f"options{s}",
        f"""
    SELECT *, {rnd("quantity_kg * candidate_price_per_kg * (1e0 - projected_spoilage_rate)", 2)}
        AS projected_gross_value_inr,
      {rnd("quantity_kg * candidate_price_per_kg * (1e0 - projected_spoilage_rate)"
           " - estimated_freight_cost_inr", 2)} AS net_realizable_value_inr
    FROM (SELECT *,
        CASE WHEN estimated_transit_hours >= time_to_spoilage_hours THEN
          least(1e0, 0.35e0 + 0.65e0 * (estimated_transit_hours - time_to_spoilage_hours)
            / estimated_transit_hours)
          ELSE {rnd("spoilage_risk_score / 100e0 * 0.15e0", 3)} END AS projected_spoilage_rate,
        CASE WHEN estimated_transit_hours < time_to_spoilage_hours THEN 1 ELSE 0 END
          AS is_feasible_within_shelf_life
      FROM (SELECT *,
          {rnd("greatest(0.5e0, distance_km / greatest(25e0, speed_kmh))", 1)}
            AS estimated_transit_hours,
          {rnd("distance_km * 0.015e0 * quantity_kg", 2)} AS estimated_freight_cost_inr
        FROM (SELECT c.container_id, c.shipment_id, c.commodity, c.origin,
            c.destination AS current_destination, c.quantity_kg, c.latitude AS current_lat,
            c.longitude AS current_lon, c.speed_kmh, c.spoilage_risk_score, c.risk_category,
            c.time_to_spoilage_hours, m.market_id AS candidate_market_id,
            m.market_name AS candidate_market, m.latitude AS candidate_lat,
            m.longitude AS candidate_lon, m.tier AS market_tier,
            p.price_per_kg AS candidate_price_per_kg,
            {rnd("111e0 * sqrt(pow(m.latitude - c.latitude, 2) + pow((m.longitude - c.longitude)"
                 " * cos(c.latitude * 3.14159265359e0 / 180e0), 2))", 1)} AS distance_km
          FROM risk{s} c CROSS JOIN ref_market m
          JOIN ref_price p ON p.market = m.market_name AND p.commodity = c.commodity
          WHERE m.market_name <> c.origin)))""",
    )
    uplift = "a.net_realizable_value_inr - c.net_realizable_value_inr"
    loss = rnd("c.quantity_kg * c.candidate_price_per_kg * c.projected_spoilage_rate", 2)
    other_loss = "(c.quantity_kg * a.candidate_price_per_kg * a.projected_spoilage_rate)"
    part(
        f"mart{s}",
        f"""
    SELECT * EXCLUDE (uplift, feasible),
      coalesce(uplift > 1000 AND risk_category IN ('High Risk', 'Critical Risk') AND feasible = 1, FALSE)
        AS is_reroute_recommended,
      CASE WHEN uplift > 1000 AND risk_category IN ('High Risk', 'Critical Risk') AND feasible = 1
        THEN 'Closer terminal (' || recommended_destination || ' in '
          || regexp_replace(CAST(CAST(reroute_transit_hours AS DECIMAL(18,1)) AS VARCHAR), '\\.0$', '')
          || 'h) prevents decay; unlocks +'
          || CAST(CAST({rnd("uplift", 0)} AS DECIMAL(18,0)) AS VARCHAR) || ' INR net arbitrage.'
        WHEN risk_category IN ('High Risk', 'Critical Risk') AND feasible = 0
        THEN 'Critical deterioration but alternative terminal transit exceeds remaining shelf life. Expedite current delivery.'
        ELSE 'Conditions nominal. Proceed along primary planned corridor.' END AS recommendation_reason
    FROM (SELECT c.container_id, c.shipment_id, c.commodity, c.quantity_kg, c.current_lat AS latitude,
        c.current_lon AS longitude, c.spoilage_risk_score, c.risk_category, c.time_to_spoilage_hours,
        c.current_destination, c.estimated_transit_hours AS current_transit_hours,
        c.candidate_price_per_kg AS current_market_price,
        c.net_realizable_value_inr AS current_expected_value_inr,
        {loss} AS current_potential_loss_inr,
        a.candidate_market AS recommended_destination, a.distance_km AS reroute_distance_km,
        a.estimated_transit_hours AS reroute_transit_hours,
        a.candidate_price_per_kg AS reroute_market_price,
        a.estimated_freight_cost_inr AS reroute_freight_cost_inr,
        a.net_realizable_value_inr AS reroute_expected_value_inr,
        {rnd(f"CASE WHEN {uplift} IS NOT NULL THEN greatest(0e0, {uplift}) END", 2)}
          AS spoilage_arbitrage_inr,
        {rnd(f"CASE WHEN {loss} - {other_loss} IS NOT NULL THEN greatest(0e0, {loss} - {other_loss}) END", 2)}
          AS spoilage_avoided_value_inr,
        {uplift} AS uplift, a.is_feasible_within_shelf_life AS feasible
      FROM options{s} c JOIN (
        SELECT *, row_number() OVER (PARTITION BY container_id ORDER BY is_feasible_within_shelf_life
            DESC, net_realizable_value_inr DESC NULLS LAST, candidate_market) AS rn
        FROM options{s} WHERE candidate_market <> current_destination) a
        ON a.container_id = c.container_id AND a.rn = 1
      WHERE c.candidate_market = c.current_destination)""",
    )
    part(
        f"readings{s}",
        f"""
    SELECT *, {BAND.format("instant_risk_score")} AS instant_risk_category
    FROM (SELECT {STAGED}, {FLAGS}, least(100e0, is_temperature_alert * 45e0 + is_humidity_alert * 20e0
        + is_vibration_alert * 20e0 + {COMPRESSOR}) AS instant_risk_score FROM staged{s})""",
    )
    part(
        f"containers{s}",
        f"""
    SELECT container_id, shipment_id, commodity, quantity_kg, origin, destination, compressor_status,
      telemetry_timestamp AS last_reported_at
    FROM (SELECT *, row_number() OVER (PARTITION BY container_id {NEWEST}) AS rn FROM staged{s})
    WHERE rn = 1""",
    )


kinetic_parts("", "tele")
kinetic_parts("_raw", "landed")

# Feeds of prices, markets and routes

part(
    "quotes",
    f"""
    SELECT CASE WHEN event_id % 7 = 0 THEN ' ' || destination || ' ' ELSE destination END AS market,
      CASE WHEN event_id % 41 = 0 THEN NULL ELSE commodity END AS commodity,
      CAST((event_id * 3 + k) % 200 - 1 AS DOUBLE) AS price_per_kg,
      CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'INR ' END AS currency,
      CASE WHEN event_id % 19 = 0 THEN 'unknown' ELSE {iso('"timestamp"')} || 'Z' END AS last_updated
    FROM tele WHERE event_type = 'purchase'""",
)
part(
    "registrations",
    """
    SELECT CASE WHEN event_id % 23 = 0 THEN NULL ELSE ' MKT_' || upper(substr(destination, 1, 3)) END
        AS market_id, destination || '  ' AS market_name, latitude, longitude, ' State' AS state,
      'Tier-2 ' AS tier, CASE WHEN event_id % 2 = 0 THEN NULL ELSE k / 1000e0 END AS handling_fee_pct,
      CASE WHEN event_id % 3 = 0 THEN NULL ELSE k * 100 END AS cold_storage_capacity_tons
    FROM tele WHERE event_type = 'signup'""",
)
part(
    "surveys",
    """
    SELECT CASE WHEN event_id % 29 = 0 THEN NULL
        ELSE ' RT_' || t.origin || '_' || t.destination END AS route_id,
      ' ' || t.origin AS origin, t.destination || ' ' AS destination,
      r.distance_km + k % 10 AS distance_km, CAST(1 + k % 12 AS DOUBLE) AS estimated_transit_hours,
      CASE WHEN event_id % 4 = 0 THEN NULL ELSE k * 10e0 END AS toll_cost_inr,
      CASE WHEN event_id % 5 = 0 THEN NULL ELSE 0.5e0 + (k % 50) / 100e0 END AS road_condition_index
    FROM tele t JOIN ref_route r ON r.origin = t.origin AND r.destination = t.destination
    WHERE event_type = 'view'""",
)
part(
    "good_quotes",
    """
    SELECT trim(market) AS market, trim(commodity) AS commodity, price_per_kg,
      coalesce(trim(currency), 'INR') AS currency,
      coalesce(TRY_CAST(last_updated AS TIMESTAMP), TIMESTAMP '2024-01-01 00:00:00') AS price_timestamp
    FROM quotes WHERE market IS NOT NULL AND commodity IS NOT NULL AND price_per_kg > 0""",
)
part(
    "seen_markets",
    f"""
    SELECT destination AS market_name, {rnd("avg(latitude)", 4)} AS latitude,
      {rnd("avg(longitude)", 4)} AS longitude FROM tele GROUP BY destination""",
)
part(
    "merged_markets",
    """
    SELECT m.market_id, m.market_name, coalesce(s.latitude, m.latitude) AS latitude,
      coalesce(s.longitude, m.longitude) AS longitude, m.state, m.tier, m.handling_fee_pct,
      CAST(m.cold_storage_capacity_tons AS BIGINT) AS cold_storage_capacity_tons
    FROM ref_market m LEFT JOIN seen_markets s USING (market_name)""",
)

# Rolling model

PENALTIES = """
      least(45e0, greatest(0e0, (avg_temp - t_opt) / (t_crit - t_opt) * 45e0)) AS temp_penalty,
      least(20e0, greatest(0e0, abs(avg_hum - 90e0) / 20e0 * 20e0)) AS hum_penalty,
      least(15e0, greatest(0e0, (vibration_g - 0.1e0) / 0.35e0 * 15e0)) AS vib_penalty,
      least(20e0, anomaly_count * 4e0) AS exp_penalty"""
LEVEL = """CASE WHEN {0} >= 75 THEN 'Critical' WHEN {0} >= 50 THEN 'High' WHEN {0} >= 25 THEN 'Moderate'
      ELSE 'Low' END"""
part(
    "features",
    """
    SELECT s.*, t_opt, t_min, t_max, t_crit, h_min, h_max, v_max, shelf, typical,
      avg(temperature_c) OVER (w ROWS 2 PRECEDING) AS avg_temp,
      avg(humidity_pct) OVER (w ROWS 2 PRECEDING) AS avg_hum,
      CAST(sum(CASE WHEN temperature_c > t_max OR temperature_c < t_min OR humidity_pct > h_max
          OR vibration_g > v_max THEN 1 ELSE 0 END) OVER (w ROWS 4 PRECEDING) AS INT) AS anomaly_count,
      row_number() OVER (PARTITION BY container_id ORDER BY telemetry_timestamp DESC, record_id DESC)
        AS back
    FROM staged s JOIN ref_spec USING (commodity)
    WINDOW w AS (PARTITION BY container_id ORDER BY telemetry_timestamp, record_id)""",
)
part(
    "scored",
    f"""
    SELECT *, {LEVEL.format("spoilage_risk_score")} AS risk_level,
      {rnd("greatest(1e0, shelf * pow(greatest(0.05e0, 1e0 - spoilage_risk_score / 100e0), 1.6e0))", 1)}
        AS time_to_spoilage_hours
    FROM (SELECT *, {rnd("least(100e0, greatest(0e0, temp_penalty + hum_penalty + vib_penalty"
                         " + exp_penalty))", 1)} AS spoilage_risk_score
      FROM (SELECT *, {PENALTIES} FROM features))""",
)
part(
    "risk_rows",
    "SELECT record_id, container_id, telemetry_timestamp, "
    + ", ".join(
        f"{rnd(c, 1)} AS {c}" for c in ("temp_penalty", "hum_penalty", "vib_penalty", "exp_penalty")
    )
    + ", spoilage_risk_score, risk_level, time_to_spoilage_hours FROM scored",
)
part(
    "turned",
    """
    SELECT record_id, container_id, telemetry_timestamp, commodity, latitude, longitude,
      coalesce(old_level, 'none') AS previous_level, risk_level, spoilage_risk_score
    FROM (SELECT *, lag(risk_level) OVER (PARTITION BY container_id
        ORDER BY telemetry_timestamp, record_id) AS old_level FROM scored)
    WHERE risk_level = 'Critical' AND coalesce(old_level, 'none') <> 'Critical'""",
)
part(
    "authorised",
    "SELECT DISTINCT container_id FROM tele WHERE event_type = 'purchase' AND k = 7",
)


def decision_parts(name: str, desk: ref.Desk, overrides: str) -> None:
    part(
        f"{name}_now",
        f"""
    SELECT *, {rnd("quantity_kg * current_price * (1e0 - loss)", 2)} AS current_expected_value,
      {rnd("quantity_kg * current_price * loss", 2)} AS potential_loss
    FROM (SELECT *, CASE WHEN current_transit_hours > time_to_spoilage_hours THEN 0.8e0
        ELSE least(0.7e0, spoilage_risk_score / 100e0 * 0.4e0) END AS loss
      FROM (SELECT s.*, coalesce(h.hours, {desk.default_hours}e0) AS current_transit_hours,
          coalesce(p.price, typical) AS current_price,
          s.container_id IN ({overrides}) AS is_rerouted
        FROM scored s
        LEFT JOIN ref_schedule h ON h.origin = s.origin AND h.destination = s.destination
        LEFT JOIN {name}_price p ON p.market = s.destination AND p.commodity = s.commodity
        WHERE back = 1))""",
    )
    part(
        f"{name}_best",
        f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY container_id
        ORDER BY viable DESC, net DESC, pos) AS choice
      FROM (SELECT *, {rnd("(divert_value - cost) - current_expected_value", 2)} AS net,
          {rnd("potential_loss - quantity_kg * price * rate", 2)} AS avoided
        FROM (SELECT *, {rnd("quantity_kg * price * (1e0 - rate)", 2)} AS divert_value
          FROM (SELECT n.*, o.pos, o.market, o.price, o.hours,
              {rnd("o.km * 35e0 + o.toll", 2)} AS cost, o.hours <= time_to_spoilage_hours AS viable,
              CASE WHEN o.hours > time_to_spoilage_hours THEN 0.85e0
                WHEN o.hours <= time_to_spoilage_hours * 0.5e0 THEN 0.1e0 ELSE 0.25e0 END AS rate
            FROM {name}_now n JOIN {name}_offer o ON o.commodity = n.commodity
            WHERE o.market <> n.origin AND o.market <> n.destination)))) WHERE choice = 1""",
    )
    part(
        f"{name}_decided",
        f"""
    SELECT *, CASE WHEN is_rerouted THEN 'REROUTED'
      WHEN net > 0 AND viable AND risk_level IN ('High', 'Critical') THEN 'EXECUTE_REROUTE'
      WHEN net > 0 THEN 'OPPORTUNITY_IDENTIFIED' ELSE '{desk.stay_label}' END AS "action"
    FROM {name}_best""",
    )


decision_parts("desk", ref.DESK, "NULL")
decision_parts("catalogue", ref.CATALOGUE_DESK, "NULL")
decision_parts("console", ref.CONSOLE_DESK, "SELECT container_id FROM authorised")

DECISION = f"""SELECT container_id, shipment_id, commodity, quantity_kg, temperature_c, humidity_pct,
      vibration_g, latitude, longitude, {rnd("avg_temp", 2)} AS rolling_avg_temp, spoilage_risk_score,
      risk_level, time_to_spoilage_hours, destination AS current_destination, current_transit_hours,
      current_price, current_expected_value, potential_loss, market AS recommended_destination,
      price AS recommended_price, hours AS recommended_transit_hours, cost AS reroute_cost,
      divert_value AS reroute_expected_value, avoided AS spoilage_avoided,
      net AS spoilage_arbitrage_inr, "action" FROM {{0}}_decided"""
part("desk_rows", DECISION.format("desk"))
part("catalogue_rows", DECISION.format("catalogue"))
part(
    "fleet",
    f"""
    SELECT container_id, shipment_id, commodity, origin,
      CASE WHEN is_rerouted THEN market || ' (Rerouted)' ELSE destination END AS destination,
      quantity_kg, temperature_c, humidity_pct, vibration_g, latitude, longitude,
      {rnd("avg_temp", 2)} AS rolling_avg_temp, {rnd("avg_hum", 2)} AS rolling_avg_hum,
      {rnd("temp_penalty", 1)} AS temp_penalty, {rnd("hum_penalty", 1)} AS hum_penalty,
      {rnd("vib_penalty", 1)} AS vib_penalty, {rnd("exp_penalty", 1)} AS exp_penalty,
      spoilage_risk_score, risk_level, time_to_spoilage_hours, "action", is_rerouted,
      t_min AS min_safe_temp, t_max AS max_safe_temp, h_min AS min_safe_hum, h_max AS max_safe_hum
    FROM console_decided""",
)
part(
    "dealings",
    """
    SELECT container_id, commodity, quantity_kg,
      CASE WHEN is_rerouted THEN market ELSE destination END AS current_destination,
      current_expected_value AS status_quo_value, potential_loss, market AS recommended_market,
      price AS recommended_price, hours AS reroute_transit_hours,
      divert_value AS reroute_expected_value, cost AS diversion_cost,
      avoided AS spoilage_loss_avoided, net AS net_arbitrage_inr, viable AS is_viable,
      "action" AS directive
    FROM console_decided""",
)
part(
    "console_rows",
    """
    SELECT d.*, f.spoilage_risk_score, coalesce(f.risk_level, 'Low') AS risk_level
    FROM dealings d LEFT JOIN fleet f USING (container_id)""",
)
part(
    "fleet_kpis",
    f"""
    SELECT count(*) AS total_containers,
      CAST(coalesce(sum(CASE WHEN risk_level IN ('High', 'Critical') THEN 1 ELSE 0 END), 0) AS BIGINT)
        AS at_risk_count,
      CAST(coalesce(sum(CASE WHEN risk_level = 'Critical' THEN 1 ELSE 0 END), 0) AS BIGINT)
        AS critical_count,
      {rnd("coalesce(avg(temperature_c), 0)", 1)} AS average_temp_c,
      {rnd("coalesce(avg(humidity_pct), 0)", 1)} AS average_humidity_pct,
      {rnd("coalesce(sum(CASE WHEN net > 0 THEN net ELSE 0 END), 0)", 2)}
        AS total_potential_arbitrage_inr,
      {rnd("coalesce(sum(CASE WHEN avoided > 0 THEN avoided ELSE 0 END), 0)", 2)}
        AS total_loss_avoided_inr
    FROM console_decided""",
)
part(
    "series",
    """
    SELECT container_id, CAST(longest_own - back + 1 AS INT) AS step,
      'T-' || (max(longest_own) OVER () - (longest_own - back + 1)) || 'm' AS label,
      temperature_c AS temp, humidity_pct AS hum, vibration_g AS vib,
      strftime(telemetry_timestamp, '%H:%M:%S') AS "time"
    FROM (SELECT *, max(back) OVER (PARTITION BY container_id) AS longest_own
      FROM features WHERE back <= 30)""",
)

# Alerts and messages

def reason_texts(t: str, h: str, v: str) -> list[str]:
    """The alert reasons over the given measure columns, NULL where a limit holds."""
    cases = [
        (f"{t} >= t_crit", "Temperature ", t, "°C exceeds critical threshold (", "t_crit", "°C)"),
        (f"{h} > h_max", "Humidity ", h, "% exceeds safe ceiling (", "h_max", "%)"),
        (f"{v} > v_max", "Vibration ", v, "g exceeds mechanical limit (", "v_max", "g)"),
    ]
    return [
        f"CASE WHEN {test} THEN '{name}' || {float_text(value)} || '{middle}'"
        f" || {float_text(limit)} || '{unit}' END"
        for test, name, value, middle, limit, unit in cases
    ]


part(
    "alarms",
    f"""
    SELECT s.*, {", ".join(f"{text} AS reason{i}" for i, text in enumerate(
        reason_texts("temperature_c", "humidity_pct", "vibration_g"), 1))},
      'ALT_' || container_id || '_' || CAST(epoch(date_trunc('second', telemetry_timestamp)) AS BIGINT)
        AS alert_id
    FROM staged s JOIN ref_spec USING (commodity)
    WHERE temperature_c >= t_crit OR humidity_pct > h_max OR vibration_g > v_max""",
)
part(
    "messages",
    f"""
    SELECT record_id, container_id, container_id AS "key", commodity, quantity_kg, event_id, humidity_pct,
      vibration_g, CASE WHEN event_id % 53 = 0 THEN 'garbage ' || record_id ELSE
      '{{"timestamp":"' || {iso('"timestamp"')} || 'Z","container_id":"' || container_id || '",'
      || CASE WHEN event_id % 52 = 0 THEN '' ELSE '"shipment_id":"' || shipment_id || '",' END
      || '"commodity":"' || commodity || '","temperature_c":' || temp_text
      || ',"humidity_pct":' || {dec("humidity_pct", 2)} || ',"vibration_g":' || {dec("vibration_g", 3)}
      || ',"latitude":' || {dec("latitude", 6)} || ',"longitude":' || {dec("longitude", 6)}
      || ',"origin":"' || origin || '","destination":"' || destination || '","quantity_kg":'
      || quantity_kg || ',"compressor_status":"' || compressor_status || '"}}' END AS raw_payload,
      CASE WHEN event_id % 53 = 0 THEN 'malformed' ELSE concat_ws('; ',
        CASE WHEN event_id % 52 = 0 THEN 'missing shipment_id' END,
        CASE WHEN event_id % 50 <> 0 AND event_id % 51 = 0 THEN 'invalid temperature_c' END,
        CASE WHEN event_id % 50 = 0 THEN 'temperature_c out of range' END) END AS cause,
      CASE WHEN event_id % 53 <> 0 THEN TRY_CAST(temp_text AS DOUBLE) END AS parsed_temp
    FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN '125.00'
        WHEN event_id % 51 = 0 THEN '"not_a_number"' ELSE {dec("temperature_c", 2)} END AS temp_text
      FROM tele)""",
)
part(
    "message_alarms",
    f"""
    SELECT record_id, concat_ws(' | ', {", ".join(
        reason_texts("parsed_temp", "humidity_pct", "vibration_g"))}) AS detail
    FROM messages JOIN ref_spec USING (commodity)
    WHERE cause = '' AND (parsed_temp >= t_crit OR humidity_pct > h_max OR vibration_g > v_max)""",
)
