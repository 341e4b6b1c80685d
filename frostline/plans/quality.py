"""Event validation and table quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.plans.dashboard import RISK_ORDER
from frostline.plans.marts import Marts
from frostline.sources import reference as ref
from frostline.sources.schemas import EVENT_SCHEMA, REQUIRED_FIELDS

# Physical limits of a sensor reading
LIMITS = {
    "temperature_c": (-30.0, 60.0),
    "humidity_pct": (0.0, 100.0),
    "vibration_g": (0.0, 5.0),
    "latitude": (-90.0, 90.0),
    "longitude": (-180.0, 180.0),
}
EVENT_TYPES = dict(field.split() for field in EVENT_SCHEMA.split(", "))
#: Fields that must be texts with something in them.
TEXTS = ["container_id", "shipment_id", "commodity", "origin", "destination"]


def _unpacked(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns by ``inline``, below which Spark pushes nothing: no filter makes it work them out again."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Decode JSON messages, each parsed once; a broken one keeps its text in ``_corrupt`` instead of failing.

    Texts are decoded as variants, which know what was sent: beside each comes its kind, named with an underscore.
    """
    kinds = {c: "variant" if c in TEXTS else kind for c, kind in EVENT_TYPES.items()}
    schema = ", ".join(f"{c} {kind}" for c, kind in kinds.items()) + ", _corrupt string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    decoded = messages.select("*", F.inline(F.array(F.from_json("value", schema, options))))
    return decoded.withColumns(
        {f"_{c}": F.schema_of_variant(c) for c in TEXTS} | {c: F.col(c).cast("string") for c in TEXTS}
    )


def event_errors() -> Column:
    """Every reason why a decoded message is not a valid event."""
    nothing = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in REQUIRED_FIELDS])
    broken = F.col("_corrupt").isNotNull()

    def absent(name: str) -> Column:
        # Only a broken message is looked at again, and only for a field that it lacks.
        given = broken & F.get_json_object("value", f"$.{name}").isNotNull()
        return F.when(
            F.col(name).isNull(),
            F.when(given, f"invalid {name}").otherwise(f"missing {name}"),
        )

    clock = F.col("timestamp")
    unreadable = clock.isNotNull() & clock.try_cast("timestamp_ntz").isNull()
    ranges = [F.when(unreadable, "invalid timestamp")]
    ranges += [
        F.when(~F.col(c).between(low, high), f"{c} out of range")
        for c, (low, high) in LIMITS.items()
    ]
    ranges.append(F.when(~(F.col("quantity_kg") > 0), "quantity_kg out of range"))
    for c in TEXTS:
        ranges.append(F.when(F.col(c).isNotNull() & ((F.col(f"_{c}") != "STRING") | (F.trim(c) == "")), f"invalid {c}"))
    details = F.array_compact(F.array(*[absent(c) for c in REQUIRED_FIELDS], *ranges))
    return F.when(broken & nothing, F.array(F.lit("malformed"))).otherwise(details)


def validate_events(messages: DataFrame) -> DataFrame:
    """Decoded messages with the array of their errors, empty when valid."""
    return _unpacked(parse_messages(messages), {"errors": event_errors()}).select(*messages.columns, *EVENT_TYPES, "errors")


def valid_events(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("errors") == 0)


def dead_letters(validated: DataFrame) -> DataFrame:
    """Rejected messages with their text and the reasons."""
    return validated.filter(F.size("errors") > 0).select(
        "record_id",
        "key",
        F.col("value").alias("raw_payload"),
        F.array_join("errors", "; ").alias("cause"),
    )


def _unstack(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row of counts to one row per check."""
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("check_name"), F.coalesce(f"c{i}", F.lit(0)).alias("failures"))
            for i, n in enumerate(names)
        ]
    )
    return counts.select(F.inline(rows))


def _count_where(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Failing rows of many checks in one pass over the table."""
    counts = df.agg(
        *[F.sum(F.when(c, 1).otherwise(0)).alias(f"c{i}") for i, c in enumerate(checks.values())]
    )
    return _unstack(counts, list(checks))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _nulls(table: str, *columns: str) -> dict[str, Column]:
    return {f"{table}.{c}": F.col(c).isNull() for c in columns}


def not_null_checks(marts: Marts) -> DataFrame:
    """Count NULLs of the columns that must be filled. Tables with equal rows share a pass."""
    staged = _nulls(
        "stg_telemetry", "record_id", "container_id", "commodity", "temperature_c", "humidity_pct"
    ) | _nulls("fct_container_health", "record_id", "container_id")
    risk = _nulls("container_health", "container_id", "temp_excursion_c") | _nulls(
        "spoilage_risk",
        "container_id",
        "spoilage_risk_score",
        "risk_category",
        "time_to_spoilage_hours",
    )
    arbitrage = _nulls(
        "fct_spoilage_arbitrage",
        "container_id",
        "commodity",
        "spoilage_risk_score",
        "risk_category",
        "time_to_spoilage_hours",
        "current_destination",
        "recommended_destination",
        "spoilage_arbitrage_inr",
    )
    options = _nulls(
        "market_options", "container_id", "candidate_market", "net_realizable_value_inr"
    )
    market = _nulls("stg_markets", "market_id", "market_name") | _nulls(
        "dim_market", "market_id", "market_name"
    )
    return _union(
        [
            _count_where(marts.staged, staged),
            _count_where(marts.risk, risk),
            _count_where(marts.options, options),
            _count_where(marts.arbitrage, arbitrage),
            _count_where(marts.container_dim, _nulls("dim_container", "container_id")),
            _count_where(marts.prices, _nulls("stg_prices", "market", "commodity", "price_per_kg")),
            _count_where(marts.markets, market),
            _count_where(marts.routes, _nulls("stg_routes", "route_id")),
        ]
    )


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; copies are counted before the shuffle."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")


def unique_checks(marts: Marts) -> DataFrame:
    """Count the values that break a unique key."""
    keys = [
        ("container_health", marts.health, "container_id"),
        ("spoilage_risk", marts.risk, "container_id"),
        ("fct_spoilage_arbitrage", marts.arbitrage, "container_id"),
        ("fct_container_health", marts.readings, "record_id"),
        ("dim_container", marts.container_dim, "container_id"),
        ("stg_markets", marts.markets, "market_id"),
        ("stg_markets", marts.markets, "market_name"),
        ("dim_market", marts.market_dim, "market_id"),
        ("dim_market", marts.market_dim, "market_name"),
        ("stg_routes", marts.routes, "route_id"),
    ]
    return _union(
        [
            duplicate_keys(df, column).agg(
                F.lit(f"{table}.{column}").alias("check_name"), F.count("*").alias("failures")
            )
            for table, df, column in keys
        ]
    )


def accepted_value_checks(marts: Marts) -> DataFrame:
    """Count rows whose value is outside the accepted list."""
    commodity = ~F.col("commodity").isin(*ref.COMMODITIES)
    category = ~F.col("risk_category").isin(*RISK_ORDER)
    return _union(
        [
            _count_where(marts.staged, {"stg_telemetry.commodity": commodity}),
            _count_where(marts.risk, {"spoilage_risk.risk_category": category}),
            _count_where(marts.arbitrage, {"fct_spoilage_arbitrage.risk_category": category}),
        ]
    )


def reroute_gain_check(marts: Marts) -> DataFrame:
    """No recommended reroute without a gain, and no score outside 0..100."""
    gain = F.col("is_reroute_recommended") & (F.col("spoilage_arbitrage_inr") <= 0)
    score = ~F.col("spoilage_risk_score").between(0.0, 100.0)
    checks = {"reroute without gain": gain, "score out of range": score}
    return _count_where(marts.arbitrage, checks)
