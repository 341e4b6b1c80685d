"""Filters of the dashboard and the console, and the values they offer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.plans.dashboard import RISK_ORDER


def filter_fleet(df: DataFrame, **choices: list[str]) -> DataFrame:
    """Keep rows whose columns hold one of the chosen values; an empty list keeps all."""
    for column, values in choices.items():
        if values:
            df = df.filter(F.col(column).isin(*values))
    return df


def filter_recent(df: DataFrame, hours: int, as_of: Column | None = None) -> DataFrame:
    """Readings of the last hours before ``as_of``, by default the newest reading.

    Readings that carry their day are also filtered by it, so that whole days are skipped: the newest clock is looked
    for in the newest day only, and that day is known without reading a column.
    """
    dated = "event_date" in df.columns
    if as_of is None:
        last = df.filter(F.col("event_date") == df.agg(F.max("event_date")).scalar()) if dated else df
        as_of = last.agg(F.max("telemetry_timestamp")).scalar()
    start = as_of - F.make_dt_interval(hours=F.lit(hours))
    if dated:
        df = df.filter(F.col("event_date") >= F.to_date(start))
    return df.filter(F.col("telemetry_timestamp") > start)


def filter_text(df: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """Rows with the text in one of the columns, ignoring case; no text keeps all."""
    if not text:
        return df
    found = [F.lower(c).contains(text.lower()) for c in columns]
    return df.filter(reduce(lambda a, b: a | b, found))


def score_bucket(score: Column) -> Column:
    return (
        F.when(score >= 75, "Critical")
        .when(score >= 50, "High")
        .when(score >= 25, "Moderate")
        .otherwise("Low")
    )


def filter_bucket(df: DataFrame, commodity: str = "ALL", risk: str = "ALL") -> DataFrame:
    """Console filter by commodity and score band; a missing score counts as 0."""
    if commodity != "ALL":
        df = df.filter(F.col("commodity") == commodity)
    if risk != "ALL":
        score = F.coalesce("spoilage_risk_score", F.lit(0.0))
        df = df.filter(score_bucket(score) == risk)
    return df


def _distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of several columns in one pass."""
    pairs = [F.struct(F.lit(c).alias("filter_name"), F.col(c).alias("filter_value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).distinct()


def filter_values(arbitrage: DataFrame, readings: DataFrame) -> DataFrame:
    """Values offered by the container, commodity, origin and destination filters."""
    fleet = _distinct_values(arbitrage, ["container_id", "commodity"])
    places = _distinct_values(readings, ["origin", "destination"])
    return fleet.unionByName(places).orderBy("filter_name", "filter_value")


def filter_values_risk(arbitrage: DataFrame) -> DataFrame:
    """Risk categories present, worst first."""
    order = F.coalesce(
        *[F.when(F.col("risk_category") == name, i) for i, name in enumerate(RISK_ORDER, 1)],
        F.lit(len(RISK_ORDER) + 1),
    )
    return (
        arbitrage.select("risk_category")
        .distinct()
        .withColumn("severity_rank", order)
        .orderBy("severity_rank")
    )
