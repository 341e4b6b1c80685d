"""Keyed upsert of one table into another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.operators.latest import first_rows
from frostline.sinks.keyed import KeyedTable


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Insert new keys; on a known key take only the ``update`` columns from the source.

    Keys must be unique in the target. Of source rows that share a key the one that sorts last, by its other columns
    in order, is taken.
    """
    rest = [F.col(c).desc_nulls_last() for c in target.columns if c not in keys]
    incoming = first_rows(source.select(target.columns), keys, rest).select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in target.columns if c not in keys]
    ).withColumn("_incoming", F.lit(True))
    existing = target.withColumn("_existing", F.lit(True))
    joined = existing.join(incoming, keys, "full_outer")

    def value(c: str):
        if c in keys:
            return F.col(c)
        if c in update:
            return F.when(F.col("_incoming"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        return F.when(F.col("_existing"), F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c)

    return joined.select([value(c) for c in target.columns])


# Keys of the reference tables, and the columns that an upsert changes
MARKETS = (["market_id"], ["market_name", "latitude", "longitude"])
PRICES = (["market", "commodity"], ["price_per_kg", "last_updated"])
ROUTES = (["route_id"], ["distance_km", "estimated_transit_hours"])


def upsert_markets(target: DataFrame, source: DataFrame) -> DataFrame:
    return upsert(target, source, *MARKETS)


def upsert_prices(target: DataFrame, source: DataFrame) -> DataFrame:
    return upsert(target, source, *PRICES)


def upsert_routes(target: DataFrame, source: DataFrame) -> DataFrame:
    return upsert(target, source, *ROUTES)


def upsert_into(table: KeyedTable, source: DataFrame, update: list[str], batch: int | None = None) -> None:
    """Upsert into a stored table, of which only the buckets that the source's keys fall in are read and replaced.

    Doing it again changes nothing. With a ``batch`` number, a run that broke off can be repeated. Rows whose key holds
    a NULL match nothing, and are inserted each time.
    """
    table.merge(source, lambda held, new: upsert(held, new, table.keys, update), batch)
