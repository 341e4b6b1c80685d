"""File sources: telemetry as JSON, reference tables as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from frostline.sources.schemas import EVENT_SCHEMA, RAW_TABLES

# Other headers under which the same columns are delivered
HEADER_VARIANTS = {
    "commodity_prices": {"timestamp": "last_updated"},
    "markets": {"storage_capacity_mt": "cold_storage_capacity_tons"},
    "routes": {"toll_charges_inr": "toll_cost_inr"},
}


def read_event_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Events from files that each hold one JSON array."""
    return spark.read.schema(EVENT_SCHEMA).option("multiLine", True).json(path)


def read_event_lines(spark: SparkSession, path: str) -> DataFrame:
    """Events from files with one JSON object per line; these can be split."""
    schema = StructType.fromDDL(EVENT_SCHEMA)
    return spark.read.schema(schema).json(path).select(schema.names)


def read_reference_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A reference table from CSV with any known header, in its declared columns.

    Columns the file lacks come out NULL, except that a missing route id is built
    from the corridor. The header is read, types are not inferred.
    """
    raw = spark.read.option("header", True).csv(path)
    for other, name in HEADER_VARIANTS[table].items():
        if other in raw.columns:
            raw = raw.withColumnRenamed(other, name)
    if table == "routes" and "route_id" not in raw.columns:
        raw = raw.withColumn("route_id", F.concat_ws("_", F.lit("RT"), "origin", "destination"))
    declared = [part.rsplit(" ", 1) for part in RAW_TABLES[table].split(", ")]
    return raw.select(
        [
            (F.col(name) if name in raw.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in ((n.strip(), k) for n, k in declared)
        ]
    )
