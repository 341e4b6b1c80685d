"""JSON text with plain decimal numbers, so that a value reads the same everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_object(fields: dict[str, Column]) -> Column:
    """One JSON object; NULL fields are kept as null."""
    body = F.struct(*[c.alias(name) for name, c in fields.items()])
    return F.to_json(body, {"ignoreNullFields": "false"})


def number(value: Column, places: int) -> Column:
    """A JSON number with a fixed count of decimals."""
    return value.cast(f"decimal(20,{places})")


def iso_time(ts: Column) -> Column:
    """Wall-clock text with microseconds. A cast knows no zone, so no clock change can shift it."""
    text = ts.cast("string")
    fraction = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(F.translate(F.substring(text, 1, 19), " ", "T"), F.lit("."), fraction)


def time_of_day(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 12, 8)
