"""What streaming jobs remember of a container or a reading, as keyed state of Spark's."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def _nulls_first(*values) -> tuple:
    return tuple(x for v in values for x in (v is not None, v))


class TrailingRows(StatefulProcessor):
    """Gives the rows that a container had before a batch, oldest first, each with the container's newest clock till then.

    State: the last rows of a container in the order they were taken, and its newest clock. A batch's rows are taken by
    clock and record id; no more than the last of them are held in memory.
    """

    COLUMNS = ("temperature_c", "humidity_pct", "vibration_g", "commodity")

    def __init__(self, columns: list[str], count: int, row_schema: str):
        self.columns, self.count, self.row_schema = columns, count, row_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tail = handle.getListState("tail", self.row_schema)
        self.newest = handle.getValueState("newest", "clock timestamp_ntz")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self.tail.get()]
        newest = self.newest.get()[0] if held and self.newest.exists() else None
        out, seen, last = Row("container_id", *self.columns, "_turn", "_newest"), newest, []
        for turn, row in enumerate(held):
            yield out(key[0], *row, turn, newest)
        for number, r in enumerate(rows):
            clock = r["telemetry_timestamp"]
            taken = (*_nulls_first(clock, r["record_id"]), number)
            if len(last) < self.count:
                heapq.heappush(last, (taken, tuple(r[c] for c in self.columns)))
            elif taken > last[0][0]:
                heapq.heapreplace(last, (taken, tuple(r[c] for c in self.columns)))
            if clock is not None and (seen is None or clock > seen):
                seen = clock
        self.tail.put([*held, *[row for _, row in sorted(last, key=lambda item: item[0])]][-self.count :])
        if seen is not None and seen != newest:
            self.newest.update((seen,))

    def close(self) -> None:
        pass


#: Readings are remembered in bundles: a span of clocks, and a share of the readings in it by hash.
BUNDLE_MINUTES = 10
BUNDLE_SHARES = 64


def bundle_of_reading(container: str = "container_id", clock: str = "timestamp") -> Column:
    """The bundle that a reading is remembered in."""
    slots = 60 // BUNDLE_MINUTES
    slot = F.unix_date(F.to_date(clock)).cast("long") * (24 * slots) + F.hour(clock) * slots
    slot += F.floor(F.minute(clock) / BUNDLE_MINUTES)
    return slot * BUNDLE_SHARES + F.pmod(F.xxhash64(container, clock), F.lit(BUNDLE_SHARES))


class NewestOfReading(StatefulProcessor):
    """Names the readings of a batch whose newest row is late, and those that have none newer than a row before.

    State: a bundle's readings with the newest row's ingestion and record id, until the watermark has gone past the
    bundle's clocks; a batch adds the readings that it brings. The watermark is the newest clock seen less the delay; a row
    behind it is late, and remembered no more. Readings share state because each key costs calls and an Arrow batch.
    """

    COLUMNS = ("container_id", "timestamp", "ingestion_timestamp", "record_id")

    def __init__(self, known_schema: str):
        self.known_schema = known_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getListState("known", self.known_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out, best, known = Row("container_id", "timestamp", "_late"), {}, {}
        for r in rows:
            _keep_newest(best, tuple(r[c] for c in self.COLUMNS))
        for row in self.known.get():
            _keep_newest(known, row)
        added, watermark = [], timerValues.getCurrentWatermarkInMs()
        for reading, (age, row) in best.items():
            if reading in known and age <= known[reading][0]:
                yield out(*reading, False)
            elif _milliseconds(reading[1]) < watermark:
                yield out(*reading, True)
            else:
                added.append(row)
        if added:
            self.known.appendList(added)
            if not known:
                self.handle.registerTimer((key[0] // BUNDLE_SHARES + 1) * BUNDLE_MINUTES * 60_000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.known.clear()
        yield from ()

    def close(self) -> None:
        pass


def _keep_newest(readings: dict, row: tuple) -> None:
    """Put a row (container, clock, ingestion, record id) in its reading's place if it is newer than what is there."""
    reading, age = row[:2], _nulls_first(*row[2:])
    if reading not in readings or age > readings[reading][0]:
        readings[reading] = age, row


def _milliseconds(clock: datetime) -> int:
    """Since 1970, of a clock without zone."""
    since = clock.replace(tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return int(since.total_seconds() * 1000)
