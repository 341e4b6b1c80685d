"""Chunked lags against brute force, with one container holding a third of the rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frostline.operators.lags import chunked, with_previous

COLUMNS = "c string, t timestamp_ntz, id string, v double"


def make_rows(seed: int, rows: int = 600):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    out = []
    for i in range(rows):
        hot = i % 3 == 0
        container = "hot" if hot else f"c{rng.randrange(40)}"
        # Most of the hot container's rows fall into one hour; some clocks are equal or empty.
        seconds = rng.randrange(3600) if hot and rng.random() < 0.8 else rng.randrange(86400 * 5)
        clock = None if rng.random() < 0.02 else start + timedelta(seconds=seconds)
        out.append((container, clock, f"{i:05d}", None if rng.random() < 0.1 else float(i)))
    return out


def brute_force(rows, count):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or datetime.min, r[2])):
        groups.setdefault(row[0], []).append(row)
    out = {}
    for group in groups.values():
        for i, row in enumerate(group):
            before = [group[i - k][3] if i >= k else "none" for k in range(1, count + 1)]
            out[row[2]] = before
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rows_per_chunk", [1, 7, 50, 10_000])
def test_lags_equal_brute_force(spark, seed, rows_per_chunk):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, COLUMNS)
    lagged = with_previous(df, "c", ["t", "id"], ["v"], 4, rows_per_chunk)
    found = {}
    for r in lagged.collect():
        before = [r[f"previous_{i}"] for i in range(1, 5)]
        found[r["id"]] = ["none" if b is None else b["v"] for b in before]
    assert found == brute_force(rows, 4)


BOUND = 1000


@pytest.mark.parametrize(
    "burst",
    [
        lambda i: datetime(2024, 1, 1),  # one container, one second
        lambda i: None if i % 10 else datetime(2024, 1, 1) + timedelta(seconds=i),  # hardly any clocks
    ],
)
def test_bursts_and_missing_clocks_are_cut(spark, burst):
    rows = [("hot", burst(i), f"{i:06d}", float(i)) for i in range(20_000)]
    chunks = chunked(spark.createDataFrame(rows, COLUMNS), "c", ["t", "id"], BOUND).groupBy("c", "_chunk").count()
    assert chunks.agg(F.max("count")).first()[0] <= 2 * BOUND


def test_rows_without_a_key_are_cut_too(spark):
    rows = [(None, None, f"{i:04d}", float(i)) for i in range(300)]
    lagged = with_previous(spark.createDataFrame(rows, COLUMNS), "c", ["t", "id"], ["v"], 1, 20)
    assert all((r["previous_1"] or {"v": -1.0})["v"] == r["v"] - 1 for r in lagged.collect())
