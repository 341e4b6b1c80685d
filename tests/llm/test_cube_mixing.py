import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.llm import cube_mixing

SCHEMA = "doc_id long, text string, source string, copies string"


def brute_targets(sizes: dict, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        over = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / over for s in names}
        new = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not new:
            return target
        full |= new


def test_flight_keeps_both_sums_and_leaves_two():
    draw = np.random.default_rng(1)
    sizes = draw.integers(0, 500, 300).astype(float).tolist()
    p = draw.random(300).tolist()
    words, documents = sum(a * b for a, b in zip(p, sizes)), sum(p)
    cube_mixing.fly(p, sizes, draw)
    assert sum(0 < x < 1 for x in p) <= 2
    assert sum(a * b for a, b in zip(p, sizes)) == pytest.approx(words)
    assert sum(p) == pytest.approx(documents)


def test_inclusion_probabilities_hold():
    draw, hits = np.random.default_rng(2), np.zeros(12)
    sizes = [float(i % 5 + 1) for i in range(12)]
    for _ in range(4000):
        p = [0.3] * 12
        cube_mixing.fly(p, sizes, draw)
        hits += p
    assert np.abs(hits / 4000 - 0.3).max() < 0.04


def test_sources_meet_their_targets(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = cube_mixing.decisions(docs).toPandas()
    assert len(rows) == docs.count()
    sizes = rows.groupby("source")["size"].sum().to_dict()
    for source, target in brute_targets(sizes).items():
        own = rows[rows.source == source]
        assert own["target"].iloc[0] == pytest.approx(target)
        assert abs(own["taken"].sum() - target) <= 0.02 * target + 5
    assert (rows["taken"] <= 3 * rows["size"]).all()
    again = cube_mixing.decisions(docs.repartition(7)).toPandas()
    key = ["doc_id", "source", "taken"]
    assert rows[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()


def test_large_strata_fly_in_rounds(spark):
    n = 5000
    units = spark.range(n).select(
        F.lit(None).cast("string").alias("source"), F.lit(False).alias("unnamed"), F.col("id").alias("unit"),
        (F.col("id") % 97 + 1).alias("size"), F.lit(0.37).alias("probability"),
    )
    rows = cube_mixing.sampled(units, ["unnamed", "unit"], group=64).toPandas()
    assert len(rows) == n
    assert abs((rows["chosen"] * rows["size"]).sum() - 0.37 * rows["size"].sum()) <= 100
    assert abs(rows["chosen"].sum() - 0.37 * n) <= 5


def test_small_sources_beside_a_large_one_come_as_near(spark):
    size = {"hot": 9000, "middle": 4500, **{f"small{i}": 60 for i in range(12)}}
    draw = np.random.default_rng(5)
    rows = [(s, False, i, int(x)) for s, n in size.items() for i, x in enumerate(draw.lognormal(5, 1, n) + 1)]
    units = spark.createDataFrame(rows, "source string, unnamed boolean, unit long, size long").withColumn("probability", F.lit(0.41))
    out = cube_mixing.sampled(units, ["unnamed", "unit"]).toPandas()
    assert out.groupby("source").size().to_dict() == size
    for source, own in out.groupby("source"):
        want = 0.41 * own["size"].sum()
        assert abs((own["chosen"] * own["size"]).sum() - want) <= 0.02 * want, source


def test_nulls_ties_and_repeats(spark):
    rows = [(1, "a b c", "s", "x"), (1, "a b c", "s", "x"), (2, None, "s", "y"), (None, "d e", None, None), (None, "f", None, None), (3, "", "t", "z")]
    rows += [(4, "w " * 5000, "u", "long")]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = cube_mixing.decisions(docs).toPandas()
    assert len(out) == len(rows)
    assert out[out.doc_id == 1]["taken"].nunique() == 1
    assert out[out.doc_id == 4]["size"].tolist() == [5000]
    mixed = cube_mixing.mixed(docs)
    assert mixed.columns == docs.columns
    want = {r["doc_id"]: r["copies"] for _, r in out.iterrows() if r["doc_id"] == r["doc_id"]}
    got = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got.get(4, 0) == want[4] and got.get(1, 0) == 2 * want[1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert cube_mixing.decisions(docs).count() == 0
    assert cube_mixing.mixed(docs).count() == 0
