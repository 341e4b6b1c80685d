import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.llm import block_topk, permutation_index, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
ODD = [
    (100, None, 0), (120, [], 0), (140, [1.0, None, 2.0], 0), (160, [1.0, NAN, 2.0], 0), (180, [INF, 0.0, 1.0], 0), (200, [0.0, 0.0, 0.0], 0),
    (220, [1.0, 2.0], 0), (None, [1.0, 1.0, 1.0], 0),
]


def brute(rows, k, whole):
    """query -> [(vec_id, score)] by scoring everything; rows that share an id count once."""
    usable = []
    for vec_id, v, *_ in rows:
        if vec_id is not None and v and len(v) == 3 and all(x is not None and np.isfinite(x) for x in v) and (whole or any(v)):
            usable.append((vec_id, np.floor(64 * np.array(v, float)) if whole else np.array(np.float32(v), float)))
    out = {}
    for q, x in usable:
        if q % 20 == 0:
            best = out.setdefault(q, {})
            for c, y in usable:
                if c != q:
                    best[c] = max(best.get(c, -np.inf), float(x @ y))
    return {q: sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k] for q, best in out.items()}


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def rows_of(n, seed=1):
    draw = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in np.float32(draw.normal(size=3) * draw.choice([0.1, 1, 5]))], 0) for i in range(n)]
    rows += [(n + i, rows[40][1], 0) for i in range(30)]  # a group of copies: ties
    return rows + [(i, v, 1) for i, v, _ in rows[60:65]] + [(60, rows[3][1], 1)] + ODD  # repeated rows, and one id twice


@pytest.mark.parametrize("n", [0, 1, 15, 90])
def test_block_topk_is_exact(spark, n):
    rows = rows_of(n) if n > 80 else rows_of(90)[:n] + ODD
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("clash"))
    got = answers(block_topk.search(df, permutation_index.every(20)))
    want = brute(rows, 20, True)
    assert got == {q: best for q, best in want.items() if best}


def test_pruning_keeps_every_result(monkeypatch):
    draw = np.random.default_rng(3)
    weights = draw.integers(-50, 50, (3000, 8)).astype(float)
    ids = np.arange(3000)
    blocks = block_topk.ForwardBlocks(ids, weights, weights[:32])
    for own in range(0, 200, 20):
        scores = weights @ weights[own]
        order = [i for i in np.lexsort((ids, -scores)) if i != own][:20]
        found, got = blocks.top(own, weights[own], 20, -np.inf)
        assert found.tolist() == order and got.tolist() == scores[order].tolist()
        assert (blocks.bounds(weights[own])[np.arange(3000) // 64] >= (blocks.weights @ weights[own])).all()


@pytest.mark.parametrize("n", [0, 1, 15, 90])
def test_permutation_index_on_few_rows(spark, n):
    rows = rows_of(n) if n > 80 else rows_of(90)[:n] + ODD
    df = spark.createDataFrame(rows, SCHEMA)
    got = answers(permutation_index.search(df, permutation_index.every(20)))
    want = {q: best for q, best in brute(rows, 20, False).items() if best}
    assert {q: [i for i, _ in best] for q, best in got.items()} == {q: [i for i, _ in best] for q, best in want.items()}
    for q, best in got.items():
        assert [s for _, s in best] == pytest.approx([s for _, s in want[q]])


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = df.orderBy("vec_id").toPandas()
    body = np.stack(table["embedding"]).astype(float)
    got = answers(permutation_index.search(df, permutation_index.every(20)))
    ids = table["vec_id"].to_numpy()
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        score = body @ body[at]
        score[at] = -np.inf
        best = set(ids[np.argsort(-score, kind="stable")[:20]].tolist())
        hits += len(best & {i for i, _ in got[ids[at]]})
        total += 20
    assert hits / total >= 0.95


def test_agreement_is_the_footrule_distance():
    draw = np.random.default_rng(4)
    permutations = np.array([draw.permutation(40)[:12] for _ in range(50)], "<u2")
    files = permutation_index.InvertedFiles(permutations, 40)

    def place(p):
        out = np.full(40, 12)
        out[p] = np.arange(12)
        return out

    for asked in permutations[:10]:
        footrule = [np.abs(place(p) - place(asked)).sum() for p in permutations]
        assert (12 * 13 - 2 * files.agreement(asked)).tolist() == footrule


def test_floor_counts_an_id_once():
    sample_ids, sample = np.array([1, 2, 1, 3]), np.array([[10.0], [8.0], [9.0], [1.0]])
    assert block_topk._floors(np.array([7]), np.array([[1.0]]), sample_ids, sample, 2).tolist() == [8.0]


def test_few_vectors_in_many_rows(spark):
    v = F.array(F.lit(1.0), (F.col("id") % 3).cast("double"))
    df = spark.range(20_000).select(F.col("id").alias("vec_id"), v.alias("embedding"))
    assert len(answers(permutation_index.search(df, F.col("vec_id") == 40, k=3))[40]) == 3
    _, chosen = vectors.sample(df.withColumnRenamed("embedding", "v"), 2, 256)
    assert sorted(chosen.tolist()) == [[1.0, 0.0], [1.0, 1.0], [1.0, 2.0]]


@pytest.mark.parametrize("search", [block_topk.search, permutation_index.search])
def test_an_id_in_many_rows_counts_once(spark, search):
    """500 rows of one id, all nearer to the query than any other row, take one place and not all."""
    draw = np.random.default_rng(8)
    rows = [(20, [1.0] * 8)] + [(7, (10 + draw.random(8)).tolist()) for _ in range(500)]
    rows += [(100 + i, draw.random(8).tolist()) for i in range(0, 900) if (100 + i) % 20]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash"))
    got = answers(search(df, F.col("vec_id") == 20))[20]
    assert len(got) == 20 and [i for i, _ in got][0] == 7 and len({i for i, _ in got}) == 20
    by_id = {}
    for i, v in rows[1:]:
        score = sum(int(np.floor(64 * x)) * 64 for x in v) if search is block_topk.search else sum(v)
        by_id[i] = max(by_id.get(i, -np.inf), score)
    if search is block_topk.search:
        assert got == sorted(by_id.items(), key=lambda x: (-x[1], x[0]))[:20]
    else:
        assert got[0][1] == pytest.approx(by_id[7])
