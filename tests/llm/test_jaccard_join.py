import random

import pytest
from pyspark.sql import functions as F

from frostline.llm import components, jaccard_join


def brute(rows, words, percent):
    """doc_id -> (set size, component) by comparing all pairs; ids must be distinct."""
    sets = {}
    for doc_id, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            lower = lower.replace(c, " ")
        w = [x for x in lower.split(" ") if x]
        sets[doc_id] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    up = {d: d for d in sets}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if not x or not y or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            common = len(x & y)
            if 100 * common >= percent * (len(x) + len(y) - common):
                p, q = sorted((find(a), find(b)))
                up[q] = p
    return {d: (len(s), find(d)) for d, s in sets.items()}


def as_dict(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_equals_all_pairs(spark, small, words, percent):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    expected = brute([(r["doc_id"], r["text"]) for r in docs.collect()], words, percent)
    assert as_dict(jaccard_join.grouped(docs, words=words, percent=percent)) == expected


def test_chains_of_edits_and_a_shared_passage(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    rows, text = [], [word() for _ in range(80)]
    for i in range(60):  # each differs from the one before by a word or two, the ends by far more
        rows.append((i, " ".join(text)))
        text = list(text)
        text[draw.randrange(len(text))] = word()
    rows += [(100 + i, " ".join(passage + [word() for _ in range(30 + i % 9)])) for i in range(60)]
    rows += [(200 + i, " ".join(word() for _ in range(40))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_dict(jaccard_join.grouped(docs, words=4, percent=85)) == brute(rows, 4, 85)


def test_edges(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one\ttwo"), (6, "two one"), (7, "a b c d"), (8, "A b c d"),
        (9, "x " * 300_000 + "end"), (10, "x " * 300_000 + "end"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("n", F.lit("n"))
    assert as_dict(jaccard_join.grouped(docs, words=4, percent=85)) == brute(rows, 4, 85)
    kept = jaccard_join.one_of_each(docs, words=4, percent=85)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 9]


def test_repeated_rows_and_ids(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (1, "v w x y z"), (None, "a b c d e"), (2, "v w x y z"), (None, "only here to see")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard_join.grouped(docs, words=4, percent=85)
    assert out.count() == len(rows)
    assert sorted((r["text"], r["doc_id"]) for r in jaccard_join.one_of_each(docs, words=4, percent=85).collect()) == [
        ("a b c d e", 1), ("only here to see", None), ("v w x y z", 1),
    ]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.grouped(docs).count() == 0
    assert jaccard_join.one_of_each(docs).count() == 0


def test_components_of_random_links(spark):
    draw = random.Random(4)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        p, q = sorted((find(a), find(b)))
        up[q] = p
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
