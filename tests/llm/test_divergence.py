"""The audit against plain loops over every term and pair of sources."""

import random
import re
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from frostline.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, value string"
_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, documents=30, ranks=50):
    n, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = _TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        n[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in seen[lang].items() if d >= documents]
        sources = sorted(s for la, s in groups if la == lang)
        everywhere = sum((n[lang, s] for s in sources), Counter())

        def probabilities(counts, kept=kept):
            below = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // below for t in kept}

        q, p = probabilities(everywhere), {s: probabilities(n[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                for rank, (value, item) in enumerate(sorted(found)[:most], 1):
                    out.add((lang, s, part, item.decode(), -value, rank))
    return out


def made(seed, size):
    rng = random.Random(seed)
    words = [f"w{a}{b}" for a in "abcdef" for b in "ghijkl"] + ["Ärger", "ärger", "日本", "naïve-x", "a1b", "É", "e" * 3000]
    rows = []
    for i in range(size):
        source = rng.choice(["s1", "s1", "s1", "s2", "S2", "é", None, ""])
        text = " ".join(rng.choice(words).title() if rng.random() < 0.2 else rng.choice(words[: rng.randrange(2, len(words))]) for _ in range(rng.randrange(30)))
        rows.append((i, text, rng.choice(["x", "x", None, "y"]), source, "clash"))
    return rows + [(None, None, "empty", "a", ""), (1, "one two", "empty", "b", ""), (1, "", "empty", "c", ""), (2, "", "lonely", None, "")]


@pytest.mark.parametrize("documents", [1, 30])
def test_equals_brute_force(spark, documents):
    rows = made(3, 600)
    rows += rows[:50]  # repeated rows are documents of their own
    df = spark.createDataFrame(rows, SCHEMA).withColumn("term", F.lit(1)).repartition(5)
    got = divergence.audit(df, documents=documents, ranks=5)
    assert {tuple(r) for r in got.collect()} == brute(rows, documents, 5)
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"


def test_counters_that_are_put_out_early(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    rows = made(4, 300)
    assert {tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA), documents=5).collect()} == brute(rows, 5)


def test_blocks_of_any_width(spark, monkeypatch):
    monkeypatch.setattr(divergence, "ROWS", 7)
    rows = made(5, 400)
    assert {tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA), documents=2).collect()} == brute(rows, 2)


def test_huge_counts_stay_exact(spark):
    big = 6_000_000_000_000_000_000
    df = spark.createDataFrame([(big, big, 3)], "n long, size long, terms long")
    assert df.select(divergence.probability(F.col("n"), F.col("size"), F.col("terms"))).first()[0] == 1 + 10**9 * (big + 5) // (big + 15)
    block = pd.DataFrame(
        [("l", None, "a", 0, big + 1, 2), ("l", None, "b", 0, 5, 2), ("l", "t", "a", big, 0, 0), ("l", "u", "a", 1, 0, 0), ("l", "u", "b", 5, 0, 0)],
        columns=["lang", "term", "source", "n", "size", "terms"],
    )

    def p(c, size):
        return 1 + 10**9 * (c + 5) // (size + 10)

    expected = abs(p(big, big + 1) - p(0, 5)) + abs(p(1, big + 1) - p(5, 5))
    assert divergence.block_distances(block).distance.tolist() == [expected]


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
