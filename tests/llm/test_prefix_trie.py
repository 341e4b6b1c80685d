"""The trie against prefixes counted one by one, with ranges of any size."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.llm import prefix_trie
from frostline.llm.common import stored

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def digest(role, text):
    return sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()[:32]


def lists(rows):
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            by[conv].append((turn is not None, turn or 0, role, digest(role, text), text))
    return {c: [(t[2], t[4]) for t in sorted(own)] for c, own in by.items()}


def shared_heads(own):
    def h(c):
        return zlib.crc32(str(c).encode()) % 6

    return {c: own.get(c - c % 100, [])[: h(c)] + turns[h(c) :] for c, turns in own.items()}


def brute(convs):
    """``convs`` has pairs of id and turns."""
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in convs:
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    ends = defaultdict(list)
    for c, turns in convs:
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (min(own), len(n), min(members[n[:-1]]) if n else None, len(own), len(children[n]), leaves[n], saved[n], sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, own in members.items()
    )


def found(df):
    return sorted(tuple(r) for r in df.collect())


def made(seed, convs, words, hot=0):
    """Conversations that often open alike; ``hot`` more are copies of one."""
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice("abcdé"[:words]) * rng.randrange(2), "x"))
    for c in range(convs, convs + hot):
        rows += [(c, t, "user", f"same {t}", "x") for t in range(4)]
    return rows + [(7, None, None, None, ""), (7, None, None, None, ""), (3, 2, "user", "tie", ""), (3, 2, "user", "also", ""), (None, 1, "user", "nobody", "")]


@pytest.mark.parametrize("few", [8, 64, 1 << 12])
def test_equals_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(prefix_trie, "FEW_TURNS", few)
    monkeypatch.setattr(prefix_trie, "TURNS", 4 * few)
    rows = made(1, 260, 2, hot=120)
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    own = stored(prefix_trie.turn_lists(df), "test")
    assert found(prefix_trie.trie(own)) == brute(list(lists(rows).items()))
    got = prefix_trie.trie(prefix_trie.with_shared_heads(own))
    assert found(got) == brute(list(shared_heads(lists(rows)).items()))
    assert [f.dataType.simpleString() for f in got.schema][:7] == ["bigint"] * 7


def test_bases_that_are_absent_and_conversations_left_without_turns(spark):
    rows = [(c, 0, "user", "only", "") for c in (101, 105, 250, 333, 410, 1099)] + [(300, t, "user", str(t), "") for t in range(3)]
    own = prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA))
    expected = shared_heads(lists(rows))
    assert any(not t for t in expected.values())
    assert found(prefix_trie.trie(prefix_trie.with_shared_heads(own))) == brute(list(expected.items()))


def test_repeated_ids_null_turns_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TURNS", 100)
    long = [(digest("user", str(i % 7)), len(str(i % 7))) for i in range(300)]
    rows = [(5, long), (5, long), (9, long[:250]), (2, None), (2, []), (None, long), (11, long[:10] + long[:100])]
    df = spark.createDataFrame(rows, "conv_id long, turns array<struct<digest:string,chars:long>>").withColumn("key", F.lit(0))
    convs = [(c, [(d, "x" * n) for d, n in turns or []]) for c, turns in rows if c is not None]
    assert found(prefix_trie.trie(df)) == brute(convs)


def test_empty_table(spark):
    assert prefix_trie.trie(prefix_trie.with_shared_heads(prefix_trie.turn_lists(spark.createDataFrame([], SCHEMA)))).count() == 0


def test_extents_equal_plain_scans():
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 17, 64):
        values = rng.integers(0, 4, size)
        table = prefix_trie.RangeMinimum(values)
        for least in range(5):
            at = np.arange(size + 1)
            left = [next((j + 1 for j in range(i - 1, -1, -1) if values[j] < least), 0) for i in at]
            right = [next((j for j in range(i, size) if values[j] < least), size) for i in at]
            assert table.leftmost(at, np.full(size + 1, least)).tolist() == left
            assert table.rightmost(at, np.full(size + 1, least)).tolist() == right
        first, last = np.triu_indices(size)
        assert table.smallest(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last, strict=True)]
