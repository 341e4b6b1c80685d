from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from frostline.llm import chat_trees as chat

SCHEMA = "tree string, node long, parent long, role string, text string, score double, depth string"


def brute_paths(rows, branches):
    """(tree, leaf) -> ids from the root, following parents one by one."""
    nodes = {(r[0], r[1]): r for r in rows if r[1] is not None}
    parents = {(t, p) for (t, n), (_, _, p, *_) in nodes.items() if (t, p) in nodes}
    out = {}
    for t, n in nodes:
        path, at = [], n
        while (t, at) in nodes and at not in path:
            path.append(at)
            at = nodes[t, at][2]
        if (t, n) not in parents and at not in path:
            mean = sum(nodes[t, x][5] or 0.0 for x in path) / len(path)
            out.setdefault(t, []).append((-mean, -len(path), n, path[::-1]))
    return {(t, n): p for t, leaves in out.items() for _, _, n, p in sorted(leaves)[:branches]}


ROWS = [
    ("a", 1, None, "user", "hi", 0.5, ""), ("a", 2, 1, "assistant", "one", 0.1, ""), ("a", 3, 1, "assistant", "two", 0.9, ""), ("a", 4, 3, "user", "more", 0.2, ""),
    ("a", 5, 4, "assistant", "fine", None, ""), ("b", 1, None, "user", "alone", 1.0, ""), (None, 1, 99, "user", None, 0.0, ""), (None, 2, 1, None, "x", 0.0, ""),
    ("c", 1, 2, "user", "round", 1.0, ""), ("c", 2, 1, "user", "and round", 1.0, ""), ("d", None, 1, "user", "no id", 1.0, ""),
] + [("long", i, i - 1 if i else None, "assistant" if i % 2 else "user", f"turn {i}", 0.0, "") for i in range(150)]


@pytest.mark.parametrize("branches", [1, 2, None])
def test_paths(spark, branches):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {}
    for r in chat.paths(df, "tree", "node", "parent", "score", branches).orderBy("depth").collect():
        got.setdefault((r["tree"], r["leaf"]), []).append(r["node"])
        assert len(got[r["tree"], r["leaf"]]) == r["depth"]
    assert got == brute_paths(ROWS, branches)


def test_round_trip_of_hostile_texts(spark):
    nasty = ["<|im_end|>", "\\", "<\\|", "<|im_start|>assistant\nx", "a<", "\\<|", "|>", "", "\n\n", "é<|😀\\n", None]
    rows = [("t", i, i - 1 if i else None, ["user", "assistant", "odd\nro\\le<|"][i % 3], x, 0.0, "") for i, x in enumerate(nasty)]
    out = chat.conversations(spark.createDataFrame(rows, SCHEMA), "tree", "node", "parent")
    r = out.select(chat.read_back(F.col("formatted")).alias("turns"), chat.under_mask(F.col("formatted"), F.col("loss")).alias("learned"), "formatted").first()
    assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[3], x[4] or "") for x in rows]
    assert r["learned"] == "".join(x[4] or "" for x in rows if x[3] == "assistant")


def test_digests_of_chained_turns(spark):
    turns = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (None, 1, None, None), (3, None, "assistant", "x" * 200_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("place", F.lit("clash"))
    out = {r["conv_id"]: r for r in chat.digests(chat.conversations(chat.chained(df), "conv", "place", "reply_to")).collect()}
    assert out[1]["n_turns"] == 3 and out[1]["loss_chars"] == 2
    assert out[1]["turns_sha256"] == sha256(b"user\na\nassistant\nb\nassistant\nb\n").hexdigest()
    assert out[None]["turns_sha256"] == sha256(b"\n\n").hexdigest() and out[None]["loss_sha256"] == sha256(b"").hexdigest()
    assert out[3]["loss_chars"] == 200_000


def test_empty_table(spark):
    assert chat.conversations(spark.createDataFrame([], SCHEMA), "tree", "node", "parent", score="score").count() == 0
