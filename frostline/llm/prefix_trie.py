"""A trie of conversation prefixes, by range minima over sorted neighbours.

Conversations become keys, the digests of their turns in order, and are sorted; those that start alike lie side by side.
Adjacent keys have a number of turns in common, and a prefix of d turns spans the places around it over which that
number stays at d or more. A sparse table of minima over all power-of-two stretches lets each candidate prefix
binary-search its left and its right extent on its own, all of them at once in numpy. The extents give members, smallest
ids and subtrees, which are runs of nodes in sorted order.

The sorted keys are cut into ranges, whatever prefix they share, a range to a task. A node within a range is complete
there. Only prefixes of a range's first or last key may reach over its border; these few are put together by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from frostline.llm.common import bounded_batches, col, stored

#: Bytes of a turn's digest, and turns that a range has: no more than the larger number, no fewer than the smaller one
#: while there are enough ranges for all tasks.
DIGEST, TURNS, FEW_TURNS = 16, 1 << 20, 1 << 12
#: What a range puts out: complete nodes, and parts of edge nodes, which have a digest as ``node``. An inner node whose
#: parent is an edge node has the parent's digest instead of its id. ``range`` and ``place`` order edge nodes; from_first
#: and to_last say which ends of the range a node reaches; ``ended`` has the ids that end in an edge node.
_RANGE_ROWS = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string,"
    " range int, place long, node string, parent string, from_first boolean, to_last boolean, chars long, ended string"
)
_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_NONE_ENDED = hashlib.sha256(b"").hexdigest()
_ROWS_AT_ONCE = 1 << 16


def turn_lists(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and turns of every conversation: an array of digest and chars, by turn.

    A null turn comes first; rows of one turn follow by role, then by digest, and repeated rows are turns of their own.
    Null roles and texts are empty. Rows without conversation take no part. Texts stay where they are: a turn is shuffled
    as a digest of role and text.
    """
    said, by = F.coalesce(col(text), F.lit("")), F.coalesce(col(role), F.lit(""))
    # Half of a SHA-256 over the role's length, role and text, in hexadecimal.
    digest = F.substr(F.sha2(F.concat_ws(":", F.length(by).cast("string"), by, said), 256), F.lit(1), F.lit(2 * DIGEST))
    said = F.struct(col(turn).alias("turn"), by.alias("role"), digest.alias("digest"), F.length(said).cast("long").alias("chars"))
    rows = turns.select(col(conv).cast("long").alias("conv_id"), said.alias("said")).filter("conv_id is not null")
    lists = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def with_shared_heads(lists: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Conversations as if each hundred had opened alike: the first h turns of conversation c - c % every, then c's own
    after its first h; h is the CRC-32 of the decimal c modulo ``most`` + 1."""
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    heads = lists.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("opens"), F.slice("turns", 1, most).alias("head"))
    rows = lists.withColumn("opens", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h).join(heads, "opens", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return rows.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


class RangeMinimum:
    """Minima over every stretch of a power of two places, for extents to be found by halving steps."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows, step = [values], 1
        while 2 * step <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def leftmost(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place from which all values before ``at`` are at least ``least``."""
        at = at.copy()
        for i in reversed(range(len(self.rows))):
            back = at - (1 << i)
            at = np.where((back >= 0) & (self.rows[i][np.clip(back, 0, len(self.rows[i]) - 1)] >= least), back, at)
        return at

    def rightmost(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place up to which all values from ``at`` on, without its own, are at least ``least``."""
        at = at.copy()
        for i in reversed(range(len(self.rows))):
            row = self.rows[i]
            at = np.where((at < len(row)) & (row[np.clip(at, 0, len(row) - 1)] >= least), at + (1 << i), at)
        return at

    def smallest(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The minimum from ``first`` to ``last``, both included."""
        out, level = np.empty(len(first), np.int64), np.frexp(last - first + 1)[1] - 1
        for i, row in enumerate(self.rows):
            own = level == i
            out[own] = np.minimum(row[first[own]], row[last[own] - (1 << i) + 1])
        return out


def common_turns(keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Turns that each key shares with the next. ``keys`` holds two numbers for each turn of all keys in a row."""
    shared = np.zeros(max(0, len(lengths) - 1), np.int64)
    alike = np.arange(len(shared))
    depth = 0
    while len(alike):
        alike = alike[np.minimum(lengths[alike], lengths[alike + 1]) > depth]
        same = (keys[starts[alike] + depth] == keys[starts[alike + 1] + depth]).all(axis=1)
        alike, depth = alike[same], depth + 1
        shared[alike] = depth
    return shared


def range_nodes(ids: np.ndarray, lengths: np.ndarray, keys: np.ndarray, chars: np.ndarray) -> dict[str, np.ndarray]:
    """The nodes of a sorted range, in order of first member and depth.

    Counts, leaves and savings of edge nodes, which may reach over the border, leave out edge nodes below them.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    shared = common_turns(keys, starts, lengths)
    table, id_table = RangeMinimum(shared) if len(shared) else None, RangeMinimum(ids)
    place = np.repeat(np.arange(len(ids)), lengths + 1)
    first_of = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    depth = np.arange(len(place)) - first_of[place]
    left = table.leftmost(place, depth) if table else place
    own = left == place
    start, deep = place[own], depth[own]
    end = table.rightmost(start, deep) if table else start
    n, count = end - start + 1, len(start)
    number = np.cumsum(own) - 1  # of the node that starts at a candidate
    parent = np.where(deep > 0, number[first_of[left[np.flatnonzero(own) - (deep > 0)]] + deep - 1], -1)
    last = np.searchsorted(start, end, side="right") - 1  # of its subtree, which follows it
    edge = (start == 0) | (end == len(ids) - 1)
    inner = ~edge
    children = np.bincount(parent[inner], minlength=count) if inner.any() else np.zeros(count, np.int64)
    text = np.where(deep > 0, np.append(chars, 0)[starts[start] + deep - 1], 0)
    leaf = inner & (last == np.arange(count))

    def below(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[last + 1] - sums[:-1]

    changes = np.flatnonzero(np.concatenate([[True], (shared < lengths[:-1]) | (shared < lengths[1:])]))
    after = np.concatenate([changes, [len(ids)]])[np.searchsorted(changes, start, side="right")]
    return {
        "depth": deep, "n": n, "smallest": id_table.smallest(start, end), "parent": parent, "edge": edge, "children": children,
        "leaves": below(leaf), "saved": below(np.where(inner, (n - 1) * text, 0)), "chars": text,
        "from_first": start == 0, "to_last": end == len(ids) - 1,
        # Members that have no further turn come first, and are alike.
        "ended_from": start, "ended_to": np.where(lengths[start] == deep, after, start),
    }


def _prefix_digests(key: bytes) -> list[str]:
    """Of the prefixes of 0, 1, 2, ... turns."""
    state, out = hashlib.sha256(), [_NONE_ENDED]
    for i in range(0, len(key), DIGEST):
        state.update(key[i : i + DIGEST])
        out.append(state.copy().hexdigest())
    return out


def _range_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a task's range; its rows are range, conv_id, key and chars, sorted by key and conv_id."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    number = table.column("range")[0].as_py()
    ids = table.column("conv_id").to_numpy()
    keys = table.column("key").to_pylist()
    lengths = np.array([len(k) // DIGEST for k in keys], np.int64)
    first, last = _prefix_digests(keys[0]), _prefix_digests(keys[-1])
    numbers = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, DIGEST // 8)
    chars = table.column("chars").combine_chunks().flatten().to_numpy()
    del keys, table, held
    nodes = range_nodes(ids, lengths, numbers, chars)
    edge, parent, depth = nodes["edge"], nodes["parent"], nodes["depth"]
    places = np.cumsum(edge) - 1

    def digest(i: int) -> str:
        return (first if nodes["from_first"][i] else last)[depth[i]]

    for begin in range(0, len(depth), _ROWS_AT_ONCE):
        part = slice(begin, begin + _ROWS_AT_ONCE)
        rows, at_edge = range(len(depth))[part], edge[part]
        below_edge = (parent[part] >= 0) & edge[parent[part]]
        ended = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(nodes["ended_from"][part], nodes["ended_to"][part], strict=True)]
        columns = {
            "conv_id": pa.array(nodes["smallest"][part]),
            "depth": pa.array(depth[part]),
            "parent_conv_id": pa.array(nodes["smallest"][parent[part]], mask=at_edge | below_edge),
            "n_convs": pa.array(nodes["n"][part]),
            "n_children": pa.array(nodes["children"][part]),
            "n_leaves": pa.array(nodes["leaves"][part]),
            "saved_tokens": pa.array(nodes["saved"][part]),
            "ends_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() if x else _NONE_ENDED for x in ended]),
            "range": pa.array(np.full(len(rows), number, np.int32)),
            "place": pa.array(places[part]),
            "node": pa.array([digest(i) if edge[i] else None for i in rows], pa.string()),
            "parent": pa.array([digest(parent[i]) if parent[i] >= 0 and edge[parent[i]] else None for i in rows], pa.string()),
            "from_first": pa.array(nodes["from_first"][part]),
            "to_last": pa.array(nodes["to_last"][part]),
            "chars": pa.array(nodes["chars"][part]),
            "ended": pa.array([x if e else None for x, e in zip(ended, at_edge, strict=True)], pa.string()),
        }
        yield pa.RecordBatch.from_pydict(columns)


def _joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and ends_sha256; a node's pieces come in order, and only the digest's state is held."""
    held, state, some = None, None, False
    for batch in batches:
        nodes, digests = [], []
        for node, ended in zip(batch.column("node").to_pylist(), batch.column("ended").to_pylist(), strict=True):
            if node != held:
                if held is not None:
                    nodes.append(held)
                    digests.append(state.hexdigest())
                held, state, some = node, hashlib.sha256(), False
            if ended:
                state.update(f",{ended}".encode() if some else ended.encode())
                some = True
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def _whole_edges(parts: DataFrame) -> DataFrame:
    """Edge nodes with what all their ranges have of them, and in each the edge nodes below."""
    whole = parts.groupBy("node").agg(
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.max("chars").alias("chars"),
        F.min("range").alias("owner"),
    )
    below = whole.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("edges_below"))
    whole = whole.join(below, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("edges_below", F.lit(0)))
    whole = stored(whole.drop("edges_below"), "edges")
    # A node's own leaf and savings count in the range where it starts, there for all nodes above it. In a range the
    # prefixes of its first key come first by depth, then those that only the last key starts with.
    own = parts.join(whole.select("node", "owner", F.col("n_convs").alias("all_convs"), F.col("n_children").alias("all_children")), "node")
    starts = F.col("owner") == F.col("range")
    amounts = {"n_leaves": F.when(starts & (F.col("all_children") == 0), 1).otherwise(0), "saved_tokens": F.when(starts, (F.col("all_convs") - 1) * F.col("chars")).otherwise(0)}
    later, all_of = Window.partitionBy("range").orderBy(F.desc("place")), Window.partitionBy("range")
    sums = {
        c: F.sum(x).over(later) - F.when(F.col("from_first") & ~F.col("to_last"), F.sum(F.when(~F.col("from_first"), x).otherwise(0)).over(all_of)).otherwise(0)
        for c, x in amounts.items()
    }
    below = own.select("node", *[(F.col(c) + x).alias(c) for c, x in sums.items()]).groupBy("node").agg(*[F.sum(c).alias(c) for c in sums])
    ends = parts.select("node", "range", "ended").repartition("node").sortWithinPartitions("node", "range").mapInArrow(_joined_ends, "node string, ends_sha256 string")
    above = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(below, "node").join(ends, "node").join(above, "parent", "left")


def trie(lists: DataFrame) -> DataFrame:
    """A row for each distinct sequence of first turns, the empty one included.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves
    (childless nodes below, itself included), saved_tokens (code points of last turns that all but one member share, over
    the subtree), ends_sha256 (SHA-256 of the members without a further turn, decimal, ascending, joined by commas).

    ``lists`` has conv_id and turns, an array of digest (32 hexadecimal digits) and chars, as ``turn_lists`` gives them. A row without id takes
    no part, null turns are none, an id that occurs twice is two members. A conversation is one value, however long. No
    rows, no root.
    """
    spark = lists.sparkSession
    bounded_batches(spark)
    key = F.unhex(F.coalesce(F.array_join(F.transform("turns", lambda t: t["digest"]), ""), F.lit("")))
    chars = F.coalesce(F.transform("turns", lambda t: t["chars"]), F.array().cast("array<bigint>"))
    keyed = stored(lists.filter("conv_id is not null").select("conv_id", key.alias("key"), chars.alias("chars")), "keys")
    total = keyed.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, -(-total // TURNS), min(-(-total // FEW_TURNS), tasks))
    dealt = keyed.repartitionByRange(ranges, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    # Written once: another run of the range partitioner might draw other borders.
    rows = stored(dealt.select(F.spark_partition_id().alias("range"), "conv_id", "key", "chars").mapInArrow(_range_rows, _RANGE_ROWS), "nodes")
    parts = rows.filter("node is not null")
    edges = stored(_whole_edges(parts), "whole")
    # By range too, so that a parent of a great many nodes is no burden to one task.
    known = parts.select("range", "node").join(edges.select("node", "conv_id"), "node").select("range", F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    inner = rows.filter("node is null")
    below = inner.filter("parent is not null").join(known, ["range", "parent"]).withColumn("parent_conv_id", F.col("above"))
    return inner.filter("parent is null").select(*_COLUMNS).unionByName(below.select(*_COLUMNS)).unionByName(edges.select(*_COLUMNS))
