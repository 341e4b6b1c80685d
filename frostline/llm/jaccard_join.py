"""Self-join of texts by the Jaccard similarity of their word shingles, by prefix filtering.

Every text is its set of shingles; texts with equal sets are one class. A class is posted under its rarest shingles
only, as many as any similar class must share one of. Classes that meet pass a length, a positional and a suffix
filter before their whole sets are compared, once. Rarity comes from counts over all documents.

A great group of near copies would meet in all pairs. So each class is first compared with the few classes that it
meets most often; what is linked by then needs no further comparing, and the second round joins classes of different components
only. The components, and which classes are linked, do not depend on that.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from frostline.llm.common import col, stored
from frostline.llm.components import components
from frostline.llm.shingles import shingle_set

#: Words of a shingle and the least similarity in per cent.
WORDS, PERCENT = 5, 80
#: Counters of shingles, as a power of two: four megabytes a task, whatever the corpus. Clashes only blur the order.
_COUNTERS, _SLICE = 22, 1 << 16
#: First rounds, neighbours looked at in a posting list, and classes that each class is compared with in a round. Most links of a large group of near copies soon
#: form one component, even if only a third of its pairs are similar enough.
ROUNDS, BESIDE, PARTNERS = 3, 5, 5
#: Ranges of the hash for the suffix filter.
_RANGES = 6
#: A class is known by 64 bits of its set's digest: n classes have about n * n / 2**65 false matches.
_DIGEST = 8


def _node(found: np.ndarray) -> int:
    return int.from_bytes(blake2b(found.tobytes(), digest_size=_DIGEST).digest(), "little", signed=True)


def _digests(docs: DataFrame, words: int) -> DataFrame:
    """A row per document with its class, set size and counts by hash range, and after each task's documents its
    counts of shingles (255 at most of each counter: what is that frequent comes last anyway)."""
    schema = "doc_id long, text_hash long, node long, n long, ranges array<tinyint>, slice int, counts binary"
    fields = ("doc_id", "text_hash", "node", "n", "ranges", "slice", "counts")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int8()), pa.int32(), pa.binary())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, held = np.zeros(1 << _COUNTERS, np.uint32), [], 0
        drop = np.uint64(64 - _COUNTERS)

        def count() -> None:
            if waiting:
                np.add(counts, np.bincount(np.concatenate(waiting), minlength=1 << _COUNTERS), out=counts, casting="unsafe")
                waiting.clear()

        for batch in batches:
            node, n, ranges = [], [], []
            for value in batch.column(2):
                found = shingle_set(value.as_py(), words)
                n.append(len(found))
                node.append(_node(found) if len(found) else None)
                by_range = np.bincount((found >> np.uint64(64 - _RANGES)).astype(np.intp), minlength=1 << _RANGES)
                ranges.append(np.minimum(by_range, 127).astype(np.int8))
                waiting.append((found >> drop).astype(np.intp))
                held += len(found)
                if held > 1 << 20:
                    count()
                    held = 0
            none = [None] * len(n)
            columns = [batch.column(0), batch.column(1), node, n, ranges, none, none]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=fields
            )
        count()
        for i in range(len(counts) // _SLICE):
            part = counts[i * _SLICE : (i + 1) * _SLICE]
            if part.any():
                row = [None, None, None, None, None, i, np.minimum(part, 255).astype(np.uint8).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=fields)

    return docs.mapInArrow(digest, schema)


def _counters(digests: DataFrame) -> np.ndarray:
    """The tasks' counts, added up."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(data.as_buffer(), np.uint8)
                total[i] = total[i] + part if i in total else part.astype(np.uint32)
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()), pa.array([total[k].astype("<u4").tobytes() for k in keys], pa.binary())], names=["slice", "counts"]
        )

    slices = (1 << _COUNTERS) // _SLICE
    out = np.zeros(1 << _COUNTERS, np.uint32)
    rows = digests.filter("slice is not null").select("slice", "counts").repartition(slices, "slice").mapInArrow(added, "slice int, counts binary")
    for r in rows.collect():
        out[r["slice"] * _SLICE : (r["slice"] + 1) * _SLICE] = np.frombuffer(r["counts"], "<u4")
    return out


def _rarity(counters: np.ndarray) -> np.ndarray:
    """The counters in a byte each: as they are up to 127, from there on by their logarithm. Only their order matters."""
    steps = 128 + 4 * (np.log2(np.maximum(counters, 128)) - 7)
    return np.where(counters < 128, counters, steps).astype(np.uint8)


def _posted(docs: DataFrame, counters: np.ndarray, words: int, percent: int) -> DataFrame:
    """node, n and the prefix (rarest shingles first) of every class with any shingle."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop = np.uint64(64 - _COUNTERS)
        for batch in batches:
            node, n, prefix = [], [], []
            for value in batch.column(0):
                found = shingle_set(value.as_py(), words)
                if not len(found):
                    continue
                take = len(found) - -(-percent * len(found) // 100) + 1
                rare = np.lexsort((found, counters[(found >> drop).astype(np.intp)]))[:take]
                node.append(_node(found))
                n.append(len(found))
                prefix.append(found[rare].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))], names=["node", "n", "prefix"]
            )

    return docs.select("text").mapInArrow(prefixes, "node long, n long, prefix array<long>").dropDuplicates(["node"])


def _may_link(n_a: Column, pos_a: Column, n_b: Column, pos_b: Column, percent: int) -> Column:
    """Length filter, and positional filter for a shingle that is the first the two share: what lies behind it must
    still suffice. (For later shared ones it may fail; the first one passes if any can.)"""
    least = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    left = 1 + F.least(n_a - pos_a - 1, n_b - pos_b - 1)
    return least & ((100 + percent) * left >= percent * (n_a + n_b))


def _near(percent: int) -> Column:
    """Suffix filter: the counts by hash range differ at least by so much that a pair can't be similar enough."""
    apart = F.aggregate(F.zip_with("ranges_a", "ranges_b", lambda x, y: F.abs(x.cast("int") - y)), F.lit(0), lambda s, x: s + x)
    return (100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n_b"))


def _similar_ranges(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    left, right = (classes.select(F.col("node").alias(x), F.col("ranges").alias(f"ranges_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    return pairs.select("a", "b").join(left, "a").join(right, "b").filter(_near(percent)).select("a", "b")


def _sets(docs: DataFrame, digests: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The whole sets of the wanted classes, from one document of each."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(value.as_py(), words) for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())], names=["node", "shingles"]
            )

    one = digests.filter("slice is null").join(wanted, "node", "left_semi").groupBy("node").agg(F.min("text_hash").alias("text_hash"))
    texts = docs.select("text_hash", "text").join(one.select("text_hash").distinct(), "text_hash", "left_semi")
    return texts.dropDuplicates(["text_hash"]).select("text").mapInArrow(whole, "node long, shingles binary").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(a, b, assume_unique=True))
                fine.append(100 * common >= percent * (len(a) + len(b) - common))
            fine = pa.array(fine, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(fine) for i in (0, 1)], names=["a", "b"])

    left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return rows.mapInArrow(compared, "a long, b long")


def linked(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Digest of every document (doc_id, text_hash, node, n), and links between classes that connect all that are
    reachable through similar pairs. ``docs`` has doc_id, text and text_hash."""
    digests = stored(_digests(docs.select("doc_id", "text_hash", "text"), words), "digests")
    members = digests.filter("slice is null")
    counters = _rarity(_counters(digests))
    classes = stored(members.filter("n > 0").select("node", "n", "ranges").dropDuplicates(["node"]), "classes")

    posts = _posted(docs, counters, words, percent).select("node", "n", F.posexplode("prefix").alias("pos", "shingle"))
    size = Window.partitionBy("shingle")
    met = stored(posts.withColumn("meets", F.count(F.lit(1)).over(size)).filter("meets > 1").drop("meets"), "met")

    first = _proposed(met.withColumn("root", F.col("node")), classes, percent, 0)
    sets = stored(_sets(docs, digests, _ends(first), words), "sets")
    links, tried = stored(_verified(first, sets, percent), "links"), first
    for turn in range(1, ROUNDS):
        known = met.join(sets.select("node"), "node", "left_semi")
        known = known.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
        further = stored(_proposed(known, classes, percent, turn).join(tried, ["a", "b"], "left_anti"), "further")
        found = stored(_verified(further, sets, percent), "links")
        links, tried = links.unionByName(found), tried.unionByName(further)

    roots = components(links)
    placed = met.select("shingle", "node", "n", "pos").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("shingle")
    open_posts = placed.join(mixed, "shingle", "left_semi").join(classes.select("node", "ranges"), "node")
    open_posts = stored(open_posts, "open")
    x, y = (open_posts.select("shingle", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "pos", "root", "ranges")]) for s in "ab")
    others = (
        x.join(y, "shingle")
        .filter("node_a < node_b and root_a <> root_b")
        .filter(_may_link(F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"), percent) & _near(percent))
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    second = stored(others, "second")
    more = _ends(second).join(sets.select("node"), "node", "left_anti")
    all_sets = sets.unionByName(stored(_sets(docs, digests, more, words), "sets"))
    links = links.unionByName(stored(_verified(second, all_sets, percent), "links"))
    return members, links


def _proposed(met: DataFrame, classes: DataFrame, percent: int, turn: int) -> DataFrame:
    """For every class a few of those of other components that it stands beside in the posting lists, in an order that
    is another in each turn, if they pass the filters. However long a list is, it proposes a few pairs for each entry."""
    beside = Window.partitionBy("shingle").orderBy(F.xxhash64("node", F.lit(turn)), "node")
    others = F.array(*[F.lag(F.struct("node", "n", "pos", "root"), i).over(beside) for i in range(1, BESIDE + 1)])
    pairs = met.withColumn("other", others).withColumn("other", F.explode("other")).filter("other.root <> root")
    pairs = pairs.filter(_may_link(F.col("n"), F.col("pos"), F.col("other.n"), F.col("other.pos"), percent))
    often = pairs.groupBy("node", F.col("other.node").alias("partner")).count()
    ranked = Window.partitionBy("node").orderBy(F.desc("count"), F.xxhash64("node", "partner"))
    best = often.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= PARTNERS)
    pairs = best.select(F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b")).distinct()
    return stored(_similar_ranges(pairs, classes, percent), "proposed")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def _prepared(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(col(doc_id).cast("long").alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"), col(text).alias("text"))


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles and component_id (the smallest doc_id that links reach) of every row.

    A document's set holds its distinct shingles; fewer words than a shingle has are one shingle. Null, empty and blank
    texts have an empty set and are linked with nothing, not even with one another. Rows with the same id and different
    texts are documents of their own. A null id stands in no component_id unless nothing else does. Texts of any length
    are read whole, an empty table gives no rows, and other columns are not read.
    """
    members, links = linked(_prepared(docs, doc_id, text), words, percent)
    least = members.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    reached = least.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = reached.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = reached.join(lowest, "root").select("node", "component_id")
    rows = members.select("doc_id", "text_hash", "node", F.col("n").alias("n_shingles")).join(of_class, "node", "left")
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "text_hash", "n_shingles", alone.alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of similar documents: the one with the smallest id, then text hash.

    Rows without words are all kept, as they are linked with nothing. All columns stay as they were, whatever their
    names. Of rows that share id and text and differ elsewhere one stays, no matter which. An empty table gives no rows.
    """
    members, links = linked(_prepared(docs, doc_id, text), words, percent)
    # Groups are told apart by node, not by the smallest id, which rows of different texts may share.
    named = members.filter("n > 0").join(components(links), "node", "left")
    named = named.select(F.coalesce("root", "node").alias("root"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash").alias("row"))
    stays = named.groupBy("root").agg(F.min("row").alias("row")).select("row.doc_id", "row.text_hash")
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, body = F.col(f"c{names.index(doc_id)}").cast("long"), F.col(f"c{names.index(text)}")
    hashed = inner.withColumn("text_hash", F.xxhash64(body)).withColumn("id", key)
    blank = ~F.coalesce(body, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    chosen = hashed.filter(~blank).join(stays, F.col("id").eqNullSafe(stays["doc_id"]) & (hashed["text_hash"] == stays["text_hash"]), "left_semi")
    chosen = chosen.dropDuplicates(["id", "text_hash"])
    return chosen.unionByName(hashed.filter(blank)).drop("id", "text_hash").toDF(*names)
