"""How far sources of a language differ in their use of terms: an audit by count-level bitmaps.

Each language keeps the terms that enough of its documents have. A group (language and source) gives every kept term a
smoothed probability in whole billionths, which depends on the term's count alone. So two sources are compared by
counts, not by terms: for each count that a group has, a bitset says which terms have it; AND and popcount of two such
bitsets give the number of terms with this pair of counts, which is multiplied by their distance. Terms that one or
both groups lack come by complement.

Terms are dealt to blocks of like total count, and bitsets are of a block's terms. Rare terms have few different counts
and go in wide blocks; frequent ones have many and go in narrow ones. Blocks add up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from frostline.llm.common import bounded_batches, col, stored

#: Documents of a language that must have a term, and ranks of a group's own terms.
DOCUMENTS, TERMS = 30, 50
#: Added to each count, and what probabilities are counted in.
SMOOTH, UNITS = 5, 1_000_000_000
#: Widest and narrowest block in terms; in between, width times total count is 2**20. Rows that a block has about, at most.
WIDE, NARROW, PRODUCT, ROWS = 4096, 64, 20, 20_000
#: Counters that a task holds before it puts them out.
HELD = 300_000

#: A term's bytes as they are, A to Z lower-cased, and a space for all else: bytes of other characters are 128 and up.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, documents long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, as far as a task has seen; a group's rows may be several."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def put() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, documents) in held.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(n), pa.string()),
                    pa.array([source] * len(n), pa.string()),
                    terms,
                    pa.array(list(n.values()), pa.int64()),
                    pa.array([documents[t] for t in n], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "documents"],
            )
        held.clear()

    size = 0
    for batch in batches:
        langs, sources, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())
        for lang, source, text in zip(langs, sources, texts, strict=True):
            terms = text.as_py().translate(_TERM_BYTES).split()
            n, documents = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(n)
            n.update(terms)
            documents.update(set(terms))
            size += len(n)
            if size > HELD:
                yield from put()
                size = 0
    yield from put()


def kept_terms(docs: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """lang, term, source, n, all_n and leads of the terms that at least so many documents of the language have.

    n counts the term in the source, all_n in the language; leads marks one row of each term. ``docs`` has lang, source
    and text without nulls. Every row is a document, repeated ones too.
    """
    bounded_batches(docs.sparkSession)
    counts = docs.select("lang", "source", "text").mapInArrow(_counted, _COUNTS)
    # Dealt by term at once: tasks have combined their rows, and the totals over sources need no second exchange.
    by_source = (
        counts.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    )
    whole = Window.partitionBy("lang", "term")
    return (
        by_source.withColumn("everywhere", F.sum("documents").over(whole))
        .withColumn("all_n", F.sum("n").over(whole))
        .withColumn("leads", F.min("source").over(whole) == F.col("source"))
        .filter(F.col("everywhere") >= documents)
        .drop("documents", "everywhere")
    )


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, size, all_size and terms of every group of ``docs``: kept occurrences in the group and in the
    language, and the language's kept terms. Groups without any have zeros."""
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    terms = kept.groupBy("lang").agg(F.sum("n").alias("all_size"), F.sum(F.col("leads").cast("long")).alias("terms"))
    rows = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(terms, "lang", "left")
    zero = F.lit(0).cast("long")
    return rows.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("size", "all_size", "terms")])


def probability(n: Column, size: Column, terms: Column) -> Column:
    """Billionths, rounded down, and one more; exact for any count."""
    decimal = "decimal(20,0)"
    above = F.lit(UNITS).cast("decimal(10,0)") * (n + SMOOTH).cast(decimal)
    below = size.cast(decimal) + SMOOTH * terms.cast(decimal)
    return F.call_function("div", above, below) + 1


def excess_terms(kept: DataFrame, groups: DataFrame, ranks: int | None = TERMS) -> DataFrame:
    """lang, source, item, value and rank: terms that a group uses more than its language does, by how much."""
    rows = kept.join(groups, ["lang", "source"])
    own = probability(F.col("n"), F.col("size"), F.col("terms"))
    common = probability(F.col("all_n"), F.col("all_size"), F.col("terms"))
    rows = rows.select("lang", "source", F.col("term").alias("item"), (own - common).alias("value")).filter("value > 0")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(best))
    return ranked if ranks is None else ranked.filter(F.col("rank") <= ranks)


def _level_bits(terms: np.ndarray, n: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The different counts, and for each a bitset of the terms that have it."""
    levels, level = np.unique(n, return_inverse=True)
    grid = np.zeros((len(levels), -(-width // 64) * 64), bool)
    grid[level, terms] = True
    return levels, np.packbits(grid, axis=1).view(np.uint64)


def block_distances(block: pd.DataFrame) -> pd.DataFrame:
    """source, other and distance over a block's terms of each two sources, the smaller name first.

    Rows without term name the language's sources with their size and number of terms; others are counts.
    """
    marks, rows = block[block.n == 0].sort_values("source"), block[block.n > 0]
    sources, terms = marks.source.tolist(), pd.factorize(rows.term)[0]
    width = int(terms.max()) + 1 if len(terms) else 0  # a block may have got none
    number = pd.Index(sources).get_indexer(rows.source)
    n, groups = rows.n.to_numpy(np.int64), []
    for i, (size, all_terms) in enumerate(zip(marks["size"].tolist(), marks.terms.tolist(), strict=True)):
        own = number == i
        levels, bits = _level_bits(terms[own], n[own], width)
        below = int(size) + SMOOTH * int(all_terms)
        p = np.array([1 + UNITS * (c + SMOOTH) // below for c in levels.tolist()], np.int64)
        groups.append((p, 1 + UNITS * SMOOTH // below, bits, np.bitwise_count(bits).sum(axis=1, dtype=np.int64)))
    out: tuple[list, list, list] = ([], [], [])
    for i, (p, p_zero, bits, sums) in enumerate(groups):
        for j in range(i):
            q, q_zero, others, other_sums = groups[j]
            joint = np.bitwise_count(bits[:, None, :] & others[None, :, :]).sum(axis=2, dtype=np.int64)
            distance = int((joint * np.abs(p[:, None] - q[None, :])).sum())
            distance += int(((sums - joint.sum(axis=1)) * np.abs(p - q_zero)).sum())
            distance += int(((other_sums - joint.sum(axis=0)) * np.abs(p_zero - q)).sum())
            distance += (width - int(sums.sum()) - int(other_sums.sum()) + int(joint.sum())) * abs(p_zero - q_zero)
            for column, value in zip(out, (sources[j], sources[i], distance), strict=True):
                column.append(value)
    return pd.DataFrame({"lang": block.lang.iloc[0], "source": out[0], "other": out[1], "distance": np.array(out[2], np.int64)})


def source_distances(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value and rank: all other sources of a group's language by their distance, the farthest first.

    ``kept`` is read twice, and its terms are dealt to blocks whose number follows from how many there are.
    """
    kept = kept.withColumn("magnitude", F.floor(F.log2("all_n")).cast("int"))
    width = F.least(F.lit(WIDE), F.greatest(F.lit(NARROW), F.pow(2.0, PRODUCT - F.col("magnitude"))))
    blocks = F.greatest(F.ceil(F.sum(F.col("leads").cast("long")) / width), F.ceil(F.count(F.lit(1)) / ROWS))
    dealt = stored(kept.groupBy("lang", "magnitude").agg(blocks.cast("long").alias("blocks")), "blocks")
    zero = F.lit(0).cast("long")
    counts = kept.join(dealt, ["lang", "magnitude"]).select(
        "lang", "magnitude", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "term", "source", "n",
        zero.alias("size"), zero.alias("terms"),
    )
    every = dealt.withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    marks = every.join(groups, "lang").select("lang", "magnitude", "block", F.lit(None).cast("string").alias("term"), "source", zero.alias("n"), "size", "terms")
    distances = (
        counts.unionByName(marks)
        .groupBy("lang", "magnitude", "block")
        .applyInPandas(block_distances, "lang string, source string, other string, distance long")
        .groupBy("lang", "source", "other")
        .agg(F.sum("distance").alias("value"))
    )
    # Nothing kept: all distances are zero.
    bare = groups.filter("terms = 0")
    others = bare.select("lang", F.col("source").alias("other"))
    distances = distances.unionByName(bare.join(others, "lang").filter("source < other").select("lang", "source", "other", zero.alias("value")))
    both = F.explode(
        F.array(
            F.struct(F.col("source").alias("source"), F.col("other").alias("item")),
            F.struct(F.col("other").alias("source"), F.col("source").alias("item")),
        )
    )
    rows = distances.select("lang", "value", both.alias("pair")).select("lang", "pair.source", "pair.item", "value")
    farthest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(farthest))


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", documents: int = DOCUMENTS, ranks: int | None = TERMS
) -> DataFrame:
    """lang, source, part, item, value and rank of every group.

    Part ``pair`` ranks the other sources of the language by distance, part ``term`` the terms that the group uses more
    than its language; both by value, then item. Null languages, sources and texts are empty strings. A repeated row is
    a document of its own; other columns are not read; texts and terms may be of any length; an empty table gives no
    rows. Languages without a kept term have distances of zero and no terms.
    """
    empty = F.lit("")
    own = docs.select(*[F.coalesce(col(c), empty).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = stored(kept_terms(own, documents), "kept")
    groups = stored(group_sizes(own, kept), "groups")
    pairs, terms = source_distances(kept, groups), excess_terms(kept, groups, ranks)
    names = ["lang", "source", "part", "item", "value", "rank"]
    parts = [rows.withColumn("part", F.lit(part)).select(names) for rows, part in ((pairs, "pair"), (terms, "term"))]
    return parts[0].unionByName(parts[1])
