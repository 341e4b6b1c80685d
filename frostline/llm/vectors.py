"""Shared parts of the vector searches: usable rows, a bounded sample, and queries against all rows in blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from frostline.llm.common import blocks_of, col

#: Rows of a block, and queries that meet a block at a time. A task holds one block and one batch of queries.
ROWS, QUERIES = 8192, 4096
RESULT = "query_id long, vec_id long, score "


def usable(vectors: DataFrame, vec_id: str, embedding: str, query: Column, zero: bool) -> DataFrame:
    """vec_id, v (doubles) and is_query of rows whose id and components are all there and finite.

    Where vectors differ in length, only the commonest length (of equally common ones the longer) takes part. All-zero
    vectors stay if ``zero``.
    """
    infinite = F.lit(float("inf"))
    v = F.transform(col(embedding), lambda x: x.cast("double"))
    rows = vectors.select(col(vec_id).cast("long").alias("vec_id"), v.alias("v"), query.alias("is_query"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine)
    return rows if zero else rows.filter(F.exists("v", lambda x: x != 0))


def shape(rows: DataFrame) -> tuple[int, int, int, float]:
    """Length of the vectors that take part, how many there are, how many are queries, and the largest norm."""
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("queries"), F.sqrt(F.max(squares)).alias("norm")
    )
    top = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return (top[0]["d"], top[0]["n"], top[0]["queries"], top[0]["norm"]) if top else (0, 0, 0, 0.0)


def sample(rows: DataFrame, d: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of up to ``size`` different vectors of length ``d``: those whose hashes are lowest among a bounded
    draw. How much is drawn goes by the number of different vectors, however often they repeat."""
    rows = rows.withColumn("hash", F.xxhash64("v"))
    every = max(1, rows.agg(F.approx_count_distinct("hash")).first()[0] // (4 * size))
    drawn = rows.filter(F.pmod("hash", F.lit(every)) == 0)
    drawn = drawn.groupBy("hash").agg(F.min(F.struct("vec_id", "v")).alias("row")).orderBy("hash").limit(size).collect()
    ids = np.array([r["row"]["vec_id"] for r in drawn], np.int64)
    return ids, np.array([r["row"]["v"] for r in drawn], float).reshape(len(ids), d)


def meetings(index: DataFrame, total: int, queries: int) -> tuple[DataFrame, DataFrame]:
    """Every row with each batch of queries, and every query with each block of rows, both keyed by block and batch.

    Blocks come from a hash of the id, so they are even whatever the vectors; rows travel once for each batch of
    queries and queries once for each block.
    """
    blocks, batches = blocks_of(total, ROWS), blocks_of(queries, QUERIES)
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    batch = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(batches)).cast("int")
    rows = index.withColumn("block", block).withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    asked = index.filter("is_query").withColumn("batch", batch).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return rows, asked


def nearest(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score: the k best of each query, ties to the smaller id. An id found repeatedly
    (rows that share it) counts once, with its best score."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
