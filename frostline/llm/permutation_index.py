"""Approximate nearest neighbours with a permutation index.

Pivots are a bounded sample of the vectors. Every vector is represented by its nearest pivots in order, and posted
with their places in the inverted files of these pivots, block by block. A query adds up, over the inverted files of
its own nearest pivots, how far the footrule distance falls below that of permutations with nothing in common; the
best ranked rows of each block are ranked again by the exact measure, the inner product in double precision.

Vectors of different norms are compared with pivots as if lifted onto one sphere, on which the nearest vectors are
those of largest inner product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.llm import vectors as V
from frostline.llm.common import col, stored

#: Pivots, how many of them represent a vector, and the share (and least number) of a block's rows that is reranked.
PIVOTS, NEAREST, RERANKED, LEAST = 256, 64, 0.2, 200


def _represented(rows: DataFrame, pivots: np.ndarray, norm: float, nearest: int) -> DataFrame:
    """The index: vec_id, is_query, v and the nearest pivots, in order, as 16-bit numbers."""
    lifts = np.sqrt(np.maximum(norm * norm - (pivots * pivots).sum(axis=1), 0))

    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            lift = np.sqrt(np.maximum(norm * norm - (v * v).sum(axis=1), 0))
            near = v @ pivots.T
            for_rows = np.argsort(-(near + lift[:, None] * lifts), axis=1, kind="stable")[:, :nearest].astype("<u2")
            # A query looks for large inner products whatever its own norm: its lift is none.
            for_query = np.argsort(-near, axis=1, kind="stable")[:, :nearest].astype("<u2")
            coded = [pa.array([r.tobytes() for r in part], pa.binary()) for part in (for_rows, for_query)]
            body = pa.array([r.tobytes() for r in v.astype("<f8")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), body, *coded], names=["vec_id", "is_query", "v", "pivots", "asks"])

    return rows.select("vec_id", "v", "is_query").mapInArrow(represent, "vec_id long, is_query boolean, v binary, pivots binary, asks binary")


def _stacked(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


class InvertedFiles:
    """Posting lists of a block: for each pivot the rows that have it among their nearest, and its place there."""

    def __init__(self, permutations: np.ndarray, pivots: int) -> None:
        n, self.nearest = permutations.shape
        flat = permutations.ravel()
        order = np.argsort(flat, kind="stable")
        self.rows, self.places = order // self.nearest, order % self.nearest
        self.starts = np.searchsorted(flat[order], np.arange(pivots + 1))
        self.n = n

    def agreement(self, asked: np.ndarray) -> np.ndarray:
        """For each row, half of what its footrule distance lies below the largest possible: a pivot that both have
        takes off the nearest count less the later of its two places, twice."""
        total = np.zeros(self.n, np.int64)
        for place, pivot in enumerate(asked):
            at = slice(self.starts[pivot], self.starts[pivot + 1])
            total[self.rows[at]] += self.nearest - np.maximum(self.places[at], place)
        return total


def _searcher(pivots: int, k: int, reranked: float, least: int):
    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            rows = rows.sort_values("vec_id", kind="stable")
            ids, body = rows["vec_id"].to_numpy(), _stacked(rows["v"], "<f8")
            files = InvertedFiles(_stacked(rows["pivots"], "<u2"), pivots)
            # Ids are ranked, not rows: each by its best row, however many rows share it.
            starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            of_id = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(ids)))
            take = min(len(starts), max(least, int(np.ceil(reranked * len(starts)))))
            back = np.arange(len(starts))[::-1]
            for query, v, near in zip(asked["vec_id"], _stacked(asked["v"], "<f8"), _stacked(asked["asks"], "<u2")):
                ranked = np.maximum.reduceat(files.agreement(near), starts) * len(starts) + back
                chosen = np.zeros(len(starts), bool)
                chosen[np.argpartition(-ranked, take - 1)[:take]] = True
                best = np.flatnonzero(chosen[of_id] & (ids != query))
                score = (body[best] * v).sum(axis=1)  # equal vectors get equal scores, wherever they stand
                top = np.lexsort((ids[best], -score))
                top = top[np.sort(np.unique(ids[best][top], return_index=True)[1])[:k]]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[best][top], "score": score[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return search


def search(
    vectors: DataFrame,
    query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    pivots: int = PIVOTS,
    nearest: int = NEAREST,
    reranked: float = RERANKED,
    least: int = LEAST,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k rows found for each row that is a ``query``, itself left out.

    Null ids, null or zero vectors and vectors with null or non-finite components take no part, nor do those of
    another than the commonest length. Rows that share an id count as one row, with the best score. Ties go to the
    smaller id. Without queries or rows there are no results.
    """
    rows = V.usable(vectors, vec_id, embedding, query, zero=False)
    d, total, queries, norm = V.shape(rows)
    rows = rows.filter(F.size("v") == d)
    if not queries:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    _, chosen = V.sample(rows, d, pivots)
    index = stored(_represented(rows, chosen, norm, min(nearest, len(chosen))), "index")
    there, asked = V.meetings(index, total, queries)
    found = there.groupBy("block", "batch").cogroup(asked.groupBy("block", "batch"))
    return V.nearest(found.applyInPandas(_searcher(len(chosen), k, reranked, least), V.RESULT + "double"), k)


def every(n: int, vec_id: str = "vec_id") -> Column:
    """Rows whose id is divisible by n are queries."""
    return F.coalesce(col(vec_id) % n == 0, F.lit(False))
