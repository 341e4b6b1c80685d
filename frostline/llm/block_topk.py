"""Exact top-k search by block-at-a-time pruning.

Vectors of integers are documents whose terms are components, positive and negative parts apart. Each task has a
range of documents in an order that puts similar ones together, cut into small blocks with the largest and smallest
weight of every term. A query sums term maxima into a bound for each block, takes the blocks from the highest bound
down, scores their documents through the forward index, and stops where the bound falls below its kth score. That
starts from the kth score in a bounded sample, which no range can undercut.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.llm import vectors as V
from frostline.llm.common import stored

#: Documents of a block, blocks that are scored at a time, and vectors of the sample.
BLOCK, AT_A_TIME, SAMPLE = 64, 8, 2048
#: Sums of products below this are exact in double precision.
_EXACT = 2**53


class ForwardBlocks:
    """A document range: documents in blocks of similar ones, their weights, and term maxima and minima per block."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, leaders: np.ndarray, block: int = BLOCK) -> None:
        near = np.argmax(weights.astype(float) @ leaders.T.astype(float), axis=1) if len(leaders) else np.zeros(len(ids), int)
        order = np.lexsort((ids, near))
        self.ids, self.weights, self.block = ids[order], weights[order], block
        starts = np.arange(0, len(ids), block)
        self.highest = np.maximum.reduceat(self.weights, starts, axis=0)
        self.lowest = np.minimum.reduceat(self.weights, starts, axis=0)

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """Summed term maxima: no document of a block scores more."""
        return self.highest @ np.maximum(query, 0) + self.lowest @ np.minimum(query, 0)

    def top(self, own: int, query: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k that score at least ``floor``, without the query's own id."""
        bounds = self.bounds(query)
        order = np.argsort(-bounds, kind="stable")
        ids, scores = np.zeros(0, np.int64), np.zeros(0, self.weights.dtype)
        for i in range(0, len(order), AT_A_TIME):
            blocks = order[i : i + AT_A_TIME]
            blocks = blocks[bounds[blocks] >= floor]
            if not len(blocks):
                break
            at = (blocks[:, None] * self.block + np.arange(self.block)).ravel()
            at = at[at < len(self.ids)]
            score = self.weights[at] @ query
            fine = (score >= floor) & (self.ids[at] != own)
            ids, scores = np.concatenate((ids, self.ids[at][fine])), np.concatenate((scores, score[fine]))
            if len(ids) > k:
                best = np.lexsort((ids, -scores))
                best = best[np.sort(np.unique(ids[best], return_index=True)[1])[:k]]  # an id's best row, then the k best ids
                ids, scores = ids[best], scores[best]
                if len(ids) == k:
                    floor = max(floor, scores[-1])
        best = np.lexsort((ids, -scores))
        ids, scores = ids[best], scores[best]
        first = np.sort(np.unique(ids, return_index=True)[1])[:k]
        return ids[first], scores[first]


def _floors(ids: np.ndarray, weights: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """For each query, the kth score among the sampled documents, or nothing to go by."""
    order = np.argsort(sample_ids, kind="stable")
    different, starts = np.unique(sample_ids[order], return_index=True)
    if len(different) <= k:
        return np.full(len(ids), -np.inf)
    scores = (weights @ sample[order].T).astype(float)
    scores = np.maximum.reduceat(scores, starts, axis=1)  # rows that share an id count as one, with the best score
    scores[ids[:, None] == different[None, :]] = -np.inf
    return np.partition(scores, -k, axis=1)[:, -k]


def _searcher(sample_ids: np.ndarray, sample: np.ndarray, k: int, exact: bool):
    kind = np.float64 if exact else np.int64

    def stacked(column: pd.Series) -> np.ndarray:
        return np.stack(column.to_numpy()).astype(kind)

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            blocks = ForwardBlocks(rows["vec_id"].to_numpy(), stacked(rows["v"]), sample[:64].astype(kind))
            ids, weights = asked["vec_id"].to_numpy(), stacked(asked["v"])
            for own, query, floor in zip(ids, weights, _floors(ids, weights, sample_ids, sample.astype(kind), k)):
                found, scores = blocks.top(own, query, k, floor)
                out.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": scores.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return search


def search(vectors: DataFrame, query: Column, k: int = 20, scale: int = 64, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: for each row that is a ``query`` the k highest integer inner products.

    Components become floor(scale * x). Null ids, null vectors and vectors with null or non-finite components take no
    part, nor do those of another than the commonest length; zero vectors do. Rows that share an id count as one row,
    with the best score. Ties go to the smaller id. Scores must fit 64 bits.
    """
    rows = V.usable(vectors, vec_id, embedding, query, zero=True)
    d, total, queries, norm = V.shape(rows)
    if not queries:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    whole = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))))
    rows = stored(rows.filter(F.size("v") == d).select("vec_id", "is_query", whole.alias("v")), "weights")
    sample_ids, sample = V.sample(rows, d, SAMPLE)
    exact = (scale * norm + d) ** 2 < _EXACT
    there, asked = V.meetings(rows, total, queries)
    found = there.groupBy("block", "batch").cogroup(asked.groupBy("block", "batch"))
    return V.nearest(found.applyInPandas(_searcher(sample_ids, sample.astype(np.int64), k, exact), V.RESULT + "long"), k)
