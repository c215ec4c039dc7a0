"""Exact top-k search by inner product with the threshold algorithm.

The candidates are dealt into shards. Each shard keeps one list of its rows per
dimension, sorted by that component. A query reads the lists from the end that
adds most to its score, all to the same depth, and scores every row that it
meets; the best score that a row not yet met can have is the score of the values
at this depth. When that bound is below the k-th score so far, the shard is
done; it is also done once most rows have been met and the rest are scored, as
happens where many dimensions matter alike. The best rows of all shards give the
result.

Queries and shards meet in cells of bounded size; no cell holds all queries or
all candidates.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.sources.storage import settled

SHARD_ROWS = 8192
QUERY_ROWS = 2048
STEP = 64
# Below this, products of components and their sums are exact as doubles.
EXACT = 2.0**53


class SortedLists:
    """The rows of a shard and, per dimension, their order by that component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")  # column d: rows by component d, ascending
        self.ranked = np.take_along_axis(vectors, self.order, axis=0)

    def search(self, query: np.ndarray, query_id, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows of the k best scores (ties to the smaller id), their scores, and the depth that was read."""
        n, dims = self.vectors.shape
        used = np.flatnonzero(query)
        up = query[used] < 0  # lists that are read from their smallest value
        met = np.zeros(n, dtype=bool)
        rows, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=query.dtype)
        depth, step = 0, STEP
        if len(used) == 0:  # every score is 0
            rows = np.flatnonzero(self.ids != query_id)
            return self._best(rows, np.zeros(len(rows), dtype=query.dtype), k) + (n,)
        while depth < n:
            end = min(n, depth + step)
            listed = np.zeros(n, dtype=bool)
            listed[self.order[n - end : n - depth, used[~up]]] = True
            listed[self.order[depth:end, used[up]]] = True
            if 2 * np.count_nonzero(met | listed) > n:
                # Scoring the few rows not yet met is cheaper than reading on in all lists.
                listed[:] = True
                end = n
            new = np.flatnonzero(listed & ~met)
            met[new] = True
            new = new[self.ids[new] != query_id]
            gained = self.vectors[new] @ query
            if len(rows) == k:
                better = gained >= scores[-1]
                new, gained = new[better], gained[better]
            rows, scores = self._best(np.concatenate([rows, new]), np.concatenate([scores, gained]), k)
            depth, step = end, step * 2
            # The largest score of a row that none of the lists has reached.
            edge = np.where(up, self.ranked[depth - 1, used], self.ranked[n - depth, used])
            if len(rows) == k and scores[-1] > edge @ query[used]:
                break
        return rows, scores, depth

    def _best(self, rows, scores, k):
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[best], scores[best]


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows; a shorter vector ends with zeros."""
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def _cell(k: int):
    def search(frame: pd.DataFrame) -> pd.DataFrame:
        width = int(frame["vector"].map(len).max())
        vectors = _matrix(frame["vector"], width)
        wanted = frame["is_query"].to_numpy()
        largest = np.abs(vectors).max(initial=0.0)
        if largest * largest * width >= EXACT:
            vectors = np.array([[int(x) for x in v] for v in vectors], dtype=object)
        ids = frame["vec_id"].to_numpy()
        lists = SortedLists(ids[~wanted], vectors[~wanted])
        found = []
        if len(lists.ids):
            for query_id, query in zip(ids[wanted], vectors[wanted], strict=True):
                rows, scores, _ = lists.search(query, query_id, k)
                found += [(query_id, lists.ids[r], min(max(int(s), -(2**63)), 2**63 - 1)) for r, s in zip(rows, scores)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return search


def whole_components(vectors: DataFrame, column: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(vec_id, vector) with components floor(scale * x), of vectors whose components are all finite numbers."""
    whole = F.transform(column, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col(column).isNotNull() & finite
    return vectors.filter(usable).select(F.col("vec_id").alias("vec_id"), whole.alias("vector"))


def top_k(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = 5,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The ``k`` candidates of highest inner product for every query.

    Both take (vec_id, vector of whole doubles); a query's own id is no candidate
    for it. Returns query_id, rank (from 1), vec_id, score; ties go to the
    smaller vec_id, and fewer candidates give fewer rows. Shorter vectors count
    as if they ended with zeros; an empty vector scores 0. Rows that repeat an
    id are candidates of their own, and queries that repeat an id are one query.
    Scores beyond the range of a long become its limits. An empty table gives no
    rows.
    """
    candidates = settled(candidates.select("vec_id", "vector"), "candidates")
    queries = settled(queries.select("vec_id", "vector").dropDuplicates(["vec_id"]), "queries")
    shards = max(1, -(-candidates.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))

    def dealt(part: DataFrame, column: str, parts: int, against: str, times: int, is_query: bool) -> DataFrame:
        return part.select(
            F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(column),
            F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias(against),
            F.lit(is_query).alias("is_query"),
            "vec_id",
            "vector",
        )

    cells = dealt(candidates, "shard", shards, "block", blocks, False).unionByName(
        dealt(queries, "block", blocks, "shard", shards, True)
    )
    found = cells.groupBy("shard", "block").applyInPandas(_cell(k), "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
