"""Exact top-k search by MaxScore over impact-ordered postings.

Each component of a vector is a term and each shard of the rows an index: for each term it has the
least and greatest value, which bound what the term can add to any score, and the rows in order of
the value. A query's terms split into essential and non-essential ones: the latter's bounds together
cannot lift a row to the threshold, which is the k-th best score so far. The essential postings are
added up for all rows, the other terms probed only for rows that can still reach the threshold.
Shards' lists are merged by a window over (score, id).

Vectors that are null or have null or non-finite components take no part; shorter ones count as
padded with zeros, empty ones too. Repeated ids are rows of their own except that a row
never meets its own id; a query id with several vectors gets a list for each.
Ties go to the smaller id. Extra columns are ignored; without queries or rows the result is empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARD_ROWS = 16_384
QUERY_ROWS = 4_096
LEAST_SHARDS = 16
PROBE = 8
EXACT = 2.0**53


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))


def scaled(vector: Column, factor: int = 64) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


class Shard:
    """Impact-ordered index of the vectors of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], np.ascontiguousarray(vectors[order].T)
        self.low, self.high = self.rows.min(axis=1), self.rows.max(axis=1)
        self.postings = np.argsort(self.rows, axis=1, kind="stable").astype(np.int32)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best rows other than those of the id `own`."""
        n, terms = len(self.ids), len(query)
        bounds = np.stack([query * self.low, query * self.high])
        least, most = bounds.min(axis=0), bounds.max(axis=0)
        order = np.argsort(least - most, kind="stable")
        gain = (most - least)[order]
        a, b = np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, "right")
        threshold = -np.inf
        if n > 4 * k:
            heads = [self.postings[d, -2 * k :] if query[d] > 0 else self.postings[d, : 2 * k] for d in order[:PROBE]]
            some = np.unique(np.concatenate(heads))
            some = some[(some < a) | (some >= b)]
            if len(some) >= k:
                threshold = np.partition(query @ self.rows[:, some], -k)[-k]
        rest = np.concatenate((np.cumsum(gain[::-1])[::-1], [0]))
        cut = int(np.searchsorted(-(least.sum() + rest), -threshold, "right")) if np.isfinite(threshold) else terms
        # Terms from `cut` on are non-essential: with all their bounds a row stays below the threshold.
        rest_most = np.concatenate((most[order][::-1].cumsum()[::-1], [0]))
        cut = max(min(cut, terms), min(terms, PROBE))
        partial = query[order[:cut]] @ self.rows[order[:cut]]
        alive = None
        at = cut
        while True:
            fit = partial + rest_most[at] >= threshold
            if not fit.all():
                alive = np.flatnonzero(fit) if alive is None else alive[fit]
                partial = partial[fit]
            if at >= terms:
                break
            dims = order[at : at + PROBE]
            partial = partial + query[dims] @ (self.rows[dims] if alive is None else self.rows[np.ix_(dims, alive)])
            at += len(dims)
        places = np.arange(n) if alive is None else alive
        other = (places < a) | (places >= b)
        places, partial = places[other], partial[other]
        if len(places) > k:
            kth = np.partition(partial, -k)[-k]
            fit = partial >= kth
            places, partial = places[fit], partial[fit]
        best = np.lexsort((self.ids[places], -partial))[:k]
        return places[best], partial[best]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "vector") -> DataFrame:
    """The k rows of `vectors` of highest inner product for each of `queries` (integer components)."""
    rows = vectors.count()
    asked = queries.count()
    shards = max(LEAST_SHARDS, -(-rows // SHARD_ROWS))
    blocks = max(1, -(-asked // QUERY_ROWS))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.select(F.col(key).alias("query_id"), F.col(vector).alias("vector"), dealt(blocks).alias("block")).dropDuplicates().withColumn("asked", F.xxhash64("vector")).withColumn("shard", everywhere(shards))
    right = vectors.select(F.col(key).alias("vec_id"), F.col(vector).alias("vector"), dealt(shards).alias("shard")).withColumn("block", everywhere(blocks))

    def searched(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            width = max(asked["vector"].map(len).max(), held["vector"].map(len).max())
            q, h = _matrix(asked["vector"], width), _matrix(held["vector"], width)
            if width and np.abs(q).max() * np.abs(h).max() * width >= EXACT:
                q, h = q.astype(np.int64), h.astype(np.int64)
            if not width:  # empty vectors have the product 0
                q, h = np.zeros((len(q), 1)), np.zeros((len(h), 1))
            if len(h):
                index = Shard(held["vec_id"].to_numpy(), h)
                for own, nth, query in zip(asked["query_id"].to_numpy(), asked["asked"].to_numpy(), q, strict=True):
                    at, scores = index.search(own, query, k)
                    out.append(pd.DataFrame({"query_id": own, "asked": nth, "vec_id": index.ids[at], "score": scores.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "asked": [], "vec_id": [], "score": []}, dtype="int64")

    cells = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard"))
    found = cells.applyInPandas(searched, "query_id long, asked long, vec_id long, score long")
    best = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
