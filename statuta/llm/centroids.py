"""Centroid clustering (Lloyd's rounds) over weighted distinct vectors, in exact integers.

Vectors are quantised; equal ones become one row with their number (the grouping combines before
the shuffle, so a vector that a third of the rows share is one row a task). Each round broadcasts
the centroids (k rows), assigns the distinct vectors batch by batch, adds up weighted integer sums
for each cluster in the task and sums these few rows over all tasks. The last assignment is joined
back to the rows by a 128-bit key of the vector; where two different vectors should share a key,
which the distinct rows tell, the join goes by the whole vector.

Rows whose vector is null, of another length, or has null or non-finite components take no part.
Quantised components are held within +-2**27, so that distances fit 64 bits. Repeated ids are rows
of their own; a null id never starts a centroid. Fewer rows than k give as many centroids, and an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import checkpointed

LIMIT = 1 << 27
#: Products of components below this add up exactly in doubles.
SMALL = 1 << 22
ROWS = 8_192


def usable(vector: Column, width: int) -> Column:
    return vector.isNotNull() & (F.size(vector) == width) & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))


def quantised(vector: Column, factor: int) -> Column:
    return F.transform(vector, lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x.cast("double") * factor))).cast("int"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid, the first of equally near ones."""
    exact = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) >= SMALL
    v, c = (vectors, centroids) if exact else (vectors.astype(np.float64), centroids.astype(np.float64))
    distances = (c * c).sum(axis=1) - 2 * (v @ c.T)
    found = distances.argmin(axis=1)
    return found, (distances[np.arange(len(v)), found] + (v * v).sum(axis=1)).astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    k, width = centroids.shape
    totals, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            vectors, weights = _matrix(part.column(0), width), part.column(1).to_numpy()
            found, _ = nearest(vectors, centroids)
            order = np.argsort(found, kind="stable")
            own, starts = np.unique(found[order], return_index=True)
            totals[own] += np.add.reduceat((vectors * weights[:, None])[order], starts)
            counts += np.bincount(found, weights, k).astype(np.int64) if weights.max() < SMALL else np.array([weights[found == i].sum() for i in range(k)])
    kept = np.flatnonzero(counts)
    clusters = np.repeat(kept, width)
    yield pa.record_batch([pa.array(clusters, pa.int32()), pa.array(np.tile(np.arange(width), len(kept)), pa.int32()), pa.array(totals[kept].ravel()), pa.array(np.repeat(counts[kept], width))], names=["cluster", "part", "total", "n"])


def _moved(distinct: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the means of the clusters; empty clusters stay."""
    added = distinct.select("vector", "weight").mapInArrow(lambda batches: _sums(batches, centroids), "cluster int, part int, total long, n long")
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    out = centroids.copy()
    for row in added.groupBy("cluster", "part").agg(wide("total"), wide("n")).collect():  # k * width rows at most
        out[row["cluster"], row["part"]] = int(row["total"]) // int(row["n"])
    return out


def _assigned(distinct: DataFrame, centroids: np.ndarray, keys: list[str]) -> DataFrame:
    """`keys` and weight of the distinct vectors with cluster and distance."""
    width = centroids.shape[1]
    names = [*keys, "weight", "cluster", "distance"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found, distances = nearest(_matrix(part.column(0), width), centroids)
                yield pa.record_batch([*part.columns[1:], pa.array(found, pa.int32()), pa.array(distances)], names=names)

    kinds = ", ".join(f"{k} {'array<int>' if k == 'vector' else 'long'}" for k in keys)
    return distinct.select("vector", *(F.col(k).alias(f"own_{k}") for k in keys), "weight").mapInArrow(assign, f"{kinds}, weight long, cluster int, distance long")


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, width: int = 64, factor: int = 256, seed: int = 2, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each row that takes part."""
    spark = rows.sparkSession
    kept = rows.where(usable(F.col(vector), width)).select(F.col(key).alias("vec_id"), quantised(F.col(vector), factor).alias("vector"))
    keyed = lambda df: df.withColumn("key1", F.xxhash64("vector")).withColumn("key2", F.xxhash64(F.lit("second"), F.reverse("vector")))
    start = kept.where("vec_id is not null").orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256), "vec_id", "vector").limit(k).select("vector")
    centroids = np.array([r["vector"] for r in start.collect()], dtype=np.int64).reshape(-1, width)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    distinct = checkpointed(keyed(kept.groupBy("vector").agg(F.count("*").alias("weight"))))
    for _ in range(rounds):
        centroids = _moved(distinct, centroids)

    placed = _assigned(distinct, centroids, ["key1", "key2"])
    inertia = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)") * F.col("weight")).alias("s")).collect()  # k rows at most
    own = {r["cluster"]: int(r["s"]) for r in inertia}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    by_cluster = [(i, own.get(i, 0), sum(own.values()), digest) for i, digest in enumerate(digests)]
    about = spark.createDataFrame(by_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    keys = ["key1", "key2"]
    if distinct.groupBy(*keys).count().where("count > 1").limit(1).count():
        keys = ["vector"]
        placed = _assigned(distinct, centroids, keys)
    found = keyed(kept).select("vec_id", *keys).join(placed.select(*keys, "cluster", "distance"), keys)
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
