"""Centroid clustering over integer vectors: a tournament of bisectors finds the nearest centroid.

For two centroids c and d the sign of 2 (d - c) v - (|d|^2 - |c|^2) says which one v is nearer to. These normals and
thresholds are made once a round for all pairs; each vector then takes k - 1 sign tests, where a zero leaves the
smaller number in, and one distance, that to the winner. All arithmetic is on 64-bit integers, so it is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import kept

# Components stay below this, so that no test, distance or sum of 2 ** 36 vectors leaves 64 bits.
LARGEST = 1 << 24
# Bytes the normals of all pairs may take in each worker: k * k * size * 8.
NORMAL_BYTES = 64 << 20
# Vectors one numpy step works on.
STEP = 4096


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str, size: int, scale: int) -> DataFrame:
    """vec_id and v, the components as floor(scale * x), of vectors of `size` components, none null or not finite."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    own = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("embedding"))
    whole = F.transform(x, lambda c: F.when(F.abs(c * scale) >= LARGEST, F.raise_error(F.lit("a component is too large to cluster"))).otherwise(F.floor(c * scale)).cast("bigint"))
    return own.where((F.size("embedding") == size) & finite).select("vec_id", whole.alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of seed and identifier; k rows at most reach the driver."""
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id is not null").orderBy(order, "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in first], np.int64)


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals and thresholds of all pairs (c, d): d is nearer to v where normal . v > threshold."""
    squares = (centroids * centroids).sum(1)
    return 2 * (centroids[None, :, :] - centroids[:, None, :]), squares[None, :] - squares[:, None]


def nearest(v: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The winner of each row's tournament. The holder always has the smaller number, so it keeps its place at zero."""
    holder = np.zeros(len(v), np.int64)
    for rival in range(1, len(normals)):
        lost = np.einsum("ij,ij->i", normals[holder, rival], v) > thresholds[holder, rival]
        holder[lost] = rival
    return holder


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _summed(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each cluster of a task: number of vectors and the sum of each component."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals, thresholds = bisectors(centroids)
        k, size = centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            v = _matrix(batch.column(1), size)
            for at in range(0, len(v), STEP):
                part = v[at : at + STEP]
                winner = nearest(part, normals, thresholds)
                count += np.bincount(winner, minlength=k)
                np.add.at(total, winner, part)
        used = np.flatnonzero(count)
        parts = [pa.array(used, pa.int64()), pa.array(count[used]), *[pa.array(total[used, j]) for j in range(size)]]
        yield pa.RecordBatch.from_arrays(parts, ["cluster", "n", *[f"s{j}" for j in range(size)]])

    return sums


def _assigned(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """vec_id, cluster and the exact squared distance to the winner."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals, thresholds = bisectors(centroids)
        for batch in batches:
            v = _matrix(batch.column(1), centroids.shape[1])
            winner = np.concatenate([nearest(v[at : at + STEP], normals, thresholds) for at in range(0, len(v), STEP)] or [np.empty(0, np.int64)])
            apart = v - centroids[winner]
            parts = [batch.column(0), pa.array(winner, pa.int32()), pa.array((apart * apart).sum(1), pa.int64())]
            yield pa.RecordBatch.from_arrays(parts, ["vec_id", "cluster", "distance"])

    return assign


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid that has vectors at the floor of their mean; the others where they were."""
    size = centroids.shape[1]
    columns = [f"s{j}" for j in range(size)]
    parts = rows.mapInArrow(_summed(centroids), f"cluster bigint, n bigint, {', '.join(f'{c} bigint' for c in columns)}")
    out = centroids.copy()
    # one row for each cluster
    for row in parts.groupBy("cluster").agg(F.sum("n"), *[F.sum(c) for c in columns]).collect():
        out[row[0]] = [x // row[1] for x in row[2:]]
    return out


def clustered(
    vectors: DataFrame, k: int = 40, rounds: int = 5, seed: str = "2:", size: int = 64, scale: int = 256,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """One row for each kept row: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of `size` components, none of them null, NaN or infinite; a null vector, or one of another size,
    gives no row. Each round assigns all vectors and moves every centroid that has some to the floor of their mean;
    then all are assigned once more. At equal distance the smaller number wins. The first centroids are the k vectors
    with the smallest digest of `seed` and identifier, fewer where there are fewer vectors; rows that share an
    identifier follow each other by their components and may all be centroids. A null identifier is clustered but
    never a first centroid; if there is no other, all are in cluster 0, around the smallest vector. Repeated
    rows count each. Components of 2 ** 24 or more after scaling stop the run, as sums might leave 64 bits.
    Other columns are not read. The driver holds k vectors; each task returns one row for each cluster.
    """
    if k * k * size * 8 > NORMAL_BYTES:
        raise ValueError(f"{k} centroids of {size} components need more than {NORMAL_BYTES} bytes for their bisectors")
    rows = kept(integer_vectors(vectors, id_column, vector_column, size, scale), "vectors")
    schema = "vec_id bigint, cluster int, distance bigint"
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        least = rows.agg(F.min("v")).first()[0]
        centroids = np.array([least if least is not None else [0] * size], np.int64)
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    out = kept(rows.mapInArrow(_assigned(centroids), schema), "assigned")
    inertia = out.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = inertia.agg(F.sum("cluster_inertia")).first()[0]
    named = rows.sparkSession.createDataFrame([(i, [int(x) for x in c]) for i, c in enumerate(centroids)], "cluster int, centroid array<bigint>")
    named = named.join(inertia, "cluster").select("cluster", "cluster_inertia", _digest(F.col("centroid")).alias("centroid_sha256"))
    whole = F.lit(total).cast("bigint").alias("inertia")
    # one row for each of k clusters
    return out.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", whole, "centroid_sha256")


def _digest(components: Column) -> Column:
    return F.sha2(F.array_join(components, ","), 256)
