"""Centroid clustering of whole-number vectors by scalar lookup tables.

Rounds assign every vector to its nearest centroid and move each centroid to the
rounded-down mean of its vectors.  A task does not compute distances per vector:
for each dimension it tabulates the squared difference between every value that
occurs there and every centroid, gathers each vector's rows of that table and
adds them up over the dimensions.

Centroids, a fixed number of rows, are all that the driver keeps and sends.  Tasks
hold a few thousand vectors at once and give one row of sums for each centroid,
which further tasks add up in two steps, so no task takes more than a few hundred
such rows from each other one however many vectors a cluster has.

All numbers are exact: 64-bit where they are sure to fit, Python's integers else.

Defined cases: vectors that are NULL, have another number of components, or a
component that is NULL or not finite (also after scaling) are left out; NULL ids are
ids like others, hashed as the empty string; repeated rows are vectors of their own;
equal hashes are ordered by components; with fewer vectors than clusters each is a
centroid; equal distances go to the smaller number; an empty cluster's centroid stays;
an empty table gives an empty table; a distance or sum beyond 64 bits is NULL; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Vectors that a task looks at together.
ROWS = 4096
#: Values below this leave room for 64 squared differences, and for sums of a batch, in 64 bits.
SAFE = 1 << 26
FAN_IN = 256
LARGEST = (1 << 63) - 1


def as_whole(scaled: np.ndarray) -> np.ndarray:
    """Whole-number doubles as integers, 64-bit ones if all are small."""
    if not scaled.size or np.abs(scaled).max() < SAFE:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], dtype=object).reshape(scaled.shape)


def components(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of ``width`` numbers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def distances(block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of a block's vectors to all centroids, from one table per dimension."""
    if block.dtype != centroids.dtype:
        block, centroids = block.astype(object), centroids.astype(object)
    total = np.zeros((len(block), len(centroids)), dtype=block.dtype)
    for dimension in range(block.shape[1]):
        values, at = np.unique(block[:, dimension], return_inverse=True)
        table = (values[:, None] - centroids[None, :, dimension]) ** 2
        total += table[at]
    return total


def nearest(block: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the first of equals, and the distance to it."""
    found = distances(block, centroids)
    cluster = np.argmin(found, axis=1)
    return cluster, found[np.arange(len(block)), cluster]


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, width: int, scale: float) -> DataFrame:
    """``id, vector`` with ``floor(scale * x)`` as doubles, of the vectors that are kept."""
    given = F.col(f"`{vector_column}`").cast("array<double>")
    scaled = F.transform(given, lambda x: x * F.lit(float(scale)))
    finite = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), scaled.alias("vector")).where(
        given.isNotNull() & (F.size(given) == width) & finite)

    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.floor(components(batch.column(1), width)).ravel() + 0.0
            lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * width, flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "vector"])

    return rows.mapInArrow(rounded, rows.schema)


def first_centroids(kept: DataFrame, clusters: int, seed: int, width: int) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.select("vector", order.alias("order")).orderBy("order", "vector").limit(clusters).collect()
    return as_whole(np.array([row.vector for row in rows], dtype=np.float64).reshape(len(rows), width))


def added(sums: pd.DataFrame) -> pd.DataFrame:
    """Rows of one cluster added up; numbers travel as text."""
    totals = [sum(map(int, column)) for column in zip(*sums["sums"])]
    return pd.DataFrame({"cluster": [sums["cluster"].iloc[0]], "deal": [0], "size": [int(sums["size"].sum())],
                         "sums": [[str(t) for t in totals]]})


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round."""
    width = centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, deal = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, dtype=object), 0
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                block = as_whole(components(batch.column(0).slice(begin, ROWS), width))
                cluster, _ = nearest(block, centroids)
                for c in np.unique(cluster):
                    chosen = block[cluster == c]
                    count[c] += len(chosen)
                    total[c] += chosen.sum(axis=0).astype(object)
            deal += batch.num_rows
        full = np.flatnonzero(count)
        salt = (deal + int(abs(total).sum() % FAN_IN)) % FAN_IN if len(full) else 0
        yield pa.RecordBatch.from_arrays([
            pa.array(full, pa.int32()), pa.array([salt] * len(full), pa.int32()), pa.array(count[full], pa.int64()),
            pa.array([[str(x) for x in total[c]] for c in full], pa.list_(pa.string()))],
            names=["cluster", "deal", "size", "sums"])

    schema = "cluster int, deal int, size long, sums array<string>"
    parts = kept.select("vector").mapInArrow(sums, schema)
    parts = parts.groupBy("cluster", "deal").applyInPandas(added, schema)
    rows = parts.groupBy("cluster").applyInPandas(added, schema).collect()
    values = [list(centroid) for centroid in centroids.astype(object)]
    for row in rows:
        values[row.cluster] = [int(s) // row.size for s in row.sums]
    fits = all(abs(int(v)) < SAFE for centroid in values for v in centroid)
    return np.array(values, dtype=np.int64 if fits else object).reshape(centroids.shape)


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance``, the distance as a decimal of 38 digits; NULL beyond."""
    width = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                piece = batch.slice(begin, ROWS)
                cluster, distance = nearest(as_whole(components(piece.column(1), width)), centroids)
                known = [str(d) if d < 10 ** 38 else None for d in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(cluster, pa.int32()), pa.array(known, pa.string())],
                    names=["id", "cluster", "distance"])

    kind = kept.schema["id"].dataType.simpleString()
    found = kept.mapInArrow(assign, f"id {kind}, cluster int, distance string")
    return found.withColumn("distance", F.col("distance").cast("decimal(38,0)"))


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def cluster(vectors: DataFrame, clusters: int, rounds: int, seed: int = 1, scale: float = 1.0, width: int = 64,
            id_column: str = "vec_id", vector_column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``<id>, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector kept, and the centroids."""
    kept = stored(whole_vectors(vectors, id_column, vector_column, width, scale), "whole-vectors")
    centroids = first_centroids(kept, clusters, seed, width)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(kept, centroids)
    found = stored(assigned(kept, centroids), "clustered")
    known = F.coalesce(F.count(F.when(F.col("distance").isNull(), 1)), F.lit(0)) == 0
    totals = found.groupBy("cluster").agg(F.when(known, F.sum("distance")).alias("sum")).collect()
    whole = None if any(row.sum is None for row in totals) else sum(int(row.sum) for row in totals)
    spark = vectors.sparkSession
    facts = spark.createDataFrame(
        [(row.cluster, _long(row.sum), _long(whole), digest(centroids[row.cluster])) for row in totals],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(id_column), "cluster",
        F.when(F.col("distance") <= LARGEST, F.col("distance")).cast("long").alias("distance"),
        "cluster_inertia", "inertia", "centroid_sha256")
    return joined, centroids


def _long(value) -> int | None:
    return None if value is None or value > LARGEST else int(value)
