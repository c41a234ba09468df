"""Centroid clustering by dimension-sharded Lloyd rounds.

Vectors are cut twice: into chunks of rows, and each chunk into blocks of columns. A round broadcasts the centroids as
column slices. The task of a block computes the exact part of the squared distances that its columns give;
`reduceByKey` adds the blocks of a chunk and the smallest sum decides. The numbers of the clusters, a byte or
two for each vector, then meet the blocks again, and each shard of columns adds up and divides its own slice of the
centroids. Only slices come to the driver: as many numbers as the centroids have, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import bounded_batches, col, shuffle_partitions, small_frame, stored
from cityflow.llm.vectors import integers, matrix, whole

#: Vectors of a chunk.
CHUNK = 2048


def _cut(dims: int, width: int):
    """Column blocks of the vectors of a partition; the first of a chunk carries the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                cells = matrix(part.column(1), dims).astype(np.int32)
                shards = range(0, dims, width)
                ids = [part.column(0).to_pylist(), *[None] * (len(shards) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * len(shards), pa.int64()),
                        pa.array(range(len(shards)), pa.int32()),
                        pa.array([np.ascontiguousarray(cells[:, s : s + width]).tobytes() for s in shards], pa.binary()),
                        pa.array(ids, pa.list_(pa.int64())),
                    ],
                    ["chunk", "shard", "cells", "ids"],
                )
                chunk += 1

    return run


def _block(cells: bytes, width: int) -> np.ndarray:
    return np.frombuffer(cells, np.int32).reshape(-1, width).astype(np.int64)


def partial_distances(block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids as far as these columns go, as whole numbers."""
    return (block * block).sum(1)[:, None] - 2 * (block @ centroids.T) + (centroids * centroids).sum(1)[None, :]


def _assigned(blocks: DataFrame, slices: list[np.ndarray], partitions: int) -> RDD:
    """(chunk, (cluster, distance)) of all vectors; of equally near centroids the first."""
    given = blocks.sparkSession.sparkContext.broadcast(slices)

    def partial(row):
        own = given.value[row.shard]
        return row.chunk, partial_distances(_block(row.cells, own.shape[1]), own)

    def nearest(distances: np.ndarray):
        found = distances.argmin(1)
        return found.astype(np.int32), distances[np.arange(len(found)), found]

    return blocks.select("chunk", "shard", "cells").rdd.map(partial).reduceByKey(np.add, partitions).mapValues(nearest)


def _updated(blocks: DataFrame, slices: list[np.ndarray], partitions: int) -> list[np.ndarray]:
    """Slices after one round, each made by the tasks of its own columns."""
    spark = blocks.sparkSession
    numbers = _assigned(blocks, slices, partitions).map(lambda kv: (kv[0], kv[1][0].tobytes()))
    placed = blocks.select("chunk", "shard", "cells").join(spark.createDataFrame(numbers, "chunk long, numbers binary"), "chunk")
    given = spark.sparkContext.broadcast(slices)

    def sums(row):
        own = given.value[row.shard]
        cluster = np.frombuffer(row.numbers, np.int32)
        total = np.zeros((len(own), own.shape[1] + 1), np.int64)
        np.add.at(total, cluster, np.hstack([_block(row.cells, own.shape[1]), np.ones((len(cluster), 1), np.int64)]))
        return row.shard, total

    def moved(kv):
        shard, total = kv
        own, count = given.value[shard], total[:, -1:]
        return shard, np.where(count > 0, total[:, :-1] // np.maximum(count, 1), own)

    # As many rows as there are shards of columns, each a slice of the centroids.
    found = dict(placed.rdd.map(sums).reduceByKey(np.add, len(slices)).map(moved).collect())
    return [found.get(i, own) for i, own in enumerate(slices)]


def centroid_clusters(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    scale: int = 64,
    clusters: int = 16,
    rounds: int = 3,
    seed: int = 1,
    shards: int = 4,
) -> DataFrame:
    """The cluster of every vector with exactly `dims` components, none null or not finite; other rows give none.

    Components become floor(scale * x), within 2^25 either way. The first centroids are the vectors whose SHA-256 of
    `seed:id` is smallest (of rows that repeat an id the smaller vector goes first; rows without an id are never
    chosen before others); fewer vectors than `clusters` give fewer centroids. Empty clusters keep their centroid.
    Returns vec_id, cluster, distance (squared), cluster_inertia and inertia (null beyond a long) and centroid_sha256.
    Repeated rows are vectors of their own, a null id stays null, other columns are not read, and an empty table gives no rows.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    partitions = shuffle_partitions(spark)
    kept = vectors.where(whole(vector_col) & (F.size(col(vector_col)) == dims)).select(
        col(id_col).cast("long").alias("vec_id"), integers(vector_col, scale).alias("v")
    )
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    # As many rows as there are clusters.
    first = kept.withColumn("digest", digest).orderBy(F.col("digest").asc_nulls_last(), "v").limit(clusters).collect()
    centroids = np.array([r.v for r in first], np.int64).reshape(len(first), dims)
    width = -(-dims // shards)
    out = "vec_id long, cluster int, distance long"
    if not first:
        empty = spark.createDataFrame([], out + ", cluster_inertia long, inertia long, centroid_sha256 string")
        return empty
    blocks = stored(kept.mapInArrow(_cut(dims, width), "chunk long, shard int, cells binary, ids array<long>"))
    slices = [centroids[:, s : s + width] for s in range(0, dims, width)]
    for _ in range(rounds):
        slices = _updated(blocks, slices, partitions)
    last = _assigned(blocks, slices, partitions).map(lambda kv: (kv[0], kv[1][0].tolist(), kv[1][1].tolist()))
    found = spark.createDataFrame(last, "chunk long, cluster array<int>, distance array<long>")
    named = blocks.where("shard = 0").select("chunk", "ids").join(found, "chunk")
    rows = stored(named.select(F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), "cluster", "distance"))).select("vec_id", "cluster", "distance"))
    by_cluster = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    totals = {r.cluster: int(r.d) for r in by_cluster.collect()}  # one row per cluster
    fits = lambda n: n if n < 1 << 63 else None
    final = np.hstack(slices)
    told = {c: hashlib.sha256(",".join(map(str, final[c].tolist())).encode()).hexdigest() for c in totals}
    numbers = sorted(totals)
    columns = {
        "cluster": numbers,
        "cluster_inertia": [fits(totals[c]) for c in numbers],
        "inertia": [fits(sum(totals.values()))] * len(numbers),
        "centroid_sha256": [told[c] for c in numbers],
    }
    sums = small_frame(spark, columns, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(sums, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
