"""Centroid clustering by dimension shards: exact Lloyd rounds on integer vectors.

A vector is cut into column blocks.  The task of a block computes the exact part
of the squared distances to every centroid that falls on its columns, from its
slice of the centroids alone; summing the parts by vector and taking the least
gives the assignment.  Then each shard sums its own columns by cluster and
updates its own slice of the centroids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import map_batches
from tidemill.session import scratch_dir, stored

#: Components beyond this have no exact 64-bit squared distance and are held at it.
LIMIT = 1 << 27
#: Slices of the centroids by shard: k rows of the shard's columns.
Slices = list[np.ndarray]


def quantised(vectors: DataFrame, dims: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64) -> DataFrame:
    """(id, x) of the vectors with exactly ``dims`` components, all finite: x = floor(scale * component)."""
    x = F.col("x")
    finite = F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < F.lit(float("inf"))))
    grid = F.transform(x, lambda a: F.floor(F.least(F.greatest(a * F.lit(float(scale)), F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    return (vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
            .where((F.size(x) == dims) & finite).select("id", grid.alias("x")))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy().reshape(len(x), -1).astype(np.int64)


def _by_shard(batch: pa.RecordBatch) -> list[tuple[int, np.ndarray]]:
    """Shards of a batch and the places of their rows; a file holds one shard, a batch may span two files."""
    shard = batch.column("shard").to_numpy()
    return [(int(s), np.flatnonzero(shard == s)) for s in np.unique(shard)]


def _assigned(slices: DataFrame, centroids: Slices) -> DataFrame:
    """(row, cluster, distance): the nearest centroid of each vector, ties to the smaller number."""
    k = len(centroids[0])
    parts = [f"d{c}" for c in range(k)]

    def partial(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, out = _matrix(batch), np.empty((batch.num_rows, k), dtype=np.int64)
        for shard, here in _by_shard(batch):
            for c, centre in enumerate(centroids[shard]):
                far = x[here] - centre
                out[here, c] = (far * far).sum(axis=1)
        return pa.RecordBatch.from_arrays([batch.column("row"), *[pa.array(out[:, c]) for c in range(k)]], ["row", *parts])

    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("row", *parts)])
    whole = map_batches(slices, partial, schema).groupBy("row").agg(*[F.sum(p).alias(p) for p in parts])
    nearest = F.array_min(F.array(*[F.struct(F.col(p).alias("distance"), F.lit(c).alias("cluster")) for c, p in enumerate(parts)]))
    return stored(whole.select("row", nearest.alias("near")).select("row", "near.cluster", "near.distance"))


def _updated(slices: DataFrame, assigned: DataFrame, centroids: Slices) -> Slices:
    """Each shard's slice with the floor of the mean of its clusters; empty clusters stay where they are."""

    def sums(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        x, cluster, out = _matrix(batch), batch.column("cluster").to_numpy(), []
        for shard, here in _by_shard(batch):
            met, group = np.unique(cluster[here], return_inverse=True)
            total = np.zeros((len(met), x.shape[1]), dtype=np.int64)
            np.add.at(total, group, x[here])
            count = np.bincount(group)
            n, width = total.shape
            out.append(pa.RecordBatch.from_arrays(
                [pa.array(np.full(n * width, shard, dtype=np.int32)), pa.array(np.repeat(met, width).astype(np.int32)), pa.array(np.tile(np.arange(width, dtype=np.int32), n)),
                 pa.array(total.ravel()), pa.array(np.repeat(count, width).astype(np.int64))], ["shard", "cluster", "place", "total", "n"]))
        return out

    summed = map_batches(slices.join(assigned.select("row", "cluster"), "row"), sums, "shard int, cluster int, place int, total long, n long")
    new = [s.copy() for s in centroids]
    # At most one row per component of a centroid.
    for r in summed.groupBy("shard", "cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        new[r["shard"]][r["cluster"], r["place"]] = r["total"] // r["n"]
    return new


def cluster(vectors: DataFrame, k: int = 16, dims: int = 64, rounds: int = 3, shard_dims: int = 16, id_col: str = "vec_id",
            vector_col: str = "embedding", scale: float = 64, seed: str = "1") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256), a row per kept vector.

    Kept are vectors of ``dims`` components, none null or non-finite, on the grid
    floor(scale * component).  The first centroids are the ``k`` vectors of
    smallest SHA-256 of ``seed:id``, ties by vector, null ids last; fewer
    vectors give fewer centroids.  After ``rounds`` rounds vectors are assigned
    once more.  Repeated ids and vectors are rows of their own, an empty table
    gives no rows.  Components whose scaled size is over 2^27 are held there,
    and an inertia that no long can hold is null.
    """
    if dims % shard_dims:
        raise ValueError("dims is a multiple of shard_dims")
    spark = vectors.sparkSession
    kept = stored(quantised(vectors, dims, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id()))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = np.array([r["x"] for r in kept.orderBy(drawn.asc_nulls_last(), "x").limit(k).select("x").collect()], dtype=np.int64).reshape(-1, dims)
    cuts = list(range(0, dims, shard_dims))
    centroids = [first[:, c:c + shard_dims] for c in cuts]
    slices = _sliced(kept, shard_dims, len(cuts))
    facts = spark.createDataFrame([], "cluster int, cluster_inertia long, centroid_sha256 string")
    if not len(first):
        return kept.join(facts, F.lit(False), "inner").select(
            "id", "cluster", F.lit(0).cast("long").alias("distance"), "cluster_inertia", F.lit(0).cast("long").alias("inertia"), "centroid_sha256")
    for _ in range(rounds):
        centroids = _updated(slices, _assigned(slices, centroids), centroids)
    last = _assigned(slices, centroids)
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    by_cluster = {r["cluster"]: int(r["n"]) for r in last.groupBy("cluster").agg(exact.alias("n")).collect()}  # at most k rows

    def as_long(n: int) -> int | None:
        return n if n < 1 << 63 else None

    names = [",".join(map(str, row)) for row in np.concatenate(centroids, axis=1).tolist()]
    facts = spark.createDataFrame([(c, as_long(n), hashlib.sha256(names[c].encode()).hexdigest()) for c, n in by_cluster.items()], facts.schema)
    inertia = F.lit(as_long(sum(by_cluster.values()))).cast("long")
    return (kept.select("id", "row").join(last, "row").join(facts, "cluster")
            .select("id", "cluster", "distance", "cluster_inertia", inertia.alias("inertia"), "centroid_sha256"))


def _sliced(kept: DataFrame, width: int, shards: int) -> DataFrame:
    """(row, x, shard) by column block, in files that hold one block each."""
    path = scratch_dir(kept.sparkSession, "slices")
    cut = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.slice("x", s * width + 1, width))
    kept.select("row", F.posexplode(cut).alias("shard", "x")).write.partitionBy("shard").parquet(path)
    return kept.sparkSession.read.schema("row long, x array<int>, shard int").parquet(path)
