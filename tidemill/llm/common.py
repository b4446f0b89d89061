"""Helpers that several operators share: task-wise Arrow maps, worker stores, connected components."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import stored


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch] | None],
                schema: str | T.StructType, start: Callable[[], object] | None = None) -> DataFrame:
    """Run ``fn`` on each Arrow batch of ``df``; ``start`` builds what the batches of a task share.

    ``fn`` gets (batch) or (batch, shared) and returns a batch, an iterable of
    batches, or None for no rows.  A task holds one batch at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = start() if start else None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out = fn(batch, shared) if start else fn(batch)
            if out is None:
                continue
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return df.mapInArrow(run, schema)


def with_id(named: DataFrame, more: str) -> T.StructType:
    """Schema of the column ``id`` of ``named``, whatever its type, and further columns given as text."""
    return T.StructType([named.schema["id"], *T.StructType.fromDDL(more).fields])


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, shared by its tasks.

    Functions travel to the workers by value, so their own globals start afresh
    in each task; a cache that pays off over many tasks is kept here.  Whoever
    fills it bounds its size.
    """
    key = "tidemill_worker_store"
    holder = sys.modules.setdefault(key, types.ModuleType(key))
    return holder.__dict__.setdefault(name, {})


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: (node, component), component = its smallest node.

    Alternates large-star and small-star steps until the edge set stands still;
    each step is two groupings that reduce before the shuffle and a join whose
    hot keys Spark can split.  Every round is written to the shared folder, so
    lineage stays short and a lost executor costs one round.  Nodes without
    edges are not in the result.  Empty edges give an empty result; self loops
    and repeated edges do no harm; edges with a null end are ignored.
    """
    e = (edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
         .where(F.col("u").isNotNull() & F.col("v").isNotNull()))
    loops = e.where("u = v").select("u").distinct()
    e = stored(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.withColumnRenamed("m", "v")).distinct())
        e = stored(small.select("u", "v"))
        now = _mark(e)
        if now == mark:
            break
        mark = now
    found = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    alone = loops.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return found.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
