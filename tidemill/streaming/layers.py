"""Maintained views on top of each other.

A layer hands its changes to the next as the rows of a keyed input, so each
layer can have the scope that bounds its own work: an order that depends on its
vehicle and on the cell the vehicle is in is placed by vehicle first and timed by
cell then, and a GPS fix reads the orders of one vehicle and of two cells.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemill.functions.scalar import event_micros, micros
from tidemill.operators.changes import diff_results
from tidemill.operators.keyed import key_filter
from tidemill.operators.latest import latest_by
from tidemill.sinks.keyed import KeyedTable, bucket_of
from tidemill.streaming.runners import start_together


class Layer(Protocol):
    def process(self, batches: Mapping[str, DataFrame], batch_id: int) -> DataFrame: ...

    def read(self, spark: SparkSession) -> DataFrame | None: ...


class Layers:
    """Layers by name, each with the names of the streams and earlier layers it reads; the last one is the result.

    ``first`` is called with the batches before any layer, for state that several
    layers share; it must stand being called again for the same batch.
    """

    def __init__(self, layers: Mapping[str, tuple[Layer, Sequence[str]]], hidden: Sequence[str] = (),
                 first: Callable[[Mapping[str, DataFrame], int], None] | None = None):
        self.layers, self.hidden, self.first = dict(layers), list(hidden), first

    def process(self, batches: Mapping[str, DataFrame], batch_id: int) -> DataFrame:
        """Bring every layer up to date; returns the changes of the last one.  Safe to repeat."""
        if self.first:
            self.first(batches, batch_id)
        known = dict(batches)
        for name, (layer, reads) in self.layers.items():
            changed = known[name] = layer.process({r: known[r] for r in reads}, batch_id)
        return changed.drop(*self.hidden)

    def start(self, streams: Mapping[str, DataFrame], checkpoint: str, every: str | None = None) -> StreamingQuery:
        return start_together(self.process, streams, checkpoint, every)

    def read(self, spark: SparkSession) -> DataFrame | None:
        layer, _ = list(self.layers.values())[-1]
        rows = layer.read(spark)
        return rows if rows is None else rows.drop(*self.hidden)


class LatestView:
    """The newest row per key, folded into the last result: a batch reads the buckets of its own keys and no history.

    ``derive`` shapes the rows first; ``order`` tells versions apart.
    """

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str], derive: Callable[[DataFrame], DataFrame] | None = None,
                 buckets: int = 256, compact_every: int = 0):
        self.keys, self.order, self.derive, self.buckets = list(keys), list(order), derive, buckets
        self.compact_every = compact_every
        self.table = KeyedTable(f"{path.rstrip('/')}/result", keys, keys, buckets)

    def process(self, batches: Mapping[str, DataFrame], batch_id: int) -> DataFrame:
        (rows,) = batches.values()
        spark = rows.sparkSession
        fresh = latest_by(self.derive(rows) if self.derive else rows, self.keys, self.order)
        parts = [r[0] for r in fresh.select(bucket_of(self.keys, self.buckets)).distinct().collect()]  # at most ``buckets`` numbers
        old = self.table.read(spark, before=batch_id, parts=parts)
        known = fresh.limit(0) if old is None else key_filter(old, fresh, self.keys).select(*fresh.columns)
        changes = diff_results(known, latest_by(known.unionByName(fresh), self.keys, self.order), self.keys)
        self.table.apply(changes, batch_id)
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            self.table.compact(spark)
        return self.table.batch(spark, batch_id, changes.schema)

    def read(self, spark: SparkSession) -> DataFrame | None:
        return self.table.read(spark)


@dataclass
class MovingMaximum:
    """The greatest value seen, one number per batch, in microseconds; appends only."""

    path: str

    def advance(self, rows: DataFrame, ts: str, batch_id: int) -> None:
        """Note the maximum up to this batch."""
        spark = rows.sparkSession
        here = rows.agg(F.max(event_micros(ts))).first()[0]
        known = [v for v in (here, self.at(spark, batch_id - 1)) if v is not None]
        spark.createDataFrame([(max(known) if known else None,)], "value long").write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def at(self, spark: SparkSession, batch_id: int) -> int | None:
        """The maximum after a batch, None before the first value."""
        try:
            noted = spark.read.schema("value long, batch long").parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return noted.where(F.col("batch") <= batch_id).agg(F.max("value")).first()[0]

    def crossed(self, spark: SparkSession, batch_id: int, limits: Sequence[str], width: str) -> DataFrame:
        """(slot): the slots of ``width`` with values whose distance to the maximum passed one of ``limits`` in this batch.

        This is the calendar of a step score: a value x passes limit d when the
        maximum passes x + d, so of all slots only those near maximum - d change.
        """
        before, now = self.at(spark, batch_id - 1), self.at(spark, batch_id)
        step = micros(width)
        spans = [] if before is None or now is None or before == now else [
            ((before - micros(d)) // step, (now - micros(d)) // step) for d in limits]
        frame = spark.createDataFrame(spans, "low long, high long")
        return frame.select(F.explode(F.sequence("low", "high")).alias("slot")).distinct()
