"""Keep a plan up to date on Structured Streaming.

Two ways, for two kinds of plan:

* ``start_native``: the plan is a streaming query itself (projections, windows,
  update-mode aggregates, stream-static joins).  Its updates are upserted.
* ``MaintainedView``: any plan at all.  Each micro-batch is added to the base
  tables, the affected keys are recomputed with the batch function, and the
  difference to the stored result is written as changes.

Neither drops late rows: without a watermark every row updates its result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidemill.functions.scalar import event_micros, micros
from tidemill.operators.changes import DELETE, DELETE_CODES, INSERT, UPDATE_INSERT, diff_results, one_per_key
from tidemill.operators.keyed import key_filter
from tidemill.operators.latest import latest_by
from tidemill.sinks.keyed import PART, KeyedTable, bucket_of, write_clustered

Handler = Callable[[DataFrame], None]
GONE = "_gone"
SLOT = "_time_slot"


@dataclass(frozen=True)
class Keyed:
    """An input whose rows change.

    ``keys`` name a row; ``order`` the columns by which its versions follow
    each other (without it arrival counts, and a key that comes twice in one
    batch is an error); ``op`` the column that marks deletes, if there is one.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    op: str | None = None


@dataclass(frozen=True)
class Slots:
    """How far in time an input row reaches, and the time slots that bound it.

    ``times`` names the time column of each input, ``result`` that of the
    result.  A row at t bears on results from ``t - before`` to ``t + after``: a
    RANGE frame of length I has ``after`` I, a window told by its start has
    ``before`` its size.  A result at r thus needs the rows from ``r - after`` to
    ``r + before``.  ``width`` is the length of a slot, by default 16 reaches.
    Rows without a time have a slot of their own.
    """

    times: Mapping[str, str]
    result: str
    before: str = "0 seconds"
    after: str = "0 seconds"
    width: str | None = None

    @property
    def micros(self) -> int:
        return micros(self.width) if self.width else 16 * max(micros(self.before), micros(self.after), 1_000_000)

    def number(self, ts: str, shift: int = 0) -> Column:
        us = event_micros(ts) + F.lit(shift)
        return F.floor((us - F.pmod(us, F.lit(self.micros))) / F.lit(self.micros)).cast("long")

    def reached(self, ts: str) -> Column:
        """Slots whose results a row at ``ts`` bears on."""
        return F.explode_outer(F.sequence(self.number(ts, -micros(self.before)), self.number(ts, micros(self.after))))

    def needed(self) -> Column:
        """Slots with rows that the results of a slot need."""
        back, on = (-(-micros(reach) // self.micros) for reach in (self.after, self.before))
        return F.explode_outer(F.sequence(F.col(SLOT) - F.lit(back), F.col(SLOT) + F.lit(on)))


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_native(result: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = None,
                 mode: str = "update") -> StreamingQuery:
    """Run a streaming plan and upsert what it emits by the table's key.

    Without ``every`` the query drains what is available and stops.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch, batch_id)

    writer = result.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    return _trigger(writer, every).start()


def start_append(rows: DataFrame, path: str, checkpoint: str, every: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to files, exactly once (the file sink keeps a commit log)."""
    writer = rows.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(writer, every).start()


def start_handler(rows: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
                  every: str | None = None, mode: str = "append") -> StreamingQuery:
    """Call ``handler(batch, batch_id)`` for every micro-batch."""
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handler)
    return _trigger(writer, every).start()


def start_together(process: Callable[[Mapping[str, DataFrame], int], object], streams: Mapping[str, DataFrame],
                   checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Call ``process(batches, batch_id)`` with the micro-batches of one or more streams."""
    schemas = {n: s.schema for n, s in streams.items()}
    if len(streams) == 1:
        (name, stream), = streams.items()
        return start_handler(stream, lambda b, i: process({name: b}, i), checkpoint, every)
    tagged = [s.select(F.lit(n).alias("_input"), F.struct(*s.columns).alias(f"_{n}")) for n, s in streams.items()]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t, allowMissingColumns=True)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            process({n: batch.filter(F.col("_input") == n).select(f"_{n}.*") for n in schemas}, batch_id)
        finally:
            batch.unpersist()

    return start_handler(union, sink, checkpoint, every)


class MaintainedView:
    """A stored result that follows its input streams.

    ``compute``  the batch plan; takes one DataFrame per input, by name
    ``keys``     key of a result row
    ``scope``    columns that the inputs and the result share and that bound
                 the effect of a row (a user, an asset, a day).  Only touched
                 scopes are recomputed; an empty scope recomputes everything,
                 as a global ranking needs.
    ``shared``   inputs without the scope columns, such as small dimensions; a
                 new row there recomputes everything
    ``derive``   adds the scope columns to an input that names them otherwise
    ``slots``    a bound in time beside the scope: only the slots that a batch
                 reaches are recomputed, from the slots they need, so the cost
                 of a batch does not grow with the history of a key
    ``keyed``    inputs whose rows are updated and deleted: the plan sees the
                 current row of each key, and a row that moves to another scope
                 touches both
    ``also``     scopes that a batch touches beside those of its rows, as when a
                 clock moves on: a function of (spark, batch_id)
    ``on_change``, ``on_delete``  called with the rows that came or changed,
                 and with those that left

    Base rows and results lie in hash buckets of the scope, so a batch reads
    only the buckets it touches.  More ``buckets`` mean finer reads and more,
    smaller files per batch.
    """

    def __init__(self, path: str, compute: Callable[..., DataFrame], keys: Sequence[str], scope: Sequence[str] = (),
                 shared: Sequence[str] = (), derive: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
                 on_change: Handler | None = None, compact_every: int = 0, buckets: int = 256,
                 keyed: Mapping[str, Keyed] | None = None, on_delete: Handler | None = None,
                 slots: Slots | None = None, also: Callable[[SparkSession, int], DataFrame] | None = None):
        if also and (slots or not scope):
            raise ValueError("also names scopes of a view without slots")
        self.also = also
        self.path, self.compute = path.rstrip("/"), compute
        self.keys, self.scope, self.shared = list(keys), list(scope), set(shared)
        self.derive, self.on_change, self.on_delete = dict(derive or {}), on_change, on_delete
        self.compact_every, self.buckets = compact_every, buckets
        self.keyed, self.slots = dict(keyed or {}), slots
        self.place = [*self.scope, SLOT] if slots else self.scope
        self.table = KeyedTable(f"{self.path}/result", keys, self.place, buckets)

    def _append(self, folder: str, rows: DataFrame, cluster: Sequence[str], batch_id: int) -> DataFrame:
        """Write a batch below ``folder``; return all rows there up to the batch."""
        write_clustered(rows, f"{self.path}/{folder}/batch={batch_id}", cluster, self.buckets)
        extra = [T.StructField("batch", T.LongType())] + ([T.StructField(PART, T.IntegerType())] if cluster else [])
        schema = T.StructType([*rows.schema.fields, *extra])
        return rows.sparkSession.read.schema(schema).parquet(f"{self.path}/{folder}").filter(F.col("batch") <= batch_id)

    def _scope_of(self, name: str) -> list[str]:
        return [] if name in self.shared else self.place

    def _add(self, name: str, rows: DataFrame, batch_id: int) -> DataFrame:
        """Write the batch to the base table of an input; return all its rows up to the batch."""
        rows = self.derive[name](rows) if name in self.derive else rows
        if self.slots and name not in self.shared:
            rows = rows.withColumn(SLOT, self.slots.number(self.slots.times[name]))
        if name in self.keyed:
            rows = self._moves(name, rows, batch_id)
        return self._append(f"base/{name}", rows, self._scope_of(name), batch_id)

    def _moves(self, name: str, rows: DataFrame, batch_id: int) -> DataFrame:
        """What a batch of a keyed input does to the scopes: current rows, and marks where a row left.

        All versions lie in buckets of the key, so the previous version of a
        changed row is found without reading other buckets.  A version that
        comes late, behind a newer one, moves nothing.
        """
        spec = self.keyed[name]
        keys, order = list(spec.keys), [*spec.order, "batch"]
        versions = self._append(f"versions/{name}", one_per_key(rows, keys, spec.order), keys, batch_id)
        fresh = versions.filter(F.col("batch") == batch_id)
        parts = [r[0] for r in fresh.select(PART).distinct().collect()]  # at most ``buckets`` numbers
        known = key_filter(versions.filter(F.col(PART).isin(parts)), fresh, keys)
        extra = ["batch", PART, *([spec.op] if spec.op else [])]
        live = [c for c in versions.columns if c not in extra]
        row, rank = F.struct(*[F.col(c) for c in known.columns]), F.struct(*order)
        earlier = F.col("batch") < batch_id
        # A key's newest version and the newest one before this batch, in one aggregate.
        both = known.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
            F.max_by(row, rank).alias("_now"), F.max_by(F.when(earlier, row), F.when(earlier, rank)).alias("_old"))

        def standing(version: str) -> Column:
            there = F.col(version).isNotNull()
            return there & ~F.coalesce(F.col(f"{version}.{spec.op}").isin(*DELETE_CODES), F.lit(False)) if spec.op else there

        stays = F.lit(True)
        for c in self._scope_of(name):
            stays &= F.col(f"_now.{c}").eqNullSafe(F.col(f"_old.{c}"))
        marked = lambda version, gone: F.struct(*[F.col(f"{version}.{c}") for c in live], F.lit(gone).alias(GONE))
        moves = F.array(F.when(standing("_now"), marked("_now", False)),
                        F.when(standing("_old") & ~(standing("_now") & stays), marked("_old", True)))
        return both.select(F.explode(moves).alias("_row")).where(F.col("_row").isNotNull()).select("_row.*")

    def _current(self, name: str, rows: DataFrame) -> DataFrame:
        """Base rows as the plan sees them."""
        if name in self.keyed:
            place = list(dict.fromkeys([*self.keyed[name].keys, *self._scope_of(name)]))
            rows = latest_by(rows, place, ["batch"]).filter(~F.col(GONE)).drop(GONE)
        return rows.drop("batch", PART, SLOT)

    def _result(self, frames: Mapping[str, DataFrame]) -> DataFrame:
        """What the plan makes of the frames, with the slot of each row where there are slots."""
        result = self.compute(**frames)
        return result.withColumn(SLOT, self.slots.number(self.slots.result)) if self.slots else result

    def _located(self, scopes: DataFrame) -> tuple[DataFrame, list[int]]:
        """Scopes and the numbers, at most ``buckets``, of the buckets they lie in."""
        return scopes, [r[0] for r in scopes.select(bucket_of(self.place, self.buckets)).distinct().collect()]

    def _touched(self, frames: Mapping[str, DataFrame], batch_id: int
                 ) -> tuple[tuple[DataFrame, list[int]], tuple[DataFrame, list[int]]] | None:
        """Scopes whose results may change and scopes whose rows those need, with their buckets; None for everything."""
        fresh = {n: df.filter(F.col("batch") == batch_id) for n, df in frames.items()}
        if not self.place or any(not fresh[n].isEmpty() for n in self.shared):
            return None
        scopes = None
        for name, df in fresh.items():
            if name not in self.shared:
                part = df.select(*self.scope, *([self.slots.reached(self.slots.times[name]).alias(SLOT)] if self.slots else []))
                scopes = part if scopes is None else scopes.unionByName(part)
        if self.also:
            scopes = scopes.unionByName(self.also(scopes.sparkSession, batch_id).select(*self.scope))
        results = self._located(scopes.distinct())
        if not self.slots:
            return results, results
        return results, self._located(results[0].select(*self.scope, self.slots.needed().alias(SLOT)).distinct())

    def process(self, batches: Mapping[str, DataFrame], batch_id: int) -> DataFrame:
        """Add one micro-batch per input, bring the result up to date, and return what changed.

        Safe to repeat: the base rows and the changes of a batch are replaced,
        and the old result is read as of just before the batch.
        """
        spark = next(iter(batches.values())).sparkSession
        frames = {name: self._add(name, rows, batch_id) for name, rows in batches.items()}
        touched = self._touched(frames, batch_id)

        def needed(name: str, df: DataFrame) -> DataFrame:
            if touched is None or name in self.shared:
                return df
            scopes, parts = touched[1]
            return key_filter(df.filter(F.col(PART).isin(parts)), scopes, self.place)

        def reached(df: DataFrame) -> DataFrame:
            return df if touched is None else key_filter(df, touched[0][0], self.place)

        result = self._result({n: self._current(n, needed(n, df)) for n, df in frames.items()})
        result = reached(result) if self.slots else result
        old = self.table.read(spark, before=batch_id, parts=None if touched is None else touched[0][1])
        changes = result.withColumn("op", F.lit(INSERT)) if old is None else diff_results(reached(old), result, self.keys)
        self.table.apply(changes, batch_id)
        written = self.table.batch(spark, batch_id, changes.schema)
        if self.on_change or self.on_delete:
            self._notify(written)
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            self.table.compact(spark)
        return written.drop(SLOT)

    def _notify(self, changes: DataFrame) -> None:
        changes = changes.drop(SLOT)
        if self.on_change:
            self.on_change(changes.filter(F.col("op").isin(INSERT, UPDATE_INSERT)))
        if self.on_delete:
            self.on_delete(changes.filter(F.col("op") == DELETE))

    def refresh(self, spark: SparkSession, inputs: Sequence[str]) -> DataFrame:
        """Recompute the result from the stored base rows; return what changed.

        For views that change with the clock alone, where rows must leave the
        result although nothing new arrives.  The changes are written under
        ``refreshes`` and handed to the handlers like those of a batch.  Call
        it between batches, after the first one.
        """
        last = self.table.last_batch(spark)
        if last is None:
            raise ValueError("nothing to refresh: no batch has been processed")
        frames = {}
        for name in inputs:
            rows = spark.read.parquet(f"{self.path}/base/{name}").filter(F.col("batch") <= last)
            frames[name] = self._current(name, rows)
        result = self._result(frames)
        changes = diff_results(self.table.read(spark), result, self.keys)
        # Written before the result is replaced, since they are read from the old one.
        path = f"{self.path}/refreshes/after={last}/{uuid.uuid4().hex[:12]}"
        changes.write.parquet(path)
        self.table.replace(spark, result)
        changes = spark.read.schema(changes.schema).parquet(path)
        self._notify(changes)
        return changes.drop(SLOT)

    def start(self, streams: Mapping[str, DataFrame], checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Follow one or more streams.  Several are tagged and unioned into one query."""
        return start_together(self.process, streams, checkpoint, every)

    def read(self, spark: SparkSession) -> DataFrame | None:
        rows = self.table.read(spark)
        return rows if rows is None else rows.drop(SLOT)
