"""Rows that leave by the clock: a moving ``now`` filter kept by timers.

``retained`` turns a stream of rows into a stream of changes.  A row enters as
``Insert`` when it arrives and leaves as ``Delete`` when its time plus ``keep`` has
passed, by the event clock (the newest event time seen, less a lateness) or by
the wall clock.  Nothing is recomputed: rows wait in state by the slot of their
end, and a timer opens a slot when its first row is due.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemill.functions.scalar import event_micros, micros
from tidemill.operators.changes import DELETE, INSERT

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows wait in state as text that keeps every digit of a time.
_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """State with timers and lists lives in the RocksDB provider; a query takes the setting when it starts."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class Retention(StatefulProcessor):
    """Rows of one slot of ends.  One timer stands at the first end that is still to come.

    A timer reads the rows of its own slot, so the cost of time passing follows
    the rows that end, not those that are kept.  Rows that come together lie in
    state as one entry, a line each (their text holds no line break), with
    their ends: an entry costs about the same whatever it holds.
    """

    def __init__(self, event_clock: bool):
        self.event_clock = event_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "rows string, due string")

    @staticmethod
    def _entry(rows: pd.Series, due: np.ndarray) -> tuple[str, str]:
        return "\n".join(rows), ",".join(map(str, due.tolist()))

    def _now(self, timers) -> int:
        return timers.getCurrentWatermarkInMs() if self.event_clock else timers.getCurrentProcessingTimeInMs()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now, first = self._now(timerValues), None
        for batch in rows:
            # A row that comes after its end never enters.
            fresh = batch[batch["due"] > now]
            if len(fresh):
                due = fresh["due"].to_numpy(dtype=np.int64)
                self.rows.appendValue(self._entry(fresh["row"], due))
                first = min(int(due.min()), first or int(due.min()))
                yield pd.DataFrame({"row": fresh["row"], "op": INSERT})
        if first is not None:
            self.handle.registerTimer(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(self._now(timerValues), expiredTimerInfo.getExpiryTimeInMs())
        kept, gone, first = [], [], None
        for rows, due in self.rows.get():
            rows, due = pd.Series(rows.split("\n")), np.array(due.split(","), dtype=np.int64)
            over = due <= now
            gone.append(rows[over])
            if not over.all():
                kept.append(self._entry(rows[~over], due[~over]))
                first = min(int(due[~over].min()), first or int(due[~over].min()))
        if not any(map(len, gone)):
            return
        if kept:
            self.rows.put(kept)
            self.handle.registerTimer(first)
        else:
            self.rows.clear()
        for rows in gone:
            yield pd.DataFrame({"row": rows, "op": DELETE})

    def close(self) -> None:
        pass


def retained(rows: DataFrame, ts: str, keep: str, clock: str = "event", lateness: str = "0 seconds", slot: str | None = None,
             buckets: int = 64) -> DataFrame:
    """Changes that keep the rows with ``ts`` no older than ``keep``: the columns of ``rows`` and ``op``.

    ``clock`` is ``event`` (the newest ``ts`` of earlier batches less ``lateness``) or
    ``processing`` (the wall clock).  Ends are told apart by milliseconds.  State
    is grouped by the slot of a row's end, by default a sixteenth of ``keep``, and
    by one of ``buckets`` hashes, so that a burst spreads over many tasks.  Rows
    without a time never enter, equal rows enter and leave one by one.
    """
    if clock not in ("event", "processing"):
        raise ValueError("clock is event or processing")
    width = max(1, micros(slot) // 1000 if slot else micros(keep) // 16_000)
    timed = rows.where(F.col(ts).isNotNull())
    due = F.floor((event_micros(ts) + F.lit(micros(keep))) / 1000) + 1
    packed = timed.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), _TEXT).alias("row"), due.cast("long").alias("due"),
                          F.col(ts).cast("timestamp").alias("_clock"))
    if clock == "event":
        packed = packed.withWatermark("_clock", lateness)
    grouped = packed.withColumns({"_slot": F.floor(F.col("due") / width), "_part": F.pmod(F.xxhash64("row"), F.lit(buckets))}).groupBy("_slot", "_part")
    changes = grouped.transformWithStateInPandas(Retention(clock == "event"), "row string, op string", "Append",
                                                 "EventTime" if clock == "event" else "ProcessingTime")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    return changes.select(F.from_json("row", schema, _TEXT).alias("_row"), "op").select("_row.*", "op")


def sign(op: str = "op") -> Column:
    """1 for a row that enters, -1 for one that leaves."""
    return F.when(F.col(op) == INSERT, 1).otherwise(-1)


def present(changes: DataFrame) -> DataFrame:
    """Rows that have entered and not left, as often as they are there."""
    columns = [c for c in changes.columns if c != "op"]
    left = changes.groupBy(*columns).agg(F.sum(sign()).alias("_n")).where("_n > 0")
    return left.withColumn("_n", F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int")))).select(*columns)


def running_totals(changes: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """Sums over the rows that are there, from the changes alone: what leaves is taken off again; keys without rows are gone."""
    sums = {name: F.sum(value * sign()).alias(name) for name, value in totals.items()}
    return changes.groupBy(*keys).agg(F.sum(sign()).alias("_rows"), *sums.values()).where("_rows > 0").drop("_rows")
