"""A global top-k that follows updates and deletes without ranking everything again.

Over the changes of a keyed result, every hash part keeps an ordered reserve: its
k best rows and some more, and the best row that is not in it (the bound).  A
row better than the bound joins the reserve, a changed or deleted row leaves it,
and what overflows moves the bound.  Only a part whose reserve falls below k while
rows lie behind its bound is read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.operators.changes import DELETE_CODES, diff_results
from tidemill.operators.keyed import key_join
from tidemill.operators.latest import ordering, precedes, top_k
from tidemill.sinks.keyed import PART, bucket_of
from tidemill.streaming.layers import Layer
from tidemill.streaming.runners import MaintainedView

BOUND, PLACE = "_bound", "_place"


class TopK:
    """The ``k`` first rows of a maintained view by ``order``, (column, ascending) pairs that leave no ties.

    The reserve holds at most ``k + slack`` rows for each bucket of the view and
    is written anew with every batch, so a batch that runs again replaces
    itself.  ``refills`` lists (batch, parts read again) of this object's batches.
    """

    def __init__(self, path: str, view: MaintainedView, order: Sequence[tuple[str, bool]], k: int, slack: int | None = None):
        self.path, self.view, self.order, self.k = path.rstrip("/"), view, list(order), k
        self.size = k + (max(16, k) if slack is None else slack)
        self.refills: list[tuple[int, list[int]]] = []

    # -- stored state --------------------------------------------------------------

    def _load(self, spark: SparkSession, folder: str, batch_id: int) -> DataFrame | None:
        """What the newest batch up to ``batch_id`` left, None at the start."""
        try:
            last = spark.read.parquet(f"{self.path}/marks").where(F.col("batch") <= batch_id).agg(F.max("batch")).first()[0]
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return None if last is None else spark.read.parquet(f"{self.path}/{folder}/batch={last}")

    def _store(self, spark: SparkSession, batch_id: int, **frames: DataFrame) -> None:
        for folder, rows in frames.items():
            rows.write.mode("overwrite").parquet(f"{self.path}/{folder}/batch={batch_id}")
        spark.range(1, numPartitions=1).write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch_id}")

    # -- one batch -----------------------------------------------------------------

    def _part(self) -> Column:
        return bucket_of(self.view.place, self.view.buckets)

    def _ranked(self, rows: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(PART).orderBy(*ordering(self.order)))
        return rows.withColumn(PLACE, place).where(F.col(PLACE) <= self.size + 1)

    def _bounds(self, ranked: DataFrame) -> DataFrame:
        """(part, bound): the first row of each part that does not fit."""
        names = [c for c, _ in self.order]
        return ranked.where(F.col(PLACE) == self.size + 1).select(PART, F.struct(*names).alias(BOUND))

    def process(self, batches: Mapping[str, DataFrame], batch_id: int) -> DataFrame:
        """Follow the view's changes of a batch, already applied to the view; returns the changes of the top rows."""
        (changes,) = batches.values()
        spark, keys = changes.sparkSession, self.view.keys
        columns = [c for c in changes.columns if c != "op"]
        old, bounds = self._load(spark, "reserve", batch_id - 1), self._load(spark, "bounds", batch_id - 1)
        changed = changes.withColumn(PART, self._part())
        fresh = changed.where(~F.col("op").isin(*DELETE_CODES)).drop("op")
        if old is None:
            old, bounds = fresh.limit(0), self._bounds(fresh.withColumn(PLACE, F.lit(0)).limit(0))
        # Rows behind the bound of their part stay outside, and the bound stays the best of those.
        near = fresh.join(bounds, PART, "left").where(
            F.col(BOUND).isNull() | precedes(self.order, lambda c: F.col(c), lambda c: F.col(f"{BOUND}.{c}"))).drop(BOUND)
        kept = key_join(old, changed.select(*keys), keys, "left_anti")
        # Stored, not cached: a cached plan keeps every partition that its shuffle starts with, and these are a few rows.
        path = f"{self.path}/ranked/batch={batch_id}"
        ranked = self._ranked(kept.unionByName(near))
        ranked.write.mode("overwrite").parquet(path)
        ranked = spark.read.schema(ranked.schema).parquet(path)
        cut = self._bounds(ranked).withColumnRenamed(BOUND, "_cut")
        bounds = bounds.join(cut, PART, "full").select(PART, F.coalesce("_cut", BOUND).alias(BOUND))
        reserve = ranked.where(F.col(PLACE) <= self.size).drop(PLACE)
        counts = reserve.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
        low = sorted(r[0] for r in bounds.join(counts, PART, "left").where(F.coalesce("_n", F.lit(0)) < self.k).select(PART).collect())
        if low:  # at most ``buckets`` numbers
            self.refills.append((batch_id, low))
            whole = self.view.table.read(spark, before=batch_id + 1, parts=low).select(*columns).withColumn(PART, self._part())
            again = self._ranked(whole.where(F.col(PART).isin(low)))
            reserve = reserve.where(~F.col(PART).isin(low)).unionByName(again.where(F.col(PLACE) <= self.size).drop(PLACE))
            bounds = bounds.where(~F.col(PART).isin(low)).unionByName(self._bounds(again))
        self._store(spark, batch_id, reserve=reserve, bounds=bounds)
        before, now = self._top(old), self._top(self._load(spark, "reserve", batch_id))
        return diff_results(before, now, keys)

    def _top(self, reserve: DataFrame) -> DataFrame:
        return top_k(reserve.drop(PART), ordering(self.order), self.k)

    def read(self, spark: SparkSession) -> DataFrame | None:
        reserve = self._load(spark, "reserve", 1 << 62)
        return reserve if reserve is None else self._top(reserve)


def ranked_layers(path: str, layers: Mapping[str, tuple[Layer, Sequence[str]]], order: Sequence[tuple[str, bool]], k: int,
                  slack: int | None = None) -> dict[str, tuple[Layer, Sequence[str]]]:
    """``layers`` with the top ``k`` of the last one, a maintained view, on top."""
    name, (view, _) = list(layers.items())[-1]
    return {**layers, "top": (TopK(f"{path}/top", view, order, k, slack), (name,))}
