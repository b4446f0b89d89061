"""Commit every n batches: readers see whole commits only.

Batches are staged under their own number as they come, and a mark that covers n
of them is written after the n-th.  A batch that runs again replaces its own
files; one that a mark covers already is left alone, so what was read stays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sinks.keyed import KeyedTable


@dataclass(frozen=True)
class Commits:
    """Commit marks below ``path``, one per ``every`` batches; batches are numbered from 0 without gaps."""

    path: str
    every: int

    def __post_init__(self):
        if self.every < 1:
            raise ValueError("every is 1 or more")

    def last(self, spark: SparkSession) -> int:
        """The last batch that readers see, -1 before the first commit."""
        try:
            found = spark.read.schema("id long, upto long").parquet(self.path).agg(F.max("upto")).first()[0]
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return -1
            raise
        return -1 if found is None else found

    def mark(self, spark: SparkSession, batch_id: int) -> None:
        """Show everything up to a batch.  A mark is one file that appears by a rename."""
        if self.last(spark) < batch_id:
            spark.range(1, numPartitions=1).write.mode("overwrite").parquet(f"{self.path}/upto={batch_id}")

    def staging(self, write: Callable[[DataFrame, int], object]) -> Callable[[DataFrame, int], None]:
        """A batch handler that stages with ``write`` (which replaces what it wrote for the same batch) and commits every n-th time."""

        def handler(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            if batch_id <= self.last(spark):
                return
            write(batch, batch_id)
            if (batch_id + 1) % self.every == 0:
                self.mark(spark, batch_id)

        return handler


class StagedAppends:
    """Append-only rows in commits of ``every`` batches."""

    def __init__(self, path: str, every: int):
        self.rows, self.commits = f"{path.rstrip('/')}/rows", Commits(f"{path.rstrip('/')}/commits", every)
        self.handler = self.commits.staging(lambda batch, i: batch.write.mode("overwrite").parquet(f"{self.rows}/batch={i}"))

    def read(self, spark: SparkSession) -> DataFrame | None:
        upto = self.commits.last(spark)
        return None if upto < 0 else spark.read.parquet(self.rows).where(F.col("batch") <= upto).drop("batch")


class StagedUpserts:
    """Keyed changes in commits of ``every`` batches; a reader folds the committed ones."""

    def __init__(self, path: str, keys: Sequence[str], every: int, order: Sequence[str] = ()):
        self.table, self.commits = KeyedTable(f"{path.rstrip('/')}/table", keys), Commits(f"{path.rstrip('/')}/commits", every)
        self.handler = self.commits.staging(lambda batch, i: self.table.apply(batch, i, order))

    def read(self, spark: SparkSession) -> DataFrame | None:
        upto = self.commits.last(spark)
        return None if upto < 0 else self.table.read(spark, before=upto + 1)
