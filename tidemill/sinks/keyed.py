"""Result tables fed by micro-batches: change feed inside, current rows outside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.changes import DELETE_CODES, UPDATE_INSERT
from tidemill.operators.latest import latest_by


PART = "_part"


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def write_clustered(rows: DataFrame, path: str, cluster_by: Sequence[str], buckets: int) -> None:
    """Overwrite a folder, split by the hash bucket of ``cluster_by``.

    The rebalance hint gathers a bucket into few files and lets AQE split the
    bucket of a hot key over several tasks.
    """
    if cluster_by:
        rows = rows.withColumn(PART, bucket_of(cluster_by, buckets)).hint("rebalance", PART)
        rows.write.mode("overwrite").partitionBy(PART).parquet(path)
    else:
        rows.write.mode("overwrite").parquet(path)


class KeyedTable:
    """A parquet folder that takes keyed changes and reads as the current table.

    Each batch writes its own ``batch=<id>`` partition in overwrite mode, so a
    batch that is run again replaces itself: at-least-once delivery becomes
    exactly-once.  Readers fold the changes per key; ``compact`` bounds that
    fold with a snapshot.  On a lake catalog use ``merge_into`` instead.

    ``cluster_by`` (columns of the rows) spreads the files over ``buckets``
    folders by hash, so that a reader who knows the touched buckets skips the
    rest.
    """

    def __init__(self, path: str, keys: Sequence[str], cluster_by: Sequence[str] = (), buckets: int = 16):
        self.path, self.keys = path.rstrip("/"), list(keys)
        self.cluster_by, self.buckets = list(cluster_by), buckets

    def _write(self, rows: DataFrame, folder: str) -> None:
        write_clustered(rows, f"{self.path}/{folder}", self.cluster_by, self.buckets)

    def apply(self, rows: DataFrame, batch_id: int, order: Sequence[str] = ()) -> None:
        """Store the last row per key of one batch; ``op`` defaults to an upsert."""
        if "op" not in rows.columns:
            rows = rows.withColumn("op", F.lit(UPDATE_INSERT))
        if order:
            rows = latest_by(rows, self.keys, order)
        self._write(rows, f"changes/batch={batch_id}")

    def _load(self, spark: SparkSession, folder: str, parts: Sequence[int] | None) -> DataFrame | None:
        try:
            rows = spark.read.parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            # Nothing written yet, or nothing but empty batches; any other fault is one.
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        if self.cluster_by:
            rows = (rows if parts is None else rows.filter(F.col(PART).isin(list(parts)))).drop(PART)
        return rows

    def changes(self, spark: SparkSession, before: int | None = None, parts: Sequence[int] | None = None) -> DataFrame | None:
        """Change rows with their ``batch``, or None when nothing was written."""
        rows = self._load(spark, "changes", parts)
        return rows if rows is None or before is None else rows.filter(F.col("batch") < before)

    def batch(self, spark: SparkSession, batch_id: int, columns: T.StructType) -> DataFrame:
        """The changes of one batch; ``columns`` is the schema they were written with."""
        rows = spark.read.schema(columns).parquet(f"{self.path}/changes/batch={batch_id}")
        return rows.drop(PART) if self.cluster_by else rows

    def _snapshot(self, spark: SparkSession, before: int | None, parts: Sequence[int] | None) -> tuple[DataFrame | None, int] | None:
        """Rows of the newest snapshot (None: it holds none) and the batch it reaches to.

        Its number comes from a mark written after it, not from its rows, so that an empty one counts.
        """
        try:
            marks = spark.read.parquet(f"{self.path}/marks")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        newest = (marks if before is None else marks.filter(F.col("upto") < before)).agg(F.max("upto")).first()[0]
        if newest is None:
            return None
        rows = self._load(spark, "snapshot", parts)
        return (None if rows is None else rows.filter(F.col("upto") == newest).drop("upto")), newest

    def _write_snapshot(self, spark: SparkSession, rows: DataFrame, upto: int) -> None:
        self._write(rows, f"snapshot/upto={upto}")
        spark.range(1, numPartitions=1).write.mode("overwrite").parquet(f"{self.path}/marks/upto={upto}")

    def read(self, spark: SparkSession, before: int | None = None, parts: Sequence[int] | None = None) -> DataFrame | None:
        """Current rows, optionally as of just before a batch and of some buckets only."""
        rows = self.changes(spark, before, parts)
        if rows is None:
            return None
        snapshot = self._snapshot(spark, before, parts)
        if snapshot:
            base, upto = snapshot
            rows = rows.filter(F.col("batch") > upto)
            if base is not None:
                rows = rows.unionByName(base.withColumns({"op": F.lit(UPDATE_INSERT), "batch": F.lit(upto)}))
        return latest_by(rows, self.keys, ["batch"]).filter(~F.col("op").isin(*DELETE_CODES)).drop("op", "batch")

    def last_batch(self, spark: SparkSession) -> int | None:
        rows = self.changes(spark)
        return None if rows is None else rows.agg(F.max("batch")).first()[0]

    def compact(self, spark: SparkSession) -> None:
        """Write the current rows as a snapshot; later reads start from it."""
        last = self.last_batch(spark)
        newest = self._snapshot(spark, None, None)
        # A snapshot that is up to date stays: it must not be overwritten while it is read.
        if last is not None and (newest is None or newest[1] < last):
            self._write_snapshot(spark, self.read(spark), last)

    def replace(self, spark: SparkSession, rows: DataFrame) -> None:
        """Make ``rows`` (computed from elsewhere) the whole current table."""
        self._write_snapshot(spark, rows, self.last_batch(spark))


def merge_into(table: str, source: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """MERGE statement of an upsert into a lake table (needs a catalog that supports it)."""
    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    deletes = ", ".join(f"'{c}'" for c in DELETE_CODES)
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns if c not in keys)
    names, values = ", ".join(f"`{c}`" for c in columns), ", ".join(f"s.`{c}`" for c in columns)
    return (f"MERGE INTO {table} t USING {source} s ON {on} "
            f"WHEN MATCHED AND s.op IN ({deletes}) THEN DELETE WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED AND s.op NOT IN ({deletes}) THEN INSERT ({names}) VALUES ({values})")
