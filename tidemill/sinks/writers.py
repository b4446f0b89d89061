"""Batch writers used by the streaming runners and on their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.changes import DELETE_CODES
from tidemill.operators.latest import latest_by


def with_defaults(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Column defaults of a literal insert: a missing or NULL value takes the default."""
    out = rows
    for name, value in defaults.items():
        value = value if hasattr(value, "cast") else F.lit(value)
        out = out.withColumn(name, F.coalesce(F.col(name), value) if name in rows.columns else value)
    return out


def append_only(changes: DataFrame) -> DataFrame:
    """Force a change feed to appends: inserts and new versions stay, deletes drop, ``op`` goes."""
    return changes.filter(~F.col("op").isin(*DELETE_CODES)).drop("op")


def as_messages(rows: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """JSON messages, one per row, with a JSON key when asked for."""
    value = F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("value")
    return rows.select(*([F.to_json(F.struct(*key)).alias("key")] if key else []), value)


def write_batch(rows: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Append one batch under its own folder; running it again replaces it."""
    rows.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch={batch_id}")


def append_to_table(spark: SparkSession, rows: DataFrame, table: str, partition_by: Sequence[str] = (),
                    fmt: str = "parquet") -> None:
    """Append to a table, creating it on first use."""
    if spark.catalog.tableExists(table):
        rows.select(*spark.table(table).columns).write.insertInto(table)
    else:
        rows.write.format(fmt).partitionBy(*partition_by).saveAsTable(table)


def create_table_as(rows: DataFrame, table: str, fmt: str = "parquet") -> None:
    rows.write.mode("overwrite").format(fmt).saveAsTable(table)


def jdbc_upsert_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows to stage for a database upsert: only the last version of each key."""
    return latest_by(rows, keys, order)


def stage_to_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Write a staging table; the database merges it into the target by key."""
    rows.write.jdbc(url, table, mode="overwrite", properties=properties or {})
