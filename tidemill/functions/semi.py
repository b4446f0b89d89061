"""JSON helpers: typed access to loosely typed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import ColumnLike, as_col


def json_text(doc: ColumnLike, path: str) -> Column:
    """Text at a JSON path (``$.a.b``), NULL where the path is absent."""
    return F.get_json_object(as_col(doc), path)


def json_number(doc: ColumnLike, field: str, sql_type: str = "bigint") -> Column:
    """A number stored either plainly or wrapped as ``{"$numberLong": "..."}``."""
    wrapped = json_text(doc, f"$.{field}.$numberLong")
    plain = json_text(doc, f"$.{field}")
    as_decimal = F.coalesce(wrapped.try_cast("decimal(38,10)"), plain.try_cast("decimal(38,10)"))
    return F.round(as_decimal, 0).try_cast("bigint") if sql_type == "bigint" else as_decimal.try_cast(sql_type)


def explode_json_array(df: DataFrame, column: str, schema: str, into: str = "item") -> DataFrame:
    """One row per element of a JSON array of objects; empty arrays give none."""
    items = F.from_json(F.col(column), f"array<{schema}>")
    return df.withColumn(into, F.explode(items))


def flatten(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Lift the fields of a struct column to the top level."""
    fields = df.schema[column].dataType.fieldNames()
    lifted = {f"{prefix}{f}": F.col(f"{column}.`{f}`") for f in fields}
    return df.withColumns(lifted).drop(column)
