"""Files, databases and table profiles."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_ndjson(spark: SparkSession, path: str, schema: str, stream: bool = False, max_files: int | None = None) -> DataFrame:
    """One JSON object per line; a broken line is kept in ``_corrupt_record``."""
    reader = (spark.readStream if stream else spark.read).schema(f"{schema}, _corrupt_record string")
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.option("mode", "PERMISSIVE").json(path)


def read_text_tree(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Every file below ``path`` as (file_name, content, modified)."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file_name"), F.col("value").alias("content"),
                F.col("_metadata.file_modification_time").alias("modified"))
    )


def replay(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1, pattern: str = "*.parquet") -> DataFrame:
    """A folder of parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).option("pathGlobFilter", pattern).parquet(path)


def jdbc_query_options(url: str, query: str, user: str = "", password: str = "", fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a one-shot pull of a query."""
    options = {"url": url, "query": query, "fetchsize": str(fetch_size)}
    if user:
        options.update(user=user, password=password)
    return options


def jdbc_table_options(url: str, table: str, column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options of a pull split into ``partitions`` range queries on a numeric column."""
    return {"url": url, "dbtable": table, "partitionColumn": column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions)}


def pull(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


# -- schema inference and profiles ------------------------------------------------------

_ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def infer_fields(messages: DataFrame, value: str = "value") -> DataFrame:
    """Fields of JSON messages with a guessed SQL type; messages that are not objects are skipped.

    Decimals become DECIMAL, whole numbers INT (BIGINT when wide), true/false
    BOOLEAN, ISO times TIMESTAMP and everything else VARCHAR; a field with
    mixed kinds takes the widest.  All messages count, in one aggregate.
    """
    parsed = messages.select(F.from_json(F.col(value).cast("string"), "map<string,string>").alias("_m"))
    fields = parsed.filter(F.col("_m").isNotNull()).select(F.explode("_m").alias("field", "text")).filter("text IS NOT NULL")
    text = F.col("text")
    rank = (
        F.when(text.isin("true", "false"), 0)
        .when(text.rlike(r"^-?\d{1,9}$"), 1).when(text.rlike(r"^-?\d+$"), 2)
        .when(text.rlike(r"^-?\d*\.\d+([eE][+-]?\d+)?$"), 3).when(text.rlike(_ISO_TIME), 4).otherwise(5)
    )
    seen = fields.groupBy("field").agg(
        F.min(rank).alias("_lo"), F.max(rank).alias("_hi"), F.count(F.lit(1)).alias("messages"))
    numeric = (F.col("_lo") >= 1) & (F.col("_hi") <= 3)
    names = F.array(*[F.lit(n) for n in ("BOOLEAN", "INT", "BIGINT", "DECIMAL", "TIMESTAMP", "VARCHAR")])
    kind = F.when((F.col("_lo") == F.col("_hi")) | numeric, names[F.col("_hi")]).otherwise("VARCHAR")
    return seen.select("field", kind.alias("type"), "messages")


def declared_schema(fields: DataFrame) -> str:
    """DDL for ``decode_json`` from inferred fields (one small row per field)."""
    spark_types = {"VARCHAR": "string", "DECIMAL": "decimal(38,10)"}
    rows = sorted((r["field"], r["type"]) for r in fields.collect())
    safe = lambda n: n if re.fullmatch(r"\w+", n) else f"`{n}`"
    return ", ".join(f"{safe(n)} {spark_types.get(t, t.lower())}" for n, t in rows)


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Rows, nulls, distinct values, minimum and maximum of every column that can be ordered.

    Arrays, maps and structs are not listed.  One scan and one aggregate; the
    distinct counts (``distinct_about``) are then estimates within 1 %.
    ``exact`` counts them in full (``distinct_values``), which sends each
    column's different values through one more shuffle.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(plain):
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
        aggs += [] if exact else [F.approx_count_distinct(c, 0.01).alias(f"d{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("type"), F.col("rows"),
                     (F.col("rows") - F.col(f"n{i}")).alias("nulls"), *([] if exact else [F.col(f"d{i}").alias("distinct_about")]),
                     F.col(f"lo{i}").alias("minimum"), F.col(f"hi{i}").alias("maximum")) for i, c in enumerate(plain)]
    listed = wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
    if not exact:
        return listed
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in plain])).alias("_c"))
    counts = cells.select("_c.*").where("v IS NOT NULL").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    return listed.join(counts, "column", "left").fillna({"distinct_values": 0})


def describe(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields],
                                 "column string, type string, nullable boolean")
