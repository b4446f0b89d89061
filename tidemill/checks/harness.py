"""Bind plans to the sample tables and pair each with its SQL oracle.

An *input* is portable SQL that shapes a sample table into the schema a plan
expects; Spark and the oracle engine run the same text.  A *check* names its
inputs, builds a DataFrame from them and may give the oracle query.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import RUNTIME_CONF, SPREAD_CONF, tune

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

INPUTS: dict[str, str] = {}
_SCHEMAS: dict[str, T.StructType] = {}  # schema per file, so that it is inferred once


class Check(NamedTuple):
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    oracle: str | None
    wants_spark: bool


CHECKS: dict[str, Check] = {}


def declare(**inputs: str) -> None:
    for name, text in inputs.items():
        if name in INPUTS or name in TABLES:
            raise ValueError(f"input {name} is already declared")
        INPUTS[name] = text


def check(name: str, *inputs: str, oracle: str | None = None, wants_spark: bool = False):
    """Register a query.  ``wants_spark`` passes (spark, sf_dir) before the inputs."""

    def register(build):
        if name in CHECKS:
            raise ValueError(f"check {name} is already registered")
        CHECKS[name] = Check(name, inputs, build, oracle, wants_spark)
        return build

    return register


def _refs(text: str) -> list[str]:
    return list(dict.fromkeys(f for _, f, _, _ in string.Formatter().parse(text) if f))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table, or an input derived from it."""
    if name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = spark.read.parquet(path).schema
        return spark.read.schema(_SCHEMAS[path]).parquet(path)
    text = INPUTS[name]
    return spark.sql(text, **{ref: load(spark, sf_dir, ref) for ref in _refs(text)})


def plain(df: DataFrame) -> DataFrame:
    """Result in the types both engines share: bigint, double, timestamp, text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.DateType)):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark, RUNTIME_CONF | SPREAD_CONF)
    spec = CHECKS[name]
    frames = [load(spark, sf_dir, i) for i in spec.inputs]
    return plain(spec.build(spark, sf_dir, *frames) if spec.wants_spark else spec.build(*frames))


def _closure(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in INPUTS and n not in seen:
            for ref in _refs(INPUTS[n]):
                visit(ref)
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def oracle_text(name: str) -> str | None:
    spec = CHECKS[name]
    if spec.oracle is None:
        return None
    ctes = ", ".join(
        f"{n} AS ({INPUTS[n].format(**{r: r for r in _refs(INPUTS[n])})})" for n in _closure(spec.inputs))
    body = spec.oracle.strip().rstrip(";")
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
