"""Message decoding: JSON payloads with a declared schema, connector options."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.scalar import moment


def decode_json(raw: DataFrame, schema: str | T.StructType, value: str = "value",
                keep: tuple[str, ...] = (), intervals: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns from a JSON ``value`` column, batch or stream.

    A field that is not declared is dropped, a declared field that is absent is
    NULL, and a message that is not JSON gives a row of NULLs.  ``keep`` carries
    connector columns along (topic, timestamp ...).  ``intervals`` names fields
    declared as a number of minutes that become day-time intervals.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema)
    out = raw.select(*keep, parsed.alias("_row")).select(*keep, "_row.*")
    return out.withColumns({c: F.make_dt_interval(mins=F.col(c).cast("int")) for c in intervals})


def valid_json(raw: DataFrame, value: str = "value") -> DataFrame:
    """Only the messages that parse as JSON."""
    return raw.filter(F.try_parse_json(F.col(value).cast("string")).isNotNull())


def ingested_since(raw: DataFrame, since: Column | str, column: str = "timestamp") -> DataFrame:
    """Skip old messages by ingest time, before they are decoded."""
    return raw.filter(F.col(column) >= moment(since))


def kafka_options(servers: str, topic: str, start: str = "earliest", stream: bool = True,
                  max_per_trigger: int | None = None) -> dict[str, str]:
    """Reader options of a topic.

    ``start`` is ``earliest``, ``latest`` or an epoch-millisecond time.  A batch
    read cannot start at ``latest``.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if start.isdigit():
        options["startingTimestamp"] = start
    elif start in ("earliest", "latest"):
        if start == "latest" and not stream:
            raise ValueError("a batch read cannot start at the latest offset")
        options["startingOffsets"] = start
    else:
        raise ValueError(f"unknown start position: {start!r}")
    if stream and max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(spark: SparkSession, options: Mapping[str, str], stream: bool = True) -> DataFrame:
    """Raw messages of a topic; needs the Kafka package on the session."""
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load()
