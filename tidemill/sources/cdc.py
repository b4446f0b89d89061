"""Change-data-capture feeds: decode envelopes and mirror them as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.changes import fold_changelog

# Operation codes of the common change envelope; r is a snapshot read.
UPSERT_CODES = ("c", "u", "r")


# Where a change stands in the upstream log.
SOURCE = "struct<lsn:bigint, ts_ms:bigint, file:string, pos:bigint, row:bigint>"


def decode_envelope(raw: DataFrame, row_schema: str, value: str = "value") -> DataFrame:
    """Flatten ``{op, before, after, ts_ms, source{lsn, ts_ms, file, pos, row}}`` messages into change rows.

    A delete carries the row in ``before``.  Result: op, seq, commit_ts and the
    columns of ``row_schema``.  ``seq`` compares as the upstream log does:
    snapshot reads come before every logged change; changes go by log file and
    place in it (``lsn`` where there are no files, else ``pos`` and ``row``),
    then by time.  ``commit_ts`` is the upstream commit time, or the message's
    own time where the source names none.
    """
    schema = f"op string, ts_ms bigint, source {SOURCE}, before struct<{row_schema}>, after struct<{row_schema}>"
    change = F.from_json(F.col(value).cast("string"), schema)
    place = F.struct(
        F.when(F.col("c.op") == "r", 0).otherwise(1).alias("logged"),
        F.coalesce("c.source.file", F.lit("")).alias("file"),
        F.coalesce("c.source.lsn", "c.source.pos", F.lit(-1)).alias("pos"),
        F.coalesce("c.source.row", F.lit(0)).alias("row"),
        F.coalesce("c.source.ts_ms", "c.ts_ms", F.lit(-1)).alias("ts_ms"))
    out = raw.select(change.alias("c")).select(
        F.col("c.op").alias("op"), place.alias("seq"),
        F.timestamp_millis(F.coalesce("c.source.ts_ms", "c.ts_ms")).alias("commit_ts"),
        F.when(F.col("c.op") == "d", F.col("c.before")).otherwise(F.col("c.after")).alias("_row"))
    return out.filter(F.col("op").isin(*UPSERT_CODES, "d")).select("op", "seq", "commit_ts", "_row.*")


def mirror(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",), commit_ts: bool = False) -> DataFrame:
    """Current state of the upstream table.

    ``commit_ts=True`` keeps the upstream commit time as a column.
    """
    out = fold_changelog(changes, keys, list(order), keep=("commit_ts",) if commit_ts else ())
    return out if commit_ts or "commit_ts" not in out.columns else out.drop("commit_ts")


def mirror_documents(changes: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Current documents of a collection: ``_id`` and the whole ``payload`` as JSON text."""
    return mirror(changes, ["_id"], order, commit_ts="commit_ts" in changes.columns)
