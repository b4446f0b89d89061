"""Tumbling and hopping windows as columns on rows.

A window is attached to rows (not to an aggregate), so a plan can filter or
join first and aggregate later, in batch and on a stream alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _flatten(df: DataFrame, window) -> DataFrame:
    framed = df.withColumn("_window", window)
    return framed.withColumns(
        {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    ).drop("_window")


def tumble(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Add ``window_start``/``window_end`` of the fixed window that holds ``ts``."""
    return _flatten(df, F.window(F.col(ts), size))


def hop(df: DataFrame, ts: str, slide: str, size: str) -> DataFrame:
    """One row per hopping window that holds ``ts``: slide first, then size."""
    return _flatten(df, F.window(F.col(ts), size, slide))
