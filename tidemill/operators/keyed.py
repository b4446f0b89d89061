"""Join two results on the same key columns, NULL keys included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` (NULL matches NULL); the right copies of the keys are dropped.

    The right keys are renamed first, so both sides may derive from one frame.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def key_filter(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``wanted`` (NULL matches NULL)."""
    renamed = wanted.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    return df.join(renamed, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], "left_semi")
