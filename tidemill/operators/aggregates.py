"""Aggregate expressions shared by the plans, and an exact distributed median."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.scalar import ColumnLike, as_col
from tidemill.operators.keyed import key_join


def count_where(condition: Column) -> Column:
    """COUNT(*) FILTER (WHERE condition)."""
    return F.count_if(condition)


def sum_where(condition: Column, value: ColumnLike) -> Column:
    """SUM(CASE WHEN condition THEN value ELSE 0 END)."""
    value = as_col(value)
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def distinct_where(condition: Column, value: ColumnLike) -> Column:
    """COUNT(DISTINCT CASE WHEN condition THEN value END)."""
    return F.count_distinct(F.when(condition, as_col(value)))


def distinct_per_kind(df: DataFrame, keys: Sequence[str], kind: str, item: str, counts: Mapping[str, str],
                      sums: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Distinct ``item`` per kind, one column each, and sums over one kind, per key.

    Several conditional distinct counts in one aggregate make Spark copy every
    row once per count.  An item has one kind per row, so one grouping by
    (key, kind, item) answers all of them, and a hot key is spread by item.
    ``counts`` maps a result column to a kind, ``sums`` to (kind, column).
    """
    sums = dict(sums or {})
    once = df.groupBy(*keys, F.col(kind).alias("_kind"), F.col(item).alias("_item")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_s_{n}") for n, (_, c) in sums.items()])
    return once.groupBy(*keys).agg(
        *[F.count_if((F.col("_kind") == k) & F.col("_item").isNotNull()).alias(n) for n, k in counts.items()],
        *[zero_filled(F.sum(F.when(F.col("_kind") == k, F.col(f"_s_{n}")))).alias(n) for n, (k, _) in sums.items()])


def first_by(value: ColumnLike, *order: ColumnLike) -> Column:
    """FIRST_VALUE(value ORDER BY order) as an aggregate."""
    return F.min_by(as_col(value), F.struct(*[as_col(o) for o in order]))


def last_by(value: ColumnLike, *order: ColumnLike) -> Column:
    """LAST_VALUE(value ORDER BY order) as an aggregate."""
    return F.max_by(as_col(value), F.struct(*[as_col(o) for o in order]))


def zero_filled(agg: Column) -> Column:
    return F.coalesce(agg, F.lit(0))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, into: str, band: float = 0.02) -> DataFrame:
    """PERCENTILE_CONT(0.5) per key without gathering a key in one place.

    A quantile sketch per key, whose rank error is a hundredth of ``band``,
    gives two borders around the median.  Values below them are only counted;
    of those between them, about ``band`` of a key's values, the exact ranks are
    taken.  The borders follow the data, whatever their spread.
    """
    v, low, high = F.col("_v"), F.col("_q")[0], F.col("_q")[1]
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    borders = rows.groupBy(*keys).agg(
        F.percentile_approx("_v", [0.5 - band / 2, 0.5 + band / 2], int(100 / band)).alias("_q"), F.count(F.lit(1)).alias("_total"))
    # One row for all values below the band (its _v is NULL, which sorts first), one per value inside.
    counts = key_join(rows, borders, keys).filter(v <= high).groupBy(*keys, "_total", F.when(v >= low, v).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("_from", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    holds = lambda rank: (F.expr(rank) >= F.col("_from")) & (F.expr(rank) < F.col("_from") + F.col("_n"))
    return ranked.groupBy(*keys).agg(
        ((F.max(F.when(holds("(_total - 1) div 2"), v)) + F.max(F.when(holds("_total div 2"), v))) / 2).alias(into))
