"""Latest row per key, DISTINCT ON, and top-n, all with map-side reduction."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str], chooser) -> DataFrame:
    row = F.struct(*[F.col(c) for c in df.columns])
    rank = F.struct(*[F.col(c) for c in order])
    grouping = [k if isinstance(k, Column) else F.col(k) for k in keys]
    names = [f"_k{i}" for i in range(len(grouping))]
    return (
        df.groupBy(*[k.alias(n) for k, n in zip(grouping, names)])
        .agg(chooser(row, rank).alias("_row"))
        .select("_row.*")
    )


def latest_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    An aggregate rather than ROW_NUMBER() = 1: each task keeps one row per key
    before the shuffle, so a hot key never travels whole.  Keys may be
    expressions, which also gives DISTINCT ON (expr) with an explicit order.
    """
    return _pick(df, keys, order, F.max_by)


def earliest_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order, F.min_by)


def top_n(df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int,
          rank: str = "rank") -> DataFrame:
    """First ``n`` rows per partition by ROW_NUMBER; give a full order to settle ties.

    The rank filter lets Spark add WindowGroupLimit, so each task forwards at
    most ``n`` rows per partition to the shuffle.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (TakeOrderedAndProject: each task sends at most k rows)."""
    return df.orderBy(*order).limit(k)


def ordering(order: Sequence[tuple[str, bool]]) -> list[Column]:
    """Sort columns from (name, ascending) pairs; NULL comes first ascending and last descending, as Spark sorts."""
    return [F.asc(c) if up else F.desc(c) for c, up in order]


def precedes(order: Sequence[tuple[str, bool]], left: Callable[[str], Column], right: Callable[[str], Column]) -> Column:
    """Whether the left row comes strictly before the right one in ``ordering(order)``."""
    before, equal = F.lit(False), F.lit(True)
    for name, up in order:
        a, b = left(name), right(name)
        low, high = (a, b) if up else (b, a)
        # NULL sorts below every value.
        less = F.coalesce(low < high, low.isNull() & high.isNotNull())
        before, equal = before | (equal & less), equal & a.eqNullSafe(b)
    return before


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """One page of a sorted result, with the total row count on every row."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return df.orderBy(*order).offset(offset).limit(limit).withColumn("total", total.scalar())
