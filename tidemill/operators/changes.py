"""Keyed change folding: changelogs to tables, results to change feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.latest import latest_by

# Operation names of the change feed.
INSERT, UPDATE_INSERT, UPDATE_DELETE, DELETE = "Insert", "UpdateInsert", "UpdateDelete", "Delete"
DELETE_CODES = ("d", "delete", DELETE, UPDATE_DELETE)


def fold_changelog(changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Current table from a changelog: last change per key, deletes dropped.

    Give ``order`` columns that grow with commit order (log position, commit
    time).  ``keep`` names bookkeeping columns to leave in the result.
    """
    current = latest_by(changes, keys, order).filter(~F.col(op).isin(*DELETE_CODES))
    return current.drop(*[c for c in (op, *order) if c not in keep and c not in keys])


def one_per_key(updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``; without an order a repeated key is an error when the query runs."""
    if order:
        return latest_by(updates, keys, order)
    rows = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*updates.columns)).alias("_row"))
    whole = F.when(F.col("_n") == 1, F.col("_row")).otherwise(
        F.raise_error(F.lit(f"repeated key ({', '.join(keys)}) in updates without an order")).cast(rows.schema["_row"].dataType))
    return rows.select(whole.alias("_row")).select("_row.*")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Target with rows replaced by or added from ``updates``.

    ``order`` names the columns by which the last update of a key wins; without
    it each key may be updated once.
    """
    fresh = one_per_key(updates, keys, order)
    return target.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def update_where(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 order: Sequence[str] = ()) -> DataFrame:
    """Keyed UPDATE: overwrite ``columns`` of matching rows, leave the rest; ``order`` as for ``upsert``."""
    patch = one_per_key(updates, keys, order).select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(patch, list(keys), "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns
    ])


def diff_results(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows that turn ``old`` into ``new``; unchanged keys give none.

    Output is the columns of ``new`` plus ``op`` (Insert, UpdateInsert, Delete).
    """
    values = [c for c in new.columns if c not in keys]
    pack = lambda df, name: df.select(*keys, F.struct(*[F.col(c) for c in values] or [F.lit(1)]).alias(name))
    before, after = pack(old, "_old"), pack(new, "_new")
    both = before.alias("b").join(after.alias("a"), [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys], "full")
    op = (
        F.when(F.col("_old").isNull(), INSERT)
        .when(F.col("_new").isNull(), DELETE)
        .when(~F.col("_old").eqNullSafe(F.col("_new")), UPDATE_INSERT)
    )
    row = F.coalesce(F.col("_new"), F.col("_old"))
    return (
        both.withColumn("op", op).filter(F.col("op").isNotNull())
        .select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
                *[row[c].alias(c) for c in values], "op")
    )
