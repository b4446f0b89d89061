"""Stream-stream joins on keys and a time interval."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import micros
from tidemill.operators.joins import band_join, outer_band_join
from tidemill.streaming.runners import MaintainedView, Slots


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[Column], left_ts: str, right_ts: str, before: str,
                  after: str, how: str = "inner", lateness: str | None = None) -> DataFrame:
    """Pairs that meet ``on`` with ``right_ts`` between ``left_ts`` - ``before`` and ``left_ts`` + ``after``.

    Works on streams and on batch frames.  Without ``lateness`` no row is ever
    too late, and on streams both sides are kept for good; then only inner
    joins are possible there.  ``lateness`` bounds the state: it is the stated
    limit after which a late row no longer finds partners, and it lets a
    ``left`` join report rows that found none.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    if how == "left" and lateness is None and left.isStreaming:
        raise ValueError("a left join of streams needs a lateness")
    a, b = (df.withColumn(ts, F.col(ts).cast("timestamp")) for df, ts in ((left, left_ts), (right, right_ts)))
    if lateness is not None:
        a, b = a.withWatermark(left_ts, lateness), b.withWatermark(right_ts, lateness)
    near = (F.col(right_ts) >= F.col(left_ts) - F.expr(f"INTERVAL {before}")) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {after}"))
    for condition in on:
        near = near & condition
    return a.join(b, near, how)


def outer_interval_view(path: str, keys: Mapping[str, str], left_ts: str, right_ts: str, left_id: str, right_id: str, before: str,
                        after: str, how: str = "full", width: str | None = None, **runner) -> MaintainedView:
    """A ``left`` or ``full`` outer interval join of the streams ``left`` and ``right`` that takes early NULLs back.

    A row without a partner is reported at once; when a partner comes, however
    late, that row is deleted and the pair inserted.  No row is ever too late.
    ``left_id`` and ``right_id`` tell the rows of a side apart.  A batch reads
    the rows of its keys in the time slots it reaches.
    """
    if how not in ("left", "full"):
        raise ValueError("how is left or full")
    scope = [f"join_{a}" for a in keys]
    named = lambda pairs: lambda df: df.withColumns({f"join_{a}": F.col(c) for a, c in pairs})

    def compute(left: DataFrame, right: DataFrame) -> DataFrame:
        left, right = left.drop(*scope), right.drop(*scope)
        if how == "left":
            joined = band_join(left, right, keys, left_ts, right_ts, before, after, "left")
        else:
            joined = outer_band_join(left, right, keys, left_ts, right_ts, before, after)
        mine = F.col(left_id).isNotNull()
        return joined.withColumns({**{f"join_{a}": F.when(mine, F.col(a)).otherwise(F.col(b)) for a, b in keys.items()},
                                   "joined_at": F.when(mine, F.col(left_ts)).otherwise(F.col(right_ts))})

    reach = max(before, after, key=micros)
    return MaintainedView(path, compute, [*scope, left_id, right_id], scope, derive={"left": named([(a, a) for a in keys]), "right": named(keys.items())},
                          slots=Slots({"left": left_ts, "right": right_ts}, "joined_at", before=reach, after=reach, width=width), **runner)
