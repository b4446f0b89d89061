"""Joins Spark has no direct syntax for: as-of, band, and row-in-window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.scalar import event_micros, micros


def _slot(us: Column, width: int) -> Column:
    return us - F.pmod(us, F.lit(width))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
              payload: Sequence[str], how: str = "left", tie: Sequence[str] = (),
              slot: str = "1 day") -> DataFrame:
    """Attach to each left row the latest right row at or before it.

    Both sides are unioned and one window carries the last right row forward.
    Work is cut into (key, time slot), so a hot key spreads over many tasks;
    the state that crosses a slot border is one carry row per (key, slot).
    ``tie`` orders right rows of equal time.  ``how`` is ``left`` or ``inner``.

    Choose ``slot`` so that the rows of the hottest key fit a task per slot and
    most slots hold many rows.  The right side is read twice, so hand over a
    stored table when it is expensive to compute.
    """
    width = micros(slot)
    lhs = left.withColumn("_us", event_micros(left_ts)).withColumn("_slot", _slot(F.col("_us"), width))
    rhs = (
        right.select(*keys, event_micros(right_ts).alias("_us"),
                     F.struct(*[F.col(c) for c in tie], F.lit(0)).alias("_tie"),
                     F.struct(*[F.col(c) for c in payload]).alias("_hit"))
        .na.drop(subset=[*keys, "_us"])  # a NULL key or time never matches
        .withColumn("_slot", _slot(F.col("_us"), width))
    )
    # Last right row of every slot any side touches, then the latest one of an
    # earlier slot: one row per (key, slot) with the row to start from.
    rank = F.when(F.col("_hit").isNotNull(), F.struct("_us", "_tie"))
    slots = (
        rhs.unionByName(lhs.select(*keys, "_slot"), allowMissingColumns=True)
        .groupBy(*keys, "_slot").agg(F.max_by("_hit", rank).alias("_hit"))
    )
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carry = slots.select(*keys, "_slot", F.last("_hit", ignorenulls=True).over(before).alias("_hit"))
    carry = carry.filter(F.col("_hit").isNotNull())

    # Order inside a slot: the carry (NULL time), then by time, right side first.
    events = (
        lhs.withColumn("_side", F.lit(1))
        .unionByName(rhs.withColumn("_side", F.lit(0)), allowMissingColumns=True)
        .unionByName(carry.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    )
    order = [F.col("_us").asc_nulls_first(), "_side", F.col("_tie").asc_nulls_first()]
    frame = Window.partitionBy(*keys, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = events.withColumn("_found", F.last("_hit", ignorenulls=True).over(frame)).filter("_side = 1")
    if how == "inner":
        joined = joined.filter(F.col("_found").isNotNull())
    return joined.select(*left.columns, *[F.col(f"_found.`{c}`").alias(c) for c in payload])


def band_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str], left_ts: str, right_ts: str,
              before: str = "0 seconds", after: str = "0 seconds", how: str = "inner",
              slot: str | None = None) -> DataFrame:
    """Join where ``right_ts`` lies in ``[left_ts - before, left_ts + after]``.

    ``keys`` maps left key columns to right ones; column names of the two sides
    must differ.  Left rows keep one time slot and each right row is copied to
    the slots whose left rows it can reach (two at most by default), so the
    join is an equi-join on (key, slot) and each pair meets exactly once.
    That also makes a left outer join exact.
    """
    back, ahead = micros(before), micros(after)
    width = micros(slot) if slot else max(back + ahead, 1_000_000)
    lhs = left.withColumn("_lus", event_micros(left_ts)).withColumn("_lslot", _slot(F.col("_lus"), width))
    rus = F.col("_rus")
    rhs = (
        right.withColumn("_rus", event_micros(right_ts))
        .filter(rus.isNotNull())
        .withColumn("_rslot", F.explode(F.sequence(
            _slot(rus - F.lit(ahead), width), _slot(rus + F.lit(back), width), F.lit(width))))
    )
    on = [lhs[a] == rhs[b] for a, b in keys.items()]
    on += [F.col("_lslot") == F.col("_rslot"),
           rus >= F.col("_lus") - F.lit(back), rus <= F.col("_lus") + F.lit(ahead)]
    return lhs.join(rhs, on, how).drop("_lus", "_lslot", "_rus", "_rslot")


def outer_band_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str], left_ts: str, right_ts: str,
                    before: str = "0 seconds", after: str = "0 seconds", slot: str | None = None) -> DataFrame:
    """``band_join`` that also keeps the rows of either side without a partner, those without a key or time included."""
    pairs = band_join(left, right, keys, left_ts, right_ts, before, after, "left", slot)
    reach = left.select(*[F.col(a).alias(f"_p_{a}") for a in keys], F.col(left_ts).alias("_p_ts"))
    alone = band_join(right, reach, {b: f"_p_{a}" for a, b in keys.items()}, right_ts, "_p_ts", after, before, "left_anti", slot)
    return pairs.unionByName(alone, allowMissingColumns=True)


def band_totals(left: DataFrame, right: DataFrame, keys: Mapping[str, str], left_ts: str, right_ts: str,
                aggs: Mapping[str, Column], before: str = "0 seconds", after: str = "0 seconds",
                slot: str | None = None) -> DataFrame:
    """Left rows with aggregates over the right rows that ``band_join`` would pair them with.

    No pairs are built: both sides are unioned and one range frame per (key,
    time slot) sums the right rows around each left row.  ``aggs`` are window
    aggregates over right columns that skip NULLs, such as ``count(column)``; a
    left row without right rows keeps their empty value (0 or NULL).  Column
    names of the two sides must differ.
    """
    back, ahead = micros(before), micros(after)
    width = micros(slot) if slot else max(back + ahead, 1_000_000)
    names = list(keys)
    us = F.col("_us")
    lhs = left.withColumn("_us", event_micros(left_ts)).withColumn("_slot", _slot(us, width)).withColumn("_side", F.lit(1))
    rhs = (
        right.na.drop(subset=list(keys.values()))  # a NULL key never matches
        .withColumn("_us", event_micros(right_ts)).filter(us.isNotNull())
        .withColumn("_slot", F.explode(F.sequence(
            _slot(us - F.lit(ahead), width), _slot(us + F.lit(back), width), F.lit(width))))
        .withColumns({a: F.col(b) for a, b in keys.items()}).withColumn("_side", F.lit(0))
    )
    frame = Window.partitionBy(*names, "_slot").orderBy("_us").rangeBetween(-back, ahead)
    both = lhs.unionByName(rhs, allowMissingColumns=True)
    return both.withColumns({n: a.over(frame) for n, a in aggs.items()}).filter("_side = 1").select(*left.columns, *aggs)


def windows_holding(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Tumbling windows with *both* ends inclusive that hold ``ts``.

    A row exactly on a border belongs to the window that ends there as well as
    to the one that starts there (BETWEEN window_start AND window_end).
    """
    width = micros(size)
    us = event_micros(ts)
    framed = df.withColumn("_window", F.window(F.col(ts), size))
    on_border = F.pmod(us, F.lit(width)) == 0
    start = F.col("_window.start")
    back = F.expr(f"INTERVAL '{width / 1_000_000:.6f}' SECOND")
    return framed.withColumn(
        "window_start",
        F.explode(F.when(on_border, F.array(start, start - back)).otherwise(F.array(start))),
    ).drop("_window")


def in_window_counts(anchor: DataFrame, followers: Mapping[str, tuple[DataFrame, str]], anchor_ts: str,
                     user: str, size: str, anchor_name: str) -> DataFrame:
    """Distinct users of the anchor per window, and how many appear in each follower.

    The left joins only ever answer "did this user also act in this window", so
    each side is reduced to distinct (user, window) first: no fan-out.
    """
    w = F.window(F.col(anchor_ts), size)
    base = anchor.select(F.col(user).alias("_u"), w.start.alias("window_start"), w.end.alias("window_end")).distinct()
    for name, (df, ts) in followers.items():
        seen = windows_holding(df, ts, size).select(F.col(user).alias("_u"), "window_start").distinct()
        base = base.join(seen.withColumn(f"_in_{name}", F.lit(1)), ["_u", "window_start"], "left")
    return base.groupBy("window_start", "window_end").agg(
        F.count("_u").alias(anchor_name), *[F.count(f"_in_{n}").alias(n) for n in followers])


def net_of_sums(left: DataFrame, right: DataFrame, key: str, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``sum(l) - sum(r)`` over a many-to-many join, without building the pairs.

    Every left row of a key meets every right row of it, so the left sum is
    multiplied by the right row count and the other way round.
    """
    lhs = left.groupBy(key).agg(F.count(F.lit(1)).alias("_nl"), *[F.sum(a).alias(f"_l_{n}") for n, (a, _) in pairs.items()])
    rhs = right.groupBy(key).agg(F.count(F.lit(1)).alias("_nr"), *[F.sum(b).alias(f"_r_{n}") for n, (_, b) in pairs.items()])
    return lhs.join(rhs, key).select(
        key, *[(F.col(f"_l_{n}") * F.col("_nr") - F.col(f"_r_{n}") * F.col("_nl")).alias(n) for n in pairs])
