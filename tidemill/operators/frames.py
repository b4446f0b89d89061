"""Window functions that stay parallel when one key holds most of the rows.

A plain ``PARTITION BY key`` puts a whole key into one task.  These operators
cut each key into time slots first, so the slot is the unit of work:

* ``range_frame``  copies rows into the next slot, where a frame is two running parts;
* ``running_sum``  carries each slot's total forward as one extra row;
* ``lagged``       passes the last rows of earlier slots on.

All return exactly what the unsliced window would.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.scalar import as_col, event_micros, micros


def range_frame(df: DataFrame, keys: Sequence[str], ts: str, horizon: str,
                aggs: Mapping[str, Column | tuple[str, Column | str]], slot: str | None = None) -> DataFrame:
    """Aggregates over ``RANGE BETWEEN horizon PRECEDING AND CURRENT ROW``.

    Peers (equal ``ts``) are included.  An aggregate named as (kind, column),
    kind one of ``ROLLED``, costs the same whatever the density of the rows
    (``_rolled``).  A Column, which may be any aggregate, reads its whole frame
    again for each row: meant for windowed results, where a frame has few rows.
    ``slot`` is the width of the unit of work of those (64 horizons unless
    given); it must not be shorter than the horizon.
    """
    reach = micros(horizon)
    width = micros(slot) if slot else reach * 64
    if width < reach:
        raise ValueError("slot must be at least as long as the horizon")
    rolled = {name: agg for name, agg in aggs.items() if isinstance(agg, tuple)}
    if rolled:
        df = _rolled(df, keys, ts, reach, rolled)
    aggs = {name: agg for name, agg in aggs.items() if name not in rolled}
    if not aggs:
        return df
    us = F.col("_us")
    start = us - F.pmod(us, F.lit(width))
    needed_next = us >= start + F.lit(width - reach)
    sliced = (
        df.withColumn("_us", event_micros(ts))
        .withColumn("_home", start)
        .withColumn("_slot", F.explode(
            F.when(needed_next, F.array(start, start + F.lit(width))).otherwise(F.array(start))))
    )
    frame = Window.partitionBy(*keys, "_slot").orderBy("_us").rangeBetween(-reach, 0)
    return (
        sliced.withColumns({name: agg.over(frame) for name, agg in aggs.items()})
        .filter(F.col("_slot").eqNullSafe(F.col("_home")))
        .drop("_us", "_home", "_slot")
    )


#: Kinds of aggregates that two parts of a frame give, each with the states that it keeps of a part.
ROLLED = {"count": ("count",), "sum": ("sum",), "avg": ("count", "sum"), "min": ("min",), "max": ("max",),
          "stddev_samp": ("count", "avg", "var_pop")}


def _rolled(df: DataFrame, keys: Sequence[str], ts: str, reach: int, aggs: Mapping[str, tuple[str, Column | str]]) -> DataFrame:
    """``range_frame`` of aggregates that two parts of a frame give.

    Time is cut into slots as long as the frame, so a frame is the end of one
    slot and the start of the next.  Each row goes to its own slot and, without
    its other columns, to the next one; there one running aggregate goes
    forward over the slot's own rows and one backward over those of the slot
    before.  No row's frame is read again, so the work grows with the rows.
    """
    if unknown := {kind for kind, _ in aggs.values()} - set(ROLLED):
        raise ValueError(f"not a rolled aggregate: {', '.join(sorted(unknown))}")
    us, width = F.col("_us"), max(reach, 1)
    value = {name: as_col(column) for name, (_, column) in aggs.items()}
    # Averages of anything but decimals are taken over doubles, as Spark takes them.
    kinds = df.select(*[value[name].alias(name) for name in aggs]).schema
    exact = {name: isinstance(kinds[name].dataType, T.DecimalType) for name in aggs}
    value = {name: c.cast("double") if aggs[name][0] in ("avg", "stddev_samp") and not exact[name] else c for name, c in value.items()}
    wanted = df.select(*[getattr(F, kind)(column).alias(name) for name, (kind, column) in aggs.items()]).schema
    start = us - F.pmod(us, F.lit(width))
    own, past = F.struct(start.alias("_slot"), F.lit(False).alias("_past")), F.struct((start + F.lit(width)).alias("_slot"), F.lit(True).alias("_past"))
    others = [c for c in df.columns if c not in keys]
    rows = df.withColumns({f"_v_{name}": c for name, c in value.items()}).withColumn("_us", event_micros(ts)).select(
        "*", (us - start).alias("_at"), F.inline(F.when(us.isNull(), F.array(own)).otherwise(F.array(own, past))))
    mine = ~F.col("_past")
    rows = rows.withColumns({c: F.when(mine, F.col(f"`{c}`")) for c in others})
    by = Window.partitionBy(*keys, "_slot")
    parts = {"a": (mine, by.orderBy("_us")), "b": (F.col("_past"), by.orderBy(F.desc("_at")))}
    states = {
        f"_{part}_{state}_{name}": getattr(F, state)(F.when(side, F.col(f"_v_{name}"))).over(
            order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        for part, (side, order) in parts.items() for name, (kind, _) in aggs.items() for state in ROLLED[kind]}

    def merged(name: str, kind: str) -> Column:
        a, b = ({state: F.col(f"_{part}_{state}_{name}") for state in ROLLED[kind]} for part in parts)
        if kind in ("min", "max"):
            return (F.least if kind == "min" else F.greatest)(a[kind], b[kind])
        if kind == "count":
            return a["count"] + b["count"]
        if kind in ("sum", "avg"):
            total = F.coalesce(a["sum"] + b["sum"], a["sum"], b["sum"])
            return total if kind == "sum" else F.try_divide(total, a["count"] + b["count"])
        n, m = a["count"].cast("double"), b["count"].cast("double")
        square = F.coalesce(a["var_pop"] * n, F.lit(0.0)) + F.coalesce(b["var_pop"] * m, F.lit(0.0))
        apart = F.coalesce((a["avg"] - b["avg"]) * (a["avg"] - b["avg"]) * n * m / (n + m), F.lit(0.0))
        return F.when(n + m > 1, F.sqrt((square + apart) / (n + m - 1)))

    found = rows.withColumns(states).filter(mine)
    return found.select(*[F.col(f"`{c}`") for c in df.columns if c not in aggs],
                        *[merged(name, kind).cast(wanted[name].dataType).alias(name) for name, (kind, _) in aggs.items()])


def running_sum(df: DataFrame, keys: Sequence[str], ts: str, sums: Mapping[str, str],
                slot: str = "1 day") -> DataFrame:
    """Running totals in time order, peers included (the default SQL frame).

    ``sums`` maps a new column to the column it accumulates.
    """
    width = micros(slot)
    us = event_micros(ts)
    rows = df.withColumn("_us", us).withColumn("_slot", F.col("_us") - F.pmod(F.col("_us"), F.lit(width)))
    per_slot = rows.groupBy(*keys, "_slot").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slot.select(
        *keys, "_slot", F.lit(None).cast("bigint").alias("_us"), F.lit(True).alias("_carry"),
        *[F.sum(f"_t_{n}").over(before).alias(f"_v_{n}") for n in sums],
    )
    body = rows.withColumn("_carry", F.lit(False)).withColumns({f"_v_{n}": F.col(c) for n, c in sums.items()})
    # The carry row has a NULL time, which sorts first inside its slot.
    frame = (
        Window.partitionBy(*keys, "_slot").orderBy(F.col("_us").asc_nulls_first())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        body.unionByName(carry, allowMissingColumns=True)
        .withColumns({n: F.sum(f"_v_{n}").over(frame) for n in sums})
        .filter(~F.col("_carry"))
        .drop("_us", "_slot", "_carry", *[f"_v_{n}" for n in sums])
    )


def lagged(df: DataFrame, keys: Sequence[str], ts: str, lags: Mapping[str, tuple[str, int]], slot: str = "1 day",
           ties: Sequence[str] = ()) -> DataFrame:
    """LAG per key in the order of ``ts``, then ``ties``; ``lags`` maps a new column to (column, rows back).

    Each (key, slot) is worked on by itself, with the last rows of the key's
    earlier slots passed on to it, as many as the longest lag.  So a key's
    history may fill many tasks; slots without rows cost nothing.  NULL times
    come first, as in a plain window.
    """
    most = max(back for _, back in lags.values())
    carried = list(dict.fromkeys([*ties, *[old for old, _ in lags.values()]]))
    order = ["_us", *[f"_x.{c}" for c in ties]]
    rows = df.withColumn("_us", event_micros(ts)).withColumns({
        "_slot": F.floor(F.col("_us") / F.lit(micros(slot))), "_x": F.struct(*carried)})
    newest = Window.partitionBy(*keys, "_slot").orderBy(*[F.desc(c) for c in order])
    tail = F.sort_array(F.collect_list(F.struct((-F.col("_rn")).alias("n"), "_us", "_x")))
    tails = (rows.select(*keys, "_slot", "_us", "_x").withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= most)
             .groupBy(*keys, "_slot").agg(tail.alias("_tail")))
    # Every slot with rows has one at least, so the last rows lie in as many slots before.
    before = Window.partitionBy(*keys).orderBy(F.asc("_slot")).rowsBetween(-most, -1)
    past = F.flatten(F.collect_list("_tail").over(before))
    passed = tails.select(*keys, "_slot", past.alias("_past")).filter(F.size("_past") > 0).select(
        *keys, "_slot", F.explode(F.slice("_past", -F.least(F.lit(most), F.size("_past")), most)).alias("_p"))
    passed = passed.select(*keys, "_slot", F.col("_p._us").alias("_us"), F.col("_p._x").alias("_x"), F.lit(True).alias("_old"))
    whole = rows.withColumn("_old", F.lit(False)).unionByName(passed, allowMissingColumns=True)
    here = Window.partitionBy(*keys, "_slot").orderBy(*[F.asc(c) for c in order])
    found = whole.withColumns({new: F.lag(f"_x.{old}", back).over(here) for new, (old, back) in lags.items()})
    return found.filter(~F.col("_old")).drop("_us", "_slot", "_x", "_old")


def previous(df: DataFrame, keys: Sequence[str], order: str, columns: Mapping[str, str]) -> DataFrame:
    """LAG(1) per key.  Meant for windowed results, where a key has one row per window; ``lagged`` cuts long keys into slots."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({new: F.lag(old, 1).over(w) for new, old in columns.items()})
