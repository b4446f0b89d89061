"""Scalar helpers: each returns a Column built from JVM-side functions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros(interval: str) -> int:
    """Length of a fixed interval such as ``"3 seconds"`` in microseconds."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", interval.lower())
    if not match or match.group(2) not in _UNIT_MICROS:
        raise ValueError(f"not a fixed interval: {interval!r}")
    return int(match.group(1)) * _UNIT_MICROS[match.group(2)]


def span(interval: str) -> Column:
    """A day-time interval literal."""
    return F.expr(f"INTERVAL '{micros(interval) / 1_000_000:.6f}' SECOND")


def moment(as_of: Column | str | None = None) -> Column:
    """The "now" of a moving filter: the clock unless a time is given."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of


def event_micros(ts: ColumnLike) -> Column:
    """Event time as an exact long, so that frames and buckets use integers."""
    return F.unix_micros(as_col(ts).cast("timestamp"))


def seconds_between(earlier: ColumnLike, later: ColumnLike) -> Column:
    """Whole seconds between two times, rounded half up like a SQL bigint cast."""
    gap = event_micros(later) - event_micros(earlier)
    return F.round(gap.cast("decimal(30,0)") / F.lit(1_000_000), 0).cast("bigint")


def days_in_month(ts: ColumnLike) -> Column:
    return F.dayofmonth(F.last_day(as_col(ts)))


def slot(ts: ColumnLike, width: str) -> Column:
    """Start of the epoch-aligned slot that holds ``ts``, in microseconds."""
    us = event_micros(ts)
    return us - F.pmod(us, F.lit(micros(width)))


# -- numbers ---------------------------------------------------------------

def numeric(value: ColumnLike, scale: int = 10) -> Column:
    """Unbounded NUMERIC becomes the widest decimal with a fixed scale."""
    return as_col(value).cast(T.DecimalType(38, scale))


def round_numeric(value: ColumnLike, digits: int = 0, scale: int = 10) -> Column:
    """Round half up on a decimal; rounding a double differs between engines."""
    return F.round(numeric(value, scale), digits)


def ratio(part: ColumnLike, whole: ColumnLike) -> Column:
    """``part / whole`` as a double, NULL where ``whole`` is zero."""
    return F.try_divide(as_col(part).cast("double"), as_col(whole).cast("double"))


def int_div(part: ColumnLike, whole: ColumnLike) -> Column:
    """Integer division that truncates, NULL on a zero divisor."""
    return F.call_function("div", as_col(part), F.nullif(as_col(whole), F.lit(0)))


def clamp(value: ColumnLike, low=None, high=None) -> Column:
    out = as_col(value)
    out = F.greatest(out, F.lit(low)) if low is not None else out
    return F.least(out, F.lit(high)) if high is not None else out


def step_score(value: ColumnLike, steps: Sequence[tuple[object, int]], floor: int = 1,
               descending: bool = False) -> Column:
    """Score by thresholds: the first step reached wins, NULL falls to ``floor``.

    ``steps`` lists (bound, score) from best to worst.  With ``descending`` a
    smaller value is better (``value <= bound``), as for recency.
    """
    value = as_col(value)
    score = F.lit(floor)
    for bound, points in reversed(list(steps)):
        bound = bound if isinstance(bound, Column) else F.lit(bound)
        hit = (value <= bound) if descending else (value >= bound)
        score = F.when(hit, F.lit(points)).otherwise(score)
    return score


def tiered_charge(amount: ColumnLike, allowance: float, base_rate: float, over_rate: float) -> Column:
    """Two-tier tariff: ``base_rate`` up to the allowance, ``over_rate`` beyond it."""
    amount = as_col(amount)
    return F.when(amount <= allowance, amount * base_rate).otherwise(
        F.lit(allowance * base_rate) + (amount - allowance) * over_rate
    )


# -- rules -------------------------------------------------------------------

def first_match(rules: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """Searched CASE from a rule list; the first true rule wins."""
    out = F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise
    for condition, label in reversed(list(rules)):
        out = F.when(condition, label if isinstance(label, Column) else F.lit(label)).otherwise(out)
    return out


def any_match(rules: Sequence[tuple[Column, object]]) -> Column:
    """True where at least one rule of the list is true."""
    return reduce(lambda a, b: a | b, (condition for condition, _ in rules))


def is_true(condition: Column) -> Column:
    """Two-valued flag: NULL counts as false (unlike a bare comparison)."""
    return F.coalesce(condition, F.lit(False))


def code_label(code: ColumnLike, labels: Mapping[str, str], otherwise=None) -> Column:
    """Look a code up in a small fixed table."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), as_col(code))
    return found if otherwise is None else F.coalesce(found, F.lit(otherwise))


# -- text ----------------------------------------------------------------------

def concat_text(*parts: ColumnLike) -> Column:
    """CONCAT that skips NULL arguments instead of returning NULL."""
    return F.concat_ws("", *[as_col(p).cast("string") for p in parts])


def stable_id(*parts: ColumnLike) -> Column:
    """Deterministic id: MD5 of the concatenated parts."""
    return F.md5(concat_text(*parts))


def time_text(ts: ColumnLike, pattern: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> Column:
    """Time as text in one fixed format, so that ids do not depend on the engine."""
    return F.date_format(as_col(ts), pattern)


def contains_any(columns: Sequence[ColumnLike], keyword: str) -> Column:
    """Case-insensitive substring search over several columns."""
    wanted = F.lit(keyword.strip().lower())
    hits = [F.contains(F.lower(as_col(c).cast("string")), wanted) for c in columns]
    return reduce(lambda a, b: a | b, (is_true(h) for h in hits))


# -- geography -------------------------------------------------------------------

EARTH_RADIUS_KM = 6371  # fixed value: mean earth radius used for distances
GRID_DEGREES = 0.002    # fixed value: side of a map cell in degrees


def grid_id(lat: ColumnLike, lon: ColumnLike, cell: float = GRID_DEGREES) -> Column:
    cells = [F.floor(as_col(c) / F.lit(cell)).cast("bigint").cast("string") for c in (lat, lon)]
    return F.concat(cells[0], F.lit("_"), cells[1])


def haversine_km(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike) -> Column:
    lat1, lon1, lat2, lon2 = (as_col(c) for c in (lat1, lon1, lat2, lon2))
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))
