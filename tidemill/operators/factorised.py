"""Many-to-many joins on one key: rows without a partner are left out early, sums never build the pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def maybe_in(df: DataFrame, other: DataFrame, keys: Sequence[str], cells: int = 1 << 24) -> DataFrame:
    """Rows of ``df`` whose keys may occur in ``other``, before any shuffle of ``df``.

    The keys of ``other`` mark cells of a table of ``cells`` bits, kept as
    words of 64.  The words are broadcast: at most ``cells`` / 64 rows of two
    longs, whatever the input.  No row with a partner is lost; a row without
    one passes where another key marked its cell, so a join must follow.  Rows
    with a null in their keys have no partner.
    """
    if cells < 64 or cells % 64:
        raise ValueError("cells must be a multiple of 64")
    if any(df.schema[k].dataType != other.schema[k].dataType for k in keys):
        raise ValueError(f"{list(keys)} differ in type; equal numbers of two types have two hashes")
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    cell = F.pmod(F.xxhash64(*keys), F.lit(cells))
    word = F.shiftright(cell, 6)
    marks = (other.filter(known).select(word.alias("_word"), cell.cast("int").alias("_at"))
             .groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _at & 63)")).alias("_bits")))
    return (df.filter(known).withColumns({"_word": word, "_at": cell.cast("int")}).join(F.broadcast(marks), "_word")
            .filter(F.expr("shiftrightunsigned(_bits, _at & 63) & 1L = 1L")).drop("_word", "_at", "_bits"))


class Factorised:
    """The inner join of ``parts`` on ``keys``, kept as its parts.

    A key's rows in the join are all combinations of its rows in each part.  So
    the number of rows is the product of the parts' counts, and the sum of one
    part's column is that part's sum times the counts of the others.  Each part
    is reduced by key before it is shuffled, so a hot key costs one row a task.
    Rows with a null key are in no join.  Parts share no columns but the keys.
    """

    def __init__(self, keys: Sequence[str], parts: Mapping[str, DataFrame]):
        if len(parts) < 2:
            raise ValueError("a join has two parts or more")
        self.keys, self.parts = list(keys), dict(parts)

    def reduced(self, by: Sequence[str], cells: int = 1 << 24) -> Factorised:
        """The same join, where the parts not named in ``by`` lose rows whose key those named do not hold."""
        parts = dict(self.parts)
        for name in parts:
            if name not in by:
                for selective in by:
                    parts[name] = maybe_in(parts[name], self.parts[selective], self.keys, cells)
        return Factorised(self.keys, parts)

    def rows(self) -> DataFrame:
        """The join written out."""
        return reduce(lambda a, b: a.join(b, self.keys), self.parts.values())

    def totals(self, part: str, per: Sequence[str], sums: Mapping[str, tuple[str, str]] | None = None, count: str = "n_rows") -> DataFrame:
        """Rows of the join and sums over them, per columns ``per`` of one part (or keys).

        ``sums`` maps a result column to (part, column).  Counts, and sums of
        whole numbers, are decimals, which pairs do not overflow.
        """
        sums = dict(sums or {})
        counts = {}
        for name, df in self.parts.items():
            own = [c for c in per if c not in self.keys] if name == part else []
            counts[name] = df.groupBy(*self.keys, *own).agg(
                F.count(F.lit(1)).cast("decimal(38,0)").alias(f"_n_{name}"),
                *[F.sum(c).alias(f"_s_{into}") for into, (p, c) in sums.items() if p == name])
        joined = Factorised(self.keys, counts).rows()
        times = lambda names: reduce(Column.__mul__, [F.col(f"_n_{n}") for n in names])
        return joined.groupBy(*per).agg(
            F.sum(times(self.parts)).alias(count),
            *[F.sum(F.col(f"_s_{into}") * times([n for n in self.parts if n != p])).alias(into) for into, (p, _) in sums.items()])
