"""Exact quantiles by selection: count, narrow, repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.keyed import key_join
from tidemill.session import stored


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, into: str, q: float = 0.5, limit: int = 20_000,
                   parts: int = 32) -> DataFrame:
    """PERCENTILE_CONT(q) per key, where no task ranks more than about ``limit`` values of a key.

    Every round cuts what is left of each key at ``parts`` - 1 borders of a
    sketch, counts the rows of each part exactly, and keeps the one part, or the
    part and the next ones, that hold the wanted ranks; rows below are only
    counted.  Rounds go on until every key is down to ``limit`` rows, repeats of
    a border left out, so their number grows with the logarithm of the largest
    key, whatever the spread of its values.  Rounds are written to the shared
    folder, a row per key.

    NULL values take no part, and a key with no other value is not in the
    result; a NULL key is a key.
    """
    if not 0 <= q <= 1:
        raise ValueError("q must lie in 0 to 1")
    if parts < 4 or limit < 1:
        raise ValueError("parts must be 4 or more and limit positive")
    v = F.col("_v")
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    at = F.lit(q) * (F.col("_total") - 1)
    # Values wanted: above _low, up to _high (NULL: no bound); _below counts those up to _low; _left those that may be ranked.
    kept = stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total")).select(
        *keys, "_total", F.floor(at).alias("_r0"), F.ceil(at).alias("_r1"), F.lit(None).cast("double").alias("_low"),
        F.lit(None).cast("double").alias("_high"), F.lit(0).cast("long").alias("_below"), F.col("_total").alias("_left")))

    def inside(bounds: DataFrame) -> DataFrame:
        return key_join(rows, bounds, keys).filter(
            (F.col("_low").isNull() | (v > F.col("_low"))) & (F.col("_high").isNull() | (v <= F.col("_high"))))

    most = kept.agg(F.max("_left")).first()[0] or 0
    while most > limit:
        cuts = [i / parts for i in range(1, parts)]
        borders = inside(kept.filter(F.col("_left") > limit)).groupBy(*keys).agg(
            F.percentile_approx("_v", cuts, parts * 100).alias("_cuts"))
        # Stored, a row per key, so that its size is known: few keys are broadcast, and their rows stay where they are.
        cut = stored(key_join(kept, borders, keys))
        part = F.size(F.filter("_cuts", lambda c: c < v))
        counts = inside(cut).groupBy(*keys, "_cuts", "_total", "_r0", "_r1", "_low", "_high", "_below", part.alias("_part")).agg(
            F.count(F.lit(1)).alias("_n"), F.count_if(~F.array_contains("_cuts", v)).alias("_inner"))
        # At most ``parts`` rows a key.
        upto = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        ranked = counts.withColumn("_from", F.col("_below") + F.coalesce(F.sum("_n").over(upto), F.lit(0)))
        wanted = ranked.filter((F.col("_from") <= F.col("_r1")) & (F.col("_from") + F.col("_n") > F.col("_r0")))
        border = lambda i: F.when((i >= 0) & (i < F.size("_cuts")), F.get("_cuts", i.cast("int")))
        narrowed = wanted.groupBy(*keys, "_cuts", "_total", "_r0", "_r1", "_low", "_high").agg(
            F.min("_part").alias("_a"), F.max("_part").alias("_b"), F.min("_from").alias("_below"), F.sum("_inner").alias("_left"))
        narrowed = narrowed.select(*keys, "_total", "_r0", "_r1", F.coalesce(border(F.col("_a") - 1), "_low").alias("_low"),
                                   F.coalesce(border(F.col("_b")), "_high").alias("_high"), "_below", "_left")
        kept = stored(kept.filter(F.col("_left") <= limit).unionByName(narrowed))
        most = kept.agg(F.max("_left")).first()[0] or 0
    counts = inside(kept).groupBy(*keys, "_total", "_r0", "_r1", "_below", "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("_from", F.col("_below") + F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    holds = lambda r: (F.col(r) >= F.col("_from")) & (F.col(r) < F.col("_from") + F.col("_n"))
    share = F.lit(q) * (F.max("_total") - 1) - F.max("_r0")
    low, high = F.max(F.when(holds("_r0"), v)), F.max(F.when(holds("_r1"), v))
    return ranked.groupBy(*keys).agg(F.when(share == 0, low).otherwise(low * (1 - share) + high * share).alias(into))
