"""Operators against brute force on small frames with ties, borders, NULLs and a hot key."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.functions import scalar as s
from tidemill.operators import (
    asof_join, band_join, diff_results, exact_median, fold_changelog, hop, key_join, lagged, latest_by, net_of_sums, range_frame,
    running_sum, top_n, tumble, update_where, upsert, windows_holding,
)

T0 = datetime(2024, 1, 1)


def when(seconds):
    return None if seconds is None else T0 + timedelta(seconds=seconds)


def stream(seed, n=160, span=400):
    """Rows (id, key, ts, value): a third on one key, tied and NULL times, NULL values."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if r.random() < 0.34 else r.choice(["a", "b", "c", None])
        sec = None if r.random() < 0.03 else r.randrange(0, span) if r.random() < 0.8 else r.choice([0, 10, 20, 60, 120, 64, 128])
        out.append((i, key, sec, None if r.random() < 0.1 else r.randrange(100)))
    return out


def frame(spark, rows, names="id key ts value"):
    i, k, t, v = names.split()
    return spark.createDataFrame([(a, b, when(c), d) for a, b, c, d in rows], f"{i} bigint, {k} string, {t} timestamp_ntz, {v} bigint")


def collect(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed, horizon, slot", [(1, 10, "10 seconds"), (2, 10, None), (3, 60, "64 seconds"), (4, 0, "5 seconds")])
def test_range_frame(spark, seed, horizon, slot):
    rows = stream(seed)
    got = collect(range_frame(frame(spark, rows), ["key"], "ts", f"{horizon} seconds" if horizon else "1 microsecond",
                              {"n": F.count(F.lit(1)), "total": F.sum("value"), "top": F.max("value")}, slot).select("id", "n", "total", "top"))
    want = []
    for i, k, t, _ in rows:
        near = [x for x in rows if x[1] == k and ((t is None and x[2] is None) or (t is not None and x[2] is not None and t - horizon <= x[2] <= t))]
        vals = [x[3] for x in near if x[3] is not None]
        want.append((i, len(near), sum(vals) if vals else None, max(vals) if vals else None))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("seed, horizon", [(1, 10), (2, 60), (3, 64), (4, 0)])
def test_range_frame_of_named_aggregates(spark, seed, horizon):
    """Running parts give what the frame itself gives, null keys, times and values and peers included."""
    rows = [(i, k, t, None if v is None else v * 1.5) for i, k, t, v in stream(seed)]
    i, k, t, v = zip(*rows)
    df = spark.createDataFrame(list(zip(i, k, [when(x) for x in t], v)), "id bigint, key string, ts timestamp_ntz, value double")
    df = df.withColumn("price", F.col("value").cast("decimal(10,2)"))
    span = f"{horizon} seconds" if horizon else "1 microsecond"
    named = {"n": ("count", F.lit(1)), "top": ("max", "value"), "low": ("min", "price"), "total": ("sum", "price"), "mean": ("avg", "id"),
             "price_mean": ("avg", "price"), "sd": ("stddev_samp", "value")}
    direct = {n: getattr(F, kind)(c) for n, (kind, c) in named.items()}
    got, want = (range_frame(df, ["key"], "ts", span, a) for a in (named, direct))
    assert got.schema == want.schema
    same = [F.round("sd", 9).alias("sd"), F.round("mean", 9).alias("mean")]
    got, want = (collect(x.select("id", "key", "ts", "value", "price", "n", "top", "low", "total", "price_mean", *same)) for x in (got, want))
    assert got == want


def test_rolling_prices_do_not_read_frames_again(spark):
    """A dense asset costs no sliding frame: every window of the plans begins at the first row of its part."""
    from tidemill.plans import markets

    quotes = spark.createDataFrame([], "asset_id int, timestamp timestamp_ntz, price double, bid_price double, ask_price double, rolling_volume long, "
                                       "trade_id long, volume long")
    for plan in (markets.price_spike, markets.quiet_tight_spread, markets.unusual_volume, markets.price_and_spread, markets.volatility):
        text = plan(quotes)._jdf.queryExecution().optimizedPlan().toString()
        assert "specifiedwindowframe" in text and "RangeFrame, -" not in text


def test_range_frame_rejects_short_slot(spark):
    with pytest.raises(ValueError):
        range_frame(frame(spark, stream(1)), ["key"], "ts", "10 seconds", {"n": F.count("*")}, "5 seconds")


@pytest.mark.parametrize("seed, slot", [(5, "7 seconds"), (6, "1 day"), (7, "64 seconds")])
def test_running_sum(spark, seed, slot):
    rows = [x for x in stream(seed) if x[2] is not None]
    got = collect(running_sum(frame(spark, rows), ["key"], "ts", {"total": "value"}, slot).select("id", "total"))
    want = []
    for i, k, t, _ in rows:
        vals = [x[3] for x in rows if x[1] == k and x[2] <= t and x[3] is not None]
        want.append((i, sum(vals) if vals else None))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("seed, slot, how", [(8, "10 seconds", "left"), (9, "1 day", "left"), (10, "64 seconds", "inner"), (11, "3 seconds", "inner")])
def test_asof_join(spark, seed, slot, how):
    left, right = stream(seed), stream(seed + 100, 90)
    got = collect(asof_join(frame(spark, left), frame(spark, right, "rid key rts rvalue"), ["key"], "ts", "rts",
                            ["rid", "rvalue"], how, tie=["rid"], slot=slot).select("id", "rid", "rvalue"))
    want = []
    for i, k, t, _ in left:
        hits = [x for x in right if k is not None and x[1] == k and t is not None and x[2] is not None and x[2] <= t]
        best = max(hits, key=lambda x: (x[2], x[0])) if hits else None
        if best or how == "left":
            want.append((i, best[0] if best else None, best[3] if best else None))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("seed, before, after, how, slot", [
    (12, 3, 3, "inner", None), (13, 5, 0, "left", None), (14, 0, 4, "left", "30 seconds"), (15, 0, 0, "inner", None), (16, 60, 60, "left", "7 seconds")])
def test_band_join(spark, seed, before, after, how, slot):
    left, right = stream(seed), stream(seed + 100, 90)
    got = collect(band_join(frame(spark, left), frame(spark, right, "rid rkey rts rvalue"), {"key": "rkey"}, "ts", "rts",
                            f"{before} seconds", f"{after} seconds", how, slot).select("id", "rid"))
    want = []
    for i, k, t, _ in left:
        hits = [x[0] for x in right if k is not None and x[1] == k and t is not None and x[2] is not None and t - before <= x[2] <= t + after]
        want += [(i, h) for h in hits] or ([(i, None)] if how == "left" else [])
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("seed, band", [(17, 0.02), (18, 0.2), (19, 0.001)])
def test_exact_median(spark, seed, band):
    rows = stream(seed)
    got = {r.key: r.m for r in exact_median(frame(spark, rows), ["key"], "value", "m", band).collect()}
    want = {}
    for k in {x[1] for x in rows}:
        vals = [x[3] for x in rows if x[1] == k and x[3] is not None]
        if vals:
            want[k] = float(statistics.median(vals))
    assert got == want


def test_exact_median_of_a_narrow_and_a_wide_key(spark):
    """Most values lie within one unit, some far off: borders follow each key's own values."""
    rng = random.Random(5)
    rows = [("near", rng.random()) for _ in range(3001)] + [("far", 10.0 ** rng.randrange(-9, 9) * rng.random()) for _ in range(2000)]
    rows += [("same", 3.0)] * 1000 + [("same", 4.0)] * 1000 + [("one", 7.0), ("two", 1.0), ("two", 2.0)]
    got = {r.key: r.m for r in exact_median(spark.createDataFrame(rows, "key string, value double"), ["key"], "value", "m").collect()}
    assert got == {k: statistics.median([v for key, v in rows if key == k]) for k in {r[0] for r in rows}}


def test_windows_holding_borders(spark):
    df = spark.createDataFrame([(1, when(60)), (2, when(61)), (3, when(0)), (4, None)], "id int, ts timestamp_ntz")
    got = sorted((r.id, int((r.window_start - T0).total_seconds())) for r in windows_holding(df, "ts", "60 seconds").collect())
    assert got == [(1, 0), (1, 60), (2, 60), (3, -60), (3, 0)]


def test_tumble_and_hop(spark):
    df = spark.createDataFrame([(1, when(0)), (2, when(59)), (3, when(60)), (4, None)], "id int, ts timestamp_ntz")
    starts = lambda d: sorted((r.id, int((r.window_start - T0).total_seconds()), int((r.window_end - T0).total_seconds())) for r in d.collect())
    assert starts(tumble(df, "ts", "60 seconds")) == [(1, 0, 60), (2, 0, 60), (3, 60, 120)]
    assert starts(hop(df, "ts", "30 seconds", "60 seconds")) == [(1, -30, 30), (1, 0, 60), (2, 0, 60), (2, 30, 90), (3, 30, 90), (3, 60, 120)]


@pytest.mark.parametrize("seed", [20, 21])
def test_net_of_sums(spark, seed):
    left, right = stream(seed, 60), stream(seed + 1, 50)
    got = {r.key: r.net for r in net_of_sums(frame(spark, left), frame(spark, right, "rid key rts rvalue"), "key", {"net": ("value", "rvalue")}).collect()}
    want = {}
    for k in {x[1] for x in left if x[1]} & {x[1] for x in right if x[1]}:
        pairs = [(a[3], b[3]) for a in left if a[1] == k for b in right if b[1] == k]
        want[k] = sum(a or 0 for a, _ in pairs) - sum(b or 0 for _, b in pairs)
    assert got == want


def test_latest_and_top_n(spark):
    rows = stream(22)
    df = frame(spark, rows)
    got = {r.key: r.id for r in latest_by(df, ["key"], ["ts", "id"]).collect()}
    assert got == {k: max((x for x in rows if x[1] == k), key=lambda x: (-1 if x[2] is None else x[2], x[0]))[0] for k in {x[1] for x in rows}}
    best = collect(top_n(df.filter("value IS NOT NULL"), ["key"], [F.desc("value"), F.asc("id")], 3).select("key", "rank", "id"))
    want = []
    for k in {x[1] for x in rows}:
        ordered = sorted((x for x in rows if x[1] == k and x[3] is not None), key=lambda x: (-x[3], x[0]))
        want += [(k, n, x[0]) for n, x in enumerate(ordered[:3], 1)]
    assert best == sorted(want, key=repr)


def test_key_join_matches_null_keys(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    got = collect(key_join(df, df.groupBy("k").agg(F.sum("v").alias("s")), ["k"]))
    assert got == sorted([(None, 1, 1), ("a", 2, 2)], key=repr)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_fold_does_not_depend_on_arrival(spark, seed):
    feed = [("c", i, i % 7, i) for i in range(40)] + [("d", 100 + k, k, None) for k in (2, 5)] + [("c", 200, 5, 99)]
    random.Random(seed).shuffle(feed)
    got = collect(fold_changelog(spark.createDataFrame(feed, "op string, seq bigint, k bigint, v bigint"), ["k"], ["seq"]))
    assert got == sorted([(0, 35), (1, 36), (3, 38), (4, 39), (6, 34), (5, 99)], key=repr)


def test_upsert_update_and_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    new = upsert(old, spark.createDataFrame([(2, "x"), (4, "d")], "k int, v string"), ["k"])
    assert collect(new) == [(1, "a"), (2, "x"), (3, "c"), (4, "d")]
    assert collect(update_where(old, spark.createDataFrame([(1, None), (9, "z")], "k int, v string"), ["k"], ["v"])) == sorted([(1, None), (2, None), (3, "c")], key=repr)
    changes = diff_results(old, new.filter("k <> 1"), ["k"])
    assert collect(changes) == sorted([(1, "a", "Delete"), (2, "x", "UpdateInsert"), (4, "d", "Insert")], key=repr)
    assert diff_results(old, old, ["k"]).count() == 0


def test_empty_inputs(spark):
    df = frame(spark, [])
    right = frame(spark, [], "rid key rts rvalue")
    assert range_frame(df, ["key"], "ts", "3 seconds", {"n": F.count("*")}).count() == 0
    assert asof_join(df, right, ["key"], "ts", "rts", ["rid"]).count() == 0
    assert band_join(df, right.withColumnRenamed("key", "rkey"), {"key": "rkey"}, "ts", "rts", "1 second").count() == 0
    assert exact_median(df, ["key"], "value", "m").count() == 0


def test_scalars(spark):
    df = spark.range(1)
    one = lambda c: df.select(c.alias("v")).first()[0]
    assert one(s.ratio(F.lit(1), F.lit(0))) is None
    assert one(s.int_div(F.lit(7), F.lit(2))) == 3 and one(s.int_div(F.lit(7), F.lit(0))) is None
    assert one(s.concat_text(F.lit("a"), F.lit(None), F.lit(3))) == "a3"
    assert one(s.grid_id(F.lit(-0.001), F.lit(0.0041))) == "-1_2"
    assert abs(one(s.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) - 111.1949) < 1e-3
    assert one(s.step_score(F.lit(None).cast("int"), [(5, 5), (2, 2)])) == 1
    assert one(s.tiered_charge(F.lit(250.0), 200, 0.2, 0.4)) == pytest.approx(60.0)
    assert one(s.days_in_month(F.lit(datetime(2024, 2, 3)))) == 29
    assert s.micros("3 seconds") == 3_000_000 and s.micros("1 day") == 86_400_000_000
    with pytest.raises(ValueError):
        s.micros("2 months")


def test_cosine_of_zero_vector_is_null(spark):
    from tidemill.functions.vectors import cosine_similarity, cosine_to
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([2.0, 4.0], [1.0, 2.0]), (None, [1.0, 2.0])], "a array<float>, b array<float>")
    assert [r[0] if r[0] is None else round(r[0], 9) for r in df.select(cosine_similarity("a", "b")).collect()] == [None, 1.0, None]
    assert [r[0] if r[0] is None else round(r[0], 9) for r in df.select(cosine_to([1.0, 2.0])("a")).collect()] == [None, 1.0, None]


def test_embedding_retries_then_null(spark):
    from tidemill.functions.vectors import text_embedding

    def flaky(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("service is down")
        return [[float(len(t))] for t in texts]

    df = spark.createDataFrame([("ok",), ("bad",), (None,)], "t string")
    assert [r[0] for r in df.select(text_embedding("t", flaky)).collect()] == [[2.0], None, None]


def test_one_bad_text_does_not_fail_its_batch():
    from tidemill.functions.vectors import embed_batch
    calls = []

    def flaky(texts):
        calls.append(list(texts))
        if "bad" in texts:
            raise OSError("service is down")
        return [[float(len(t))] for t in texts]

    assert embed_batch(flaky, ["a", "bb", "bad", "dddd"], 2, (OSError,)) == [[1.0], [2.0], None, [4.0]]
    assert calls == [["a", "bb", "bad", "dddd"], ["a", "bb"], ["bad", "dddd"], ["bad"], ["bad"], ["dddd"]]
    with pytest.raises(OSError):
        embed_batch(flaky, ["bad"], 2, (ValueError,))


def test_lexicon_in_expressions_equals_the_scorer(spark):
    from tidemill.functions.text import lexicon_scorer, sentiment
    from tidemill.functions.vectors import hashing_embedder, text_embedding
    lexicon = {"up": 2.0, "down": -1.5, "été": 1.0}
    df = spark.createDataFrame([("Up up, DOWN_up",), ("",), (None,), ("Été 42",), ("nothing",)], "t string")
    a, b = ([round(r[0], 12) for r in df.select(sentiment("t", s)).collect()] for s in (lexicon, lexicon_scorer(lexicon)))
    assert a == b
    x, y = ([r[0] for r in df.select(text_embedding("t", e)).collect()] for e in (None, hashing_embedder()))
    assert x == y


def test_distinct_per_kind(spark):
    from tidemill.operators import distinct_per_kind
    rows = [("a", "x", 1, 5), ("a", "x", 1, 7), ("a", "y", 1, 2), ("a", "x", 2, None), ("a", "x", None, 1), (None, "y", 3, 4), ("b", None, 3, 4)]
    got = distinct_per_kind(spark.createDataFrame(rows, "k string, kind string, id int, v int"), ["k"], "kind", "id", {"xs": "x", "ys": "y"}, {"total": ("x", "v")})
    assert collect(got) == sorted([("a", 2, 1, 13), (None, 0, 1, 0), ("b", 0, 0, 0)], key=repr)


def test_repeated_updates_need_an_order(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x", 5), (1, "y", 9)], "k int, v string, at int")
    assert collect(update_where(old, twice, ["k"], ["v"], ["at"])) == [(1, "y"), (2, "b")]
    for wrong in (update_where(old, twice, ["k"], ["v"]), upsert(old, twice.drop("at"), ["k"])):
        with pytest.raises(Exception, match="repeated key"):
            wrong.collect()


def test_delayed_first_takes_the_limit_as_given(spark):
    from tidemill.plans.logistics import delayed_first

    orders = spark.range(1500).selectExpr("id AS order_id", "'delayed' AS status", "id AS delay_interval")
    assert delayed_first(orders, 1200).count() == 1200
    with pytest.raises(ValueError):
        delayed_first(orders, 0)


def test_interval_join_keeps_unmatched_left_rows(spark):
    from tidemill.streaming.joins import interval_join

    a = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-01 12:00:00")], "x int, ts string")
    b = spark.createDataFrame([(1, "2024-01-01 10:02:00"), (2, "2024-01-01 13:00:00")], "y int, at string")
    got = interval_join(a, b, [F.col("x") == F.col("y")], "ts", "at", "5 MINUTES", "5 MINUTES", "left").select("x", "y")
    assert collect(got) == [(1, 1), (2, None)]


def test_dashboard_without_pairs_equals_the_joined_one(spark):
    """Dense ticks, null prices and assets, repeated times, an asset without context."""
    from tidemill.plans import markets
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    at = lambda: start + timedelta(seconds=rng.randrange(12))
    ticks = spark.createDataFrame(
        [(rng.choice([1, 2, 3, None]), at(), rng.choice([10.0, 12.5, 0.0, None]), 9.0, rng.choice([10.0, 11.0])) for _ in range(120)],
        "asset_id int, timestamp timestamp_ntz, price double, bid_price double, ask_price double")
    context = spark.createDataFrame([(rng.choice([1, 2, None]), at(), rng.choice([1.0, None]), float(rng.randrange(5))) for _ in range(40)],
                                    "asset_id int, timestamp timestamp_ntz, sector_performance double, sentiment_score double")
    metrics = list(markets.DASHBOARD_METRICS)
    for grain, by in (("2 seconds", ("asset_id",)), (None, ("asset_id",)), ("5 seconds", ())):
        want = markets.dashboard_rollup(markets.enriched_ticks(ticks, context), metrics, grain, by)
        got = markets.dashboard_from_ticks(ticks, context, metrics, grain, by).select(want.columns)
        at_key = lambda df: {tuple(r[k] for k in want.columns if k not in metrics): r for r in df.collect()}
        a, b = at_key(got), at_key(want)
        assert a.keys() == b.keys() and b
        for k, row in b.items():
            for name in metrics:  # the two add in another order, so the last digits may differ
                assert a[k][name] == row[name] or a[k][name] == pytest.approx(row[name], rel=1e-9, abs=1e-9), (k, name)
    plan = markets.dashboard_from_ticks(ticks, context, metrics)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan, plan


@pytest.mark.parametrize("slot, back", [("1 second", 1), ("10 seconds", 3), ("1 day", 2)])
def test_lag_in_slots_is_the_plain_lag(spark, slot, back):
    rng = random.Random(back)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([None, *range(0, 60)]), rng.choice([None, 1.5, 2.5])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k string, s int, v double").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    plain = Window.partitionBy("k").orderBy("ts", "id")
    want = df.withColumns({"x": F.lag("v", back).over(plain), "y": F.lag("id", 1).over(plain)})
    got = lagged(df, ["k"], "ts", {"x": ("v", back), "y": ("id", 1)}, slot, ["id"]).select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_one_key_over_a_year_fills_many_tasks(spark):
    hours = spark.range(24 * 365).select(F.lit("r").alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("ts"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = lagged(hours, ["k"], "ts", {"p": ("id", 5)}, "7 days").withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in found.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 3 and max(sizes) < 24 * 365 * 0.6
    assert found.where("p <> id - 5 or (p is null and id >= 5)").count() == 0


def test_exact_quantile_leaves_the_rows_of_few_keys_in_place(spark, monkeypatch):
    """No round gathers the rows of a key in one task: its bounds come to the rows."""
    from tidemill.operators import quantiles

    plans, keep = [], quantiles.stored

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)

    monkeypatch.setattr(quantiles, "stored", seen)
    rows = [("a" if i % 3 else "b", float(i * 7919 % 5003)) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, value double")
    got = quantiles.exact_quantile(df, ["key"], "value", "q", 0.9, limit=50)
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 3 and not any("SortMergeJoin" in p for p in plans[2:])
    want = df.groupBy("key").agg(F.percentile("value", 0.9).alias("q"))
    assert [(k, round(q, 9)) for k, q in collect(got)] == [(k, round(q, 9)) for k, q in collect(want)]


def test_larger_shuffles_end_in_more_parts(spark):
    from tidemill.session import RUNTIME_CONF, SPREAD_CONF, tune

    before = {k: spark.conf.get(k, None) for k in SPREAD_CONF}
    tune(spark, RUNTIME_CONF | SPREAD_CONF)
    try:
        def parts(n):
            keys = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"))
            return keys.groupBy("k").count().select(F.spark_partition_id().alias("p")).distinct().count()

        assert parts(2_000_000) > 8 >= parts(1_000)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
