"""Joins kept as parts, key sets as bits, and quantiles by selection, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import Factorised, exact_quantile, maybe_in


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def logs(spark, seed):
    """Three logs by key; a third of the rows on one key, null keys, keys that one log lacks, null values."""
    r = random.Random(seed)
    key = lambda: 1 if r.random() < 0.34 else None if r.random() < 0.05 else r.randrange(2, 12)
    frames = {}
    for name, n in (("a", 40), ("b", 30), ("c", 20)):
        data = [(key(), f"{name}{i % 4}", None if r.random() < 0.1 else r.randrange(100)) for i in range(n)]
        frames[name] = spark.createDataFrame(data, f"k bigint, tag_{name} string, v_{name} bigint")
    return frames


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("per", [["k"], ["tag_a"], ["k", "tag_a"], []])
def test_totals_are_those_of_the_join(spark, seed, per):
    join = Factorised(["k"], logs(spark, seed))
    sums = {"sa": ("a", "v_a"), "sb": ("b", "v_b"), "sc": ("c", "v_c")}
    want = join.rows().groupBy(*per).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("v_a").alias("sa"), F.sum("v_b").alias("sb"), F.sum("v_c").alias("sc"))
    as_int = lambda df: df.select(*per, *[F.col(c).cast("bigint") for c in ("n_rows", "sa", "sb", "sc")])
    assert rows_of(as_int(join.totals("a", per, sums))) == rows_of(as_int(want))
    assert rows_of(as_int(join.reduced(["b"], cells=64).totals("a", per, sums))) == rows_of(as_int(want))


def test_totals_of_a_hot_key_pass_the_pairs(spark):
    """1.6e21 pairs, more than a long holds, from one row of counts a part."""
    part = lambda name: spark.range(200_000).select(F.lit(7).cast("long").alias("k"), F.lit(1).alias(f"v_{name}"))
    join = Factorised(["k"], {name: part(name) for name in "abcd"})
    found = join.totals("a", ["k"], {"s": ("b", "v_b")}).first()
    assert (int(found["n_rows"]), int(found["s"])) == (200_000 ** 4, 200_000 ** 4)


def test_parts_without_rows(spark):
    frames = logs(spark, 3)
    frames["b"] = frames["b"].limit(0)
    join = Factorised(["k"], frames).reduced(["b"])
    assert join.rows().count() == 0
    assert join.totals("a", ["k"]).count() == 0
    with pytest.raises(ValueError):
        Factorised(["k"], {"a": frames["a"]})


def test_bits_lose_no_partner_and_few_others_pass(spark):
    """Two thirds of the log's rows lie on one key without a partner: they are gone before the shuffle."""
    log = spark.range(90_000).select(F.when(F.col("id") % 3 > 0, -5).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    some = spark.range(0, 90_000, 300).select(F.col("id").alias("k"))
    kept = maybe_in(log, some, ["k"])
    assert kept.columns == ["k", "v"]
    found = {r["v"] for r in kept.collect()}
    assert found >= set(range(0, 90_000, 300))
    assert len(found) <= 310
    assert "cartesian" not in kept._jdf.queryExecution().toString().lower()
    narrow = {r["v"] for r in maybe_in(log, some, ["k"], cells=64).collect()}
    assert narrow >= set(range(0, 90_000, 300))


def test_bits_with_nulls_and_types(spark):
    left = spark.createDataFrame([(1, "x", 1), (None, "x", 2), (2, None, 3), (2, "y", 4)], "k bigint, t string, v int")
    assert rows_of(maybe_in(left, left, ["k", "t"]).select("v")) == [(1,), (4,)]
    assert maybe_in(left, left.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError):
        maybe_in(left, spark.createDataFrame([(1,)], "k int"), ["k"])
    with pytest.raises(ValueError):
        maybe_in(left, left, ["k"], cells=100)


SPREADS = {
    "even": lambda r: r.random(), "ties": lambda r: float(r.randrange(4)), "one": lambda r: 2.5,
    "wide": lambda r: r.choice([-1, 1]) * 10 ** r.uniform(-200, 200), "edge": lambda r: 0.0 if r.random() < 0.5 else r.random(),
}


@pytest.mark.parametrize("q, limit", [(0.5, 1), (0.9, 7), (0.0, 5), (1.0, 5), (0.37, 10_000)])
def test_quantile(spark, q, limit):
    r = random.Random(q)
    sizes = {"hot": 400, "b": 31, "two": 2, "lone": 1, None: 12}
    data = [(s, k, SPREADS[s](r)) for s in SPREADS for k, n in sizes.items() for _ in range(n)] + [("even", "b", None), ("even", "nothing", None)]
    r.shuffle(data)
    df = spark.createDataFrame(data, "s string, k string, v double")
    got = {(x["s"], x["k"]): x["p"] for x in exact_quantile(df, ["s", "k"], "v", "p", q, limit, parts=4).collect()}
    assert set(got) == {(s, k) for s in SPREADS for k in sizes}
    for (s, k), found in got.items():
        values = sorted(v for spread, key, v in data if (spread, key) == (s, k) and v is not None)
        at = q * (len(values) - 1)
        low, high, share = values[int(np.floor(at))], values[int(np.ceil(at))], at - np.floor(at)
        assert found == pytest.approx(low * (1 - share) + high * share, rel=1e-9, abs=1e-300)


def test_quantile_of_one_large_key(spark):
    """Half a million distinct values on one key, ranked in pieces of a thousand or less."""
    df = spark.range(500_000).select(F.lit("hot").alias("k"), ((F.col("id") * 7919) % 500_009).alias("v"))
    values = np.sort((np.arange(500_000) * 7919) % 500_009)
    got = exact_quantile(df, ["k"], "v", "p", 0.5, limit=1_000).collect()
    assert [(r["k"], r["p"]) for r in got] == [("hot", (values[249_999] + values[250_000]) / 2)]


def test_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([], "k string, v double"), ["k"], "v", "p").collect() == []
    with pytest.raises(ValueError):
        exact_quantile(spark.createDataFrame([], "k string, v double"), ["k"], "v", "p", 1.5)


def test_order_revenue_stores_only_what_it_reads(spark, monkeypatch):
    """The table of final prices is written and read twice, so it holds the key, the time and the price alone."""
    from tidemill.checks import load_all, pricing

    kept, keep = [], pricing.stored
    monkeypatch.setattr(pricing, "stored", lambda df: (kept.append(df.columns), keep(df))[1])
    at = "CAST(d AS TIMESTAMP_NTZ)"
    rows = lambda values, columns, *more: spark.sql(f"SELECT {', '.join(more)} FROM VALUES {values} t({columns})")
    inventory = rows("(1, 'one', 60, 10L, 100), (2, 'two', 30, 10L, 50)", "product_id, product_name, stock_level, reorder_threshold, p",
                     "CAST(product_id AS BIGINT) AS product_id", "product_name", "stock_level", "reorder_threshold", "CAST(p AS DECIMAL(10,2)) AS base_price")
    bought = rows("(1L, '2024-01-01', 5L), (2L, '2024-01-02', 5L)", "product_id, d, quantity_purchased", "product_id", f"{at} AS purchase_time", "quantity_purchased")
    restocked = rows("(1L, '2024-01-03', 2L)", "product_id, d, quantity_restocked", "product_id", f"{at} AS restock_time", "quantity_restocked")
    clicks = rows("(1L, '2024-01-01')", "product_id, d", "product_id", f"{at} AS event_time")
    offers = rows("(1L, 'k', 90, '2024-01-01')", "product_id, competitor, p, d", "product_id", "competitor", "CAST(p AS DECIMAL(12,2)) AS competitor_price", f"{at} AS ts")
    orders = rows("(1L, 1L, '2024-01-02', 2L), (2L, 2L, '2024-01-01', 3L), (3L, 3L, '2024-01-05', 4L)", "order_id, product_id, d, quantity",
                  "order_id", "product_id", f"{at} AS order_time", "quantity")
    found = load_all()["q62_order_revenue"].build(inventory, bought, restocked, clicks, offers, orders)
    got = {r["product_id"]: (r["product_name"], r["total_orders"], r["revenue_estimate"]) for r in found.collect()}
    assert kept == [["product_id", "inventory_window", "final_price"]]
    # Product 1 has 55 left, so 90 a piece, no more than the rival's; 2 is ordered before it has a price; 3 is unknown.
    assert got == {1: ("one", 2, 180), 2: ("two", 3, None), 3: (None, 4, None)}
