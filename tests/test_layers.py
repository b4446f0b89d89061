"""Layered views: what a batch reads, rankings under retraction, and scores against a moving maximum."""

import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import top_k
from tidemill.operators.latest import ordering, precedes
from tidemill.plans import logistics, sales, segments
from tidemill.streaming.catalog import VIEWS
from tidemill.streaming.layers import LatestView, MovingMaximum
from tidemill.streaming.ranking import TopK
from tidemill.streaming.runners import Keyed, MaintainedView


def test_precedes_is_the_sort_order(spark):
    rng = random.Random(3)
    rows = spark.createDataFrame([(i, rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"])) for i in range(60)], "id int, n int, s string")
    order = [("n", False), ("s", True), ("id", True)]
    place = {r["id"]: i for i, r in enumerate(rows.orderBy(*ordering(order)).collect())}
    pairs = rows.alias("a").crossJoin(rows.alias("b")).select(
        F.col("a.id").alias("x"), F.col("b.id").alias("y"), precedes(order, lambda c: F.col(f"a.{c}"), lambda c: F.col(f"b.{c}")).alias("p"))
    assert all(r["p"] == (place[r["x"]] < place[r["y"]]) for r in pairs.collect())


def scores_view(path, buckets=3):
    return MaintainedView(f"{path}/scores", lambda rows: rows.select("k", "n"), ["k"], ["k"], keyed={"rows": Keyed(("k",), ("v",), "op")}, buckets=buckets)


@pytest.mark.parametrize("seed, slack", [(2, 0)])
def test_top_k_follows_updates_and_deletes(spark, tmp_path, seed, slack):
    rng = random.Random(seed)
    view = scores_view(str(tmp_path))
    top = TopK(str(tmp_path / "top"), view, [("n", False), ("k", True)], k=3, slack=slack)
    now, version = {}, 0
    for batch in range(4):
        rows = []
        for k in rng.sample(range(40), 25 if batch == 0 else 12):
            version += 1
            op = "delete" if k in now and rng.random() < 0.45 else "update"
            now.pop(k, None)
            if op == "update":
                now[k] = rng.choice([None, *range(9)])
            rows.append((k, now.get(k), version, op))
        df = spark.createDataFrame(rows, "k int, n int, v int, op string")
        for _ in range(2 if batch == 2 else 1):  # a batch may run again
            top.process({"scores": view.process({"rows": df}, batch)}, batch)
        want = sorted(now.items(), key=lambda e: (e[1] is None, -(e[1] or 0), e[0]))[:3]
        assert [(r["k"], r["n"]) for r in top.read(spark).collect()] == want
    assert top.refills


def test_the_reserve_spares_the_refill(spark, tmp_path):
    """Deletes inside the reserve read nothing again; only a part that runs low is read, and only that part."""
    view = scores_view(str(tmp_path))
    top = TopK(str(tmp_path / "top"), view, [("n", False), ("k", True)], k=3, slack=4)
    changes = []

    def batch(i, rows):
        found = top.process({"scores": view.process({"rows": spark.createDataFrame(rows, "k int, n int, v int, op string")}, i)}, i)
        changes.append(sorted((r["k"], r["op"]) for r in found.collect()))

    batch(0, [(k, k, 0, "insert") for k in range(400)])
    batch(1, [(399, None, 1, "delete"), (5, 1000, 1, "update")])
    assert top.refills == [] and changes[1] == [(5, "Insert"), (397, "Delete"), (399, "Delete")] or changes[1] == [(5, "Insert"), (399, "Delete")]
    parts = {k: p for k, p in view.table.changes(spark).select("k", F.pmod(F.xxhash64("k"), F.lit(3)).cast("int").alias("p")).distinct().collect()}
    gone = [k for k in range(398, 300, -1) if parts[k] == parts[398]][:6]
    batch(2, [(k, None, 2, "delete") for k in gone])
    assert top.refills == [(2, [parts[398]])]
    left = [k for k in (5, *range(398, 0, -1)) if k not in gone][:3]
    assert [r["k"] for r in top.read(spark).collect()] == left


def test_a_ranking_is_stored_and_not_cached(spark, tmp_path, monkeypatch):
    view = scores_view(tmp_path)
    top = TopK(f"{tmp_path}/top", view, [("n", False), ("k", True)], 2)
    monkeypatch.setattr(type(spark.range(0)), "persist", None)
    for batch, rows in enumerate([[(1, 5, 1, "insert"), (2, 7, 1, "insert"), (3, 6, 1, "insert")], [(2, 1, 2, "update")]]):
        top.process({"scores": view.process({"rows": spark.createDataFrame(rows, "k int, n int, v int, op string")}, batch)}, batch)
    assert [(r["k"], r["n"]) for r in top.read(spark).collect()] == [(3, 6), (1, 5)]


def test_top_products_with_changed_products(spark, tmp_path):
    at = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:30"))
    sold = spark.createDataFrame([(i, i % 6, 1 + i % 4) for i in range(40)], "sale_id int, product_id int, quantity int").withColumn("sale_timestamp", at)
    first = [(p, f"c{p % 2}", f"name{p}", 1, "insert") for p in range(6)]
    later = [(1, "c1", "name3", 2, "update"), (4, "c0", "name4", 2, "delete")]
    schema = "product_id int, category string, product_name string, version int, op string"
    view = VIEWS["top_products"].at(str(tmp_path), buckets=3, n=3, keyed={"products": Keyed(("product_id",), ("version",), "op")})
    view.process({"sales": sold.where("sale_id < 20"), "products": spark.createDataFrame(first, schema)}, 0)
    view.process({"sales": sold.where("sale_id >= 20"), "products": spark.createDataFrame([], schema)}, 1)
    view.process({"sales": sold.limit(0), "products": spark.createDataFrame(later, schema)}, 2)
    products = spark.createDataFrame([r for r in first if r[0] not in (1, 4)] + later[:1], schema)
    want = sales.top_products(sold, products, n=3)
    assert [tuple(r) for r in view.read(spark).select(want.columns).collect()] == [tuple(r) for r in want.collect()]


def test_a_gps_fix_reads_the_orders_of_its_vehicle(spark, tmp_path):
    ts = lambda text: F.to_timestamp_ntz(F.lit(text))
    orders = spark.range(600).select(
        F.concat(F.lit("o"), "id").alias("order_id"), F.concat(F.lit("v"), F.col("id") % 60).alias("vehicle_id"), F.lit("in_transit").alias("status"),
        F.lit(1.0).alias("dest_lat"), F.lit(1.0).alias("dest_lon"), ts("2024-01-02 00:00:00").alias("promised_ts"), ts("2024-01-01 00:00:00").alias("updated_at"))

    def fixes(vehicles, minute, lat):
        return spark.createDataFrame([(f"v{v}",) for v in vehicles], "vehicle_id string").select(
            "vehicle_id", (F.lit(lat) + F.substring("vehicle_id", 2, 9).cast("double") / 10).alias("lat"), F.lit(0.5).alias("lon"), F.lit(30.0).alias("speed_kmh"),
            ts(f"2024-01-01 00:{minute:02d}:00").alias("event_ts"))

    def cells(rows):
        return spark.createDataFrame(rows, "region_id string, lat double, congestion double, traffic_speed_kmh double, minute int").select(
            "region_id", F.col("lat").alias("min_lat"), F.col("lat").alias("max_lat"), F.lit(0.5).alias("min_lon"), F.lit(0.5).alias("max_lon"), "congestion", "traffic_speed_kmh",
            (ts("2024-01-01 00:00:00") + F.make_dt_interval(mins=F.col("minute"))).alias("event_ts"))

    view = VIEWS["order_eta"].at(str(tmp_path), buckets=16)
    seen = {}
    for name in ("placed", "eta"):
        layer = view.layers[name][0]

        def counted(compute=layer.compute, name=name, **frames):
            seen[name] = {n: f.count() for n, f in frames.items()}
            return compute(**frames)

        layer.compute = counted
    none = {"updates": orders.limit(0), "gps": fixes([], 0, 0.0), "traffic": cells([])}
    all_fixes = [fixes(range(60), 1, 10.0)]
    view.process({"updates": orders, "gps": all_fixes[0], "traffic": cells([("r0", 10.0, 0.5, 20.0, 0)])}, 0)
    assert seen["placed"]["orders"] == 600
    all_fixes.append(fixes([7], 2, 20.0))
    changes = view.process(none | {"gps": all_fixes[1]}, 1)
    assert seen == {"placed": {"orders": 10, "vehicles": 1}, "eta": {"placed": 10, "cells": 0}}
    assert changes.where("op <> 'Delete'").count() == 10
    traffic = [("r0", 10.0, 0.5, 20.0, 0), ("r1", 20.7, 0.2, 10.0, 3)]
    view.process(none | {"traffic": cells(traffic[1:])}, 2)
    assert seen["eta"] == {"placed": 10, "cells": 1}
    want = logistics.order_eta(orders, all_fixes[0].unionByName(all_fixes[1]), cells(traffic))
    got = view.read(spark).select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_latest_view_ignores_late_versions(spark, tmp_path):
    view = LatestView(str(tmp_path), ["k"], ["v"], buckets=2)
    batch = lambda *rows: spark.createDataFrame(list(rows), "k int, v int, x string")
    assert view.process({"r": batch((1, 5, "a"), (1, 4, "b"), (2, 1, "c"))}, 0).count() == 2
    assert view.process({"r": batch((1, 3, "late"), (None, 1, "n"))}, 1).count() == 1
    for _ in range(2):
        assert [(r["k"], r["op"]) for r in view.process({"r": batch((2, 9, "new"))}, 2).collect()] == [(2, "UpdateInsert")]
    assert sorted(map(str, map(tuple, view.read(spark).collect()))) == ["(1, 5, 'a')", "(2, 9, 'new')", "(None, 1, 'n')"]


def test_a_newer_order_scores_only_users_at_a_step(spark, tmp_path):
    """The newest order moves on by a day: only users whose last order is 3, 10, 30 or 60 days back are read."""
    def orders(rows):
        return spark.createDataFrame(rows, "order_id int, user_id string, order_status string, price double, day int").withColumn(
            "order_time", F.to_timestamp_ntz(F.lit("2024-01-01 12:00:00")) + F.make_dt_interval(days=F.col("day"))).drop("day")

    first = [(i, f"u{i}", "completed", 300.0, i % 100) for i in range(1000)]
    view = VIEWS["rfm_scores"].at(str(tmp_path), buckets=16)
    layer, seen = view.layers["rfm"][0], []

    def counted(compute=layer.compute, **frames):
        seen.append(frames["totals"].count())
        return compute(**frames)

    layer.compute = counted
    batches = [first, [(2000, "new", "completed", 10.0, 100)], [(2001, "u0", "open", 10.0, 50)], [(2002, "u1", "completed", 1.0, 400)]]
    for i, rows in enumerate(batches):
        view.process({"orders": orders(rows)}, i)
        known = orders([r for b in batches[:i + 1] for r in b])
        want, got = segments.rfm_scores(known), view.read(spark)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # Two slots at each of four steps with ten users each, and the new user; then the slots of a moved user.
    assert seen[0] == 1000 and seen[1] <= 4 * 2 * 10 + 1 and seen[2] <= 2 * 10 + 1


def test_moving_maximum(spark, tmp_path):
    clock = MovingMaximum(str(tmp_path / "m"))
    at = lambda *secs: spark.createDataFrame([(s,) for s in secs], "s long").select(F.timestamp_seconds("s").alias("t"))
    assert clock.at(spark, 5) is None
    for i, batch in enumerate([at(), at(100), at(40), at(400)]):
        clock.advance(batch, "t", i)
        clock.advance(batch, "t", i)
    assert [clock.at(spark, i) for i in range(4)] == [None, 100_000_000, 100_000_000, 400_000_000]
    assert clock.crossed(spark, 2, ["10 seconds"], "10 seconds").count() == 0
    assert sorted(r[0] for r in clock.crossed(spark, 3, ["390 seconds"], "10 seconds").collect()) == list(range(-29, 2))
