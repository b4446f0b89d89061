"""A stream must end where the batch query ends, in any order and any split."""

import os
import random
import time
from functools import partial
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemill.operators import latest_by, tumble
from tidemill.plans import logistics, markets, web
from tidemill.sinks.keyed import KeyedTable, merge_into
from tidemill.sinks.staged import StagedAppends, StagedUpserts
from tidemill.sources import files, landed
from tidemill.streaming.expiry import Retention, present, retained, rocks_state
from tidemill.streaming.joins import outer_interval_view
from tidemill.streaming.runners import Keyed, MaintainedView, start_append, start_native
from tidemill.streaming.views import ViewGraph


small_view = partial(MaintainedView, buckets=4)


def land(spark, df, path, parts, seed):
    """Write the rows as ``parts`` files in random order, one write per file."""
    rows = df.collect()
    random.Random(seed).shuffle(rows)
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], df.schema).coalesce(1).write.mode("append").parquet(path)
    return files.replay(spark, path, df.schema)


def same(a, b):
    b = b.select(a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet")


@pytest.mark.parametrize("parts, seed", [(2, 1), (4, 2)])
def test_native_windows(spark, sf, tmp_path, parts, seed):
    e = events(spark, sf)
    plan = lambda df: tumble(df, "ts", "1 day").groupBy("event_type", "window_start").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    table = KeyedTable(str(tmp_path / "t"), ["event_type", "window_start"])
    start_native(plan(land(spark, e, str(tmp_path / "in"), parts, seed)), table, str(tmp_path / "c")).awaitTermination()
    same(table.read(spark), plan(e))


@pytest.mark.parametrize("parts, seed", [(2, 3), (5, 4)])
def test_maintained_rolling_frame(spark, sf, tmp_path, parts, seed):
    ticks = events(spark, sf).select((F.col("user_id") % 5).alias("asset_id"), F.col("ts").alias("timestamp"), "value").select(
        "asset_id", "timestamp", F.floor("value").cast("double").alias("price"), F.lit(1.0).alias("bid_price"), F.lit(2.0).alias("ask_price"))
    view = small_view(str(tmp_path / "v"), lambda ticks: markets.price_and_spread(ticks, "2 days"), ["asset_id", "timestamp"], ["asset_id"], compact_every=2)
    view.start({"ticks": land(spark, ticks, str(tmp_path / "in"), parts, seed)}, str(tmp_path / "c")).awaitTermination()
    same(view.read(spark), markets.price_and_spread(ticks, "2 days"))


def test_maintained_join_with_changing_dimension(spark, tmp_path):
    """A changed user row must change rows that were already written."""
    visits = spark.createDataFrame([(i % 4, f"p{i % 3}") for i in range(20)], "user_id int, page_id string")
    users = spark.createDataFrame([(0, "a", 1), (1, "b", 1), (0, "A", 2), (3, "d", 3)], "user_id int, name string, version int")

    def compute(visits, users):
        known = latest_by(users, ["user_id"], ["version"])
        return visits.join(known, "user_id", "left").groupBy("user_id", "name").agg(F.count(F.lit(1)).alias("n"))

    seen = []
    view = small_view(str(tmp_path / "v"), compute, ["user_id"], ["user_id"], on_change=lambda df: seen.extend(r.op for r in df.collect()))
    view.process({"visits": visits.filter("page_id = 'p0'"), "users": users.filter("version = 1")}, 0)
    view.process({"visits": visits.filter("page_id <> 'p0'"), "users": users.filter("version = 9")}, 1)
    view.process({"visits": visits.limit(0), "users": users.filter("version > 1")}, 2)
    same(view.read(spark), compute(visits, users))
    assert seen.count("Insert") == 4 and "UpdateInsert" in seen


def test_two_streams_into_one_view(spark, sf, tmp_path):
    e = events(spark, sf).select("event_id", "user_id", "event_type")
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_custkey").alias("user_id"), "o_totalprice")
    plan = lambda clicks, orders: clicks.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).join(
        orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("m")), "user_id", "full")
    view = small_view(str(tmp_path / "v"), plan, ["user_id"], ["user_id"])
    streams = {"clicks": land(spark, e, str(tmp_path / "a"), 3, 1), "orders": land(spark, orders, str(tmp_path / "b"), 2, 2)}
    view.start(streams, str(tmp_path / "c")).awaitTermination()
    same(view.read(spark), plan(e, orders))


def test_global_ranking_takes_rows_back(spark, tmp_path):
    """A top-n row that falls out of the ranking must disappear."""
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 1)], "k string, n int")
    more = spark.createDataFrame([("c", 9)], "k string, n int")
    plan = lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")).orderBy(F.desc("n")).limit(2)
    view = small_view(str(tmp_path / "v"), plan, ["k"])
    view.process({"rows": df}, 0)
    assert sorted(r.k for r in view.read(spark).collect()) == ["a", "b"]
    view.process({"rows": more}, 1)
    assert sorted((r.k, r.n) for r in view.read(spark).collect()) == [("a", 5), ("c", 10)]


def test_a_batch_may_be_processed_again(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    view = small_view(str(tmp_path / "v"), lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), ["k"], ["k"])
    for batch_id in (0, 0, 1, 1, 1):
        view.process({"rows": df}, batch_id)
    assert sorted(tuple(r) for r in view.read(spark).collect()) == [("a", 2), ("b", 4)]


def test_moving_filter_lets_rows_leave(spark, tmp_path):
    sales = spark.createDataFrame([(1, 1, 5, "2024-01-01 00:00:00"), (1, 2, 3, "2024-01-05 00:00:00")], "warehouse_id int, product_id int, quantity_sold int, t string").select(
        "warehouse_id", "product_id", "quantity_sold", F.col("t").cast("timestamp_ntz").alias("timestamp"))
    got = lambda now: sorted(r.product_id for r in logistics.recent_sales(sales, now).collect())
    assert got("2024-01-06 00:00:00") == [1, 2] and got("2024-01-08 00:00:00") == [2] and got("2024-02-01 00:00:00") == []


def test_refresh_follows_the_clock(spark, tmp_path):
    sales = spark.createDataFrame([(1, 1, 5, "2024-01-01 00:00:00"), (1, 2, 3, "2024-01-05 00:00:00")], "warehouse_id int, product_id int, quantity_sold int, t string").select(
        "warehouse_id", "product_id", "quantity_sold", F.col("t").cast("timestamp_ntz").alias("timestamp"))
    now = ["2024-01-06 00:00:00"]
    view = small_view(str(tmp_path / "v"), lambda sales: logistics.recent_sales(sales, now[0]), ["warehouse_id", "product_id"])
    shown = lambda: sorted(r.product_id for r in view.read(spark).collect())
    view.process({"sales": sales}, 0)
    assert shown() == [1, 2]
    now[0] = "2024-01-09 00:00:00"
    view.refresh(spark, ["sales"])
    assert shown() == [2]
    view.process({"sales": sales.withColumns({"product_id": F.lit(7), "timestamp": F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")}).limit(1)}, 1)
    assert shown() == [2, 7]


def test_refresh_to_nothing_tells_the_handlers(spark, tmp_path):
    sales = spark.createDataFrame([(1, 1, 5, "2024-01-01 00:00:00"), (1, 2, 3, "2024-01-05 00:00:00")], "warehouse_id int, product_id int, quantity_sold int, t string").select(
        "warehouse_id", "product_id", "quantity_sold", F.col("t").cast("timestamp_ntz").alias("timestamp"))
    now, came, left = ["2024-01-06 00:00:00"], [], []
    view = small_view(str(tmp_path / "v"), lambda sales: logistics.recent_sales(sales, now[0]), ["warehouse_id", "product_id"],
                      on_change=lambda df: came.extend(df.collect()), on_delete=lambda df: left.extend(df.collect()))
    view.process({"sales": sales}, 0)
    assert len(came) == 2 and not left
    now[0] = "2024-03-01 00:00:00"
    assert sorted(r.op for r in view.refresh(spark, ["sales"]).collect()) == ["Delete", "Delete"]
    assert view.read(spark).count() == 0 and sorted(r.product_id for r in left) == [1, 2]
    assert view.refresh(spark, ["sales"]).count() == 0


def test_updated_rows_move_between_scopes(spark, tmp_path):
    """A row that moves leaves its old scope; a late older version and a repeated batch change nothing."""
    users = lambda *r: spark.createDataFrame(list(r), "id int, age int, city string, v int, op string")
    view = small_view(str(tmp_path / "v"), lambda users: web.city_average_age(users, 0), ["city"], ["city"], keyed={"users": Keyed(("id",), ("v",), "op")})
    shown = lambda: sorted((r.city, r.avg_age) for r in view.read(spark).collect())
    view.process({"users": users((1, 20, "SF", 1, "c"), (2, 30, "SF", 1, "c"), (3, 40, "NY", 1, "c"))}, 0)
    assert shown() == [("NY", 40.0), ("SF", 25.0)]
    view.process({"users": users((1, 21, "NY", 5, "u"), (1, 99, "LA", 4, "u"))}, 1)
    assert shown() == [("NY", 30.5), ("SF", 30.0)]
    view.process({"users": users((1, 20, "LA", 3, "u"))}, 2)  # late
    assert shown() == [("NY", 30.5), ("SF", 30.0)]
    for _ in range(2):
        view.process({"users": users((2, None, None, 6, "d"), (1, 22, "SF", 7, "u"))}, 3)
        assert shown() == [("NY", 40.0), ("SF", 22.0)]
    view.process({"users": users((3, None, None, 8, "d"))}, 4)
    assert shown() == [("SF", 22.0)]


def test_compaction_may_be_repeated(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ["k"], ["k"], 4)
    for i in range(3):
        table.apply(spark.createDataFrame([(i, i * 10)], "k int, v int"), i)
        table.compact(spark)
        table.compact(spark)
    assert sorted(tuple(r) for r in table.read(spark).collect()) == [(0, 0), (1, 10), (2, 20)]


def test_keyed_table_compaction_and_deletes(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ["k"])
    assert table.read(spark) is None
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string, op string")
    table.apply(rows((1, "a", "Insert"), (2, "b", "Insert")), 0)
    table.apply(rows((1, "x", "UpdateInsert"), (2, "b", "Delete")), 1)
    read = lambda **kw: sorted(tuple(r) for r in table.read(spark, **kw).collect())
    assert read() == [(1, "x")] and read(before=1) == [(1, "a"), (2, "b")]
    table.compact(spark)
    table.apply(rows((3, "c", "Insert"), (1, "y", "UpdateInsert")), 2)
    assert read() == [(1, "y"), (3, "c")] and read(before=2) == [(1, "x")]


def test_merge_statement():
    text = merge_into("lake.t", "staged", ["k"], ["k", "v"])
    assert text.startswith("MERGE INTO lake.t t USING staged s ON t.`k` <=> s.`k`")
    assert "UPDATE SET t.`v` = s.`v`" in text and "THEN DELETE" in text and "INSERT (`k`, `v`)" in text


def test_view_graph(spark):
    g = ViewGraph().add("v_top", lambda m: m.filter("id > 1"), ["v_mid"]).add("v_mid", lambda b: b.select("id"), ["v_base"]).add("v_base", lambda: spark.range(4))
    assert g.order() == ["v_base", "v_mid", "v_top"] and g.names() == ["v_base", "v_mid", "v_top"]
    g.build(spark)
    assert spark.table("v_top").count() == 2
    with pytest.raises(ValueError):
        g.drop(spark, "v_mid")
    assert g.drop(spark, "v_mid", cascade=True) == ["v_mid", "v_top"] and g.names() == ["v_base"]
    assert not spark.catalog.tableExists("v_top")
    with pytest.raises(ValueError):
        ViewGraph().add("a", lambda x: x, ["nowhere"]).order()


def test_visits_replay_keeps_counts(spark, tmp_path):
    lines = spark.createDataFrame([(i % 3, i % 5, f"2023-06-13T10:{i:02d}:00") for i in range(30)], "page_id int, user_id int, t string").select(
        "page_id", "user_id", F.col("t").cast("timestamp_ntz").alias("timestamp"))
    view = small_view(str(tmp_path / "v"), lambda visits: web.page_visits(visits), ["page_id"], ["page_id"])
    view.start({"visits": land(spark, lines, str(tmp_path / "in"), 4, 7)}, str(tmp_path / "c")).awaitTermination()
    same(view.read(spark), web.page_visits(lines))


# -- commits, start positions, expiry, outer joins ------------------------------------------------------


def test_readers_see_whole_commits(spark, tmp_path):
    """A batch behind the last commit does not show, also after it ran twice and after the sink was opened anew."""
    batch = lambda i: spark.createDataFrame([(k, i) for k in range(2)], "k int, n int")
    shown = lambda: sorted(tuple(r) for r in sink().read(spark).collect()) if sink().read(spark) else None
    sink = lambda: StagedAppends(str(tmp_path / "a"), 2)
    seen = []
    for i in (0, 0, 1, 1, 2, 2, 3):
        sink().handler(batch(i), i)
        seen.append(shown())
    first = [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert seen[:6] == [None, None, first, first, first, first] and len(seen[6]) == 8
    # A committed batch that is delivered again with other rows changes nothing.
    sink().handler(batch(9), 1)
    assert shown() == seen[6]
    keyed = StagedUpserts(str(tmp_path / "k"), ["k"], 2)
    for i in range(3):
        keyed.handler(batch(i), i)
    assert sorted(tuple(r) for r in keyed.read(spark).collect()) == [(0, 1), (1, 1)]
    with pytest.raises(ValueError):
        StagedAppends(str(tmp_path / "x"), 0)


def test_start_positions(spark, tmp_path):
    """Files before the start are not opened: they have gone when the stream runs; a restart goes on behind the last file."""
    folder, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "c")
    folder.mkdir()
    for i, name in enumerate(["a", "b", "c"]):
        (folder / name).write_text(f"{name}1\n{name}2é")
        os.utime(folder / name, (1_700_000_000 + i, 1_700_000_000 + i))
    (folder / "_SUCCESS").write_text("x")
    files_ = landed.landed(str(folder))
    assert [n for _, n in files_] == ["a", "b", "c"]
    assert landed.start_of("latest", files_) == files_[-1] and landed.start_of("latest", []) == (-1, "")
    later = lambda start: [n for at, n in files_ if landed.start_of(start, files_) < (at, n)]
    assert later("earliest") == ["a", "b", "c"] and later("1700000001000") == ["b", "c"] and later('{"micros": 1700000001000000, "name": "b"}') == ["c"]
    with pytest.raises(ValueError):
        landed.read_landed(spark, str(folder), "someday")
    reader = landed._Reader(str(folder), "1700000001000")
    assert [p.name for p in reader.partitions(reader.initialOffset(), reader.latestOffset())] == ["b", "c"]

    def run():
        start_append(landed.read_landed(spark, str(folder), "1700000001000"), out, ckpt).awaitTermination()
        return sorted(r["value"] for r in spark.read.parquet(out).collect())

    assert run() == ["b1", "b2é", "c1", "c2é"]
    (folder / "d").write_text("d1\n")
    assert run() == ["b1", "b2é", "c1", "c2é", "d1"]


class _Rows:
    """A list state and timers in memory, counting the rows read."""

    def __init__(self):
        self.rows, self.timers, self.read = [], [], 0

    def getListState(self, name, schema):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def appendList(self, rows):
        self.rows += rows

    def get(self):
        self.read += len(self.rows)
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def clear(self):
        self.rows = []


def test_a_timer_reads_its_own_rows():
    state, now = _Rows(), [0]
    timers = SimpleNamespace(getCurrentWatermarkInMs=lambda: now[0])
    keeper = Retention(True)
    keeper.init(state)
    came = pd.concat(keeper.handleInputRows(("s", 0), [pd.DataFrame({"row": list("abcd"), "due": [5, 7, 9, 7]})], timers))
    assert came["row"].tolist() == list("abcd") and state.timers == [5] and state.read == 0
    now[0] = 7
    fired = SimpleNamespace(getExpiryTimeInMs=lambda: 5)
    gone = pd.concat(keeper.handleExpiredTimer(("s", 0), timers, fired))
    assert gone.values.tolist() == [["a", "Delete"], ["b", "Delete"], ["d", "Delete"]] and state.timers == [5, 9]
    late = list(keeper.handleInputRows(("s", 0), [pd.DataFrame({"row": ["e"], "due": [6]})], timers))
    assert late == [] and state.rows == [("c", 9)]
    now[0] = 9
    assert [r for f in keeper.handleExpiredTimer(("s", 0), timers, fired) for r in f["row"]] == ["c"] and state.rows == []
    assert list(keeper.handleExpiredTimer(("s", 0), timers, fired)) == []


def test_every_row_ends_by_the_wall_clock(spark, tmp_path):
    """Rows of all types come back as they were, and nothing arrives when they leave."""
    rows = spark.sql("""SELECT id, current_timestamp() - INTERVAL 1 SECOND * (id % 3) AS ts, IF(id % 2 = 0, NULL, CAST(id / 3 AS DOUBLE)) AS x, CAST(id AS DECIMAL(20, 4)) AS d,
        timestamp_ntz'2024-01-01 00:00:00.123456' AS n, array(id) AS a, IF(id = 7, NULL, 'é"') AS s FROM range(8)""")
    rows.write.parquet(str(tmp_path / "in"))
    first = spark.read.parquet(str(tmp_path / "in"))
    changes = retained(files.replay(spark, str(tmp_path / "in"), rows.schema, max_files=100), "ts", "12 seconds", clock="processing", buckets=1)
    out = str(tmp_path / "out")
    with rocks_state(spark):
        query = start_append(changes, out, str(tmp_path / "c"), every="1 second")
    try:
        deadline = time.time() + 120
        while time.time() < deadline:
            time.sleep(2)
            if query.exception():
                raise query.exception()
            try:
                if spark.read.schema(changes.schema).parquet(out).where("op = 'Delete'").count() == 8:
                    break
            except AnalysisException:
                pass
    finally:
        query.stop()
    log = spark.read.schema(changes.schema).parquet(out)
    assert present(log).count() == 0
    for op in ("Insert", "Delete"):
        same(log.where(f"op = '{op}'").drop("op"), first)


@pytest.mark.parametrize("how", ["left", "full"])
def test_outer_interval_join_takes_early_nulls_back(spark, tmp_path, how):
    at = lambda m: F.timestamp_seconds(F.lit(1_700_000_000) + m * 60).cast("timestamp_ntz")
    left = lambda *r: spark.createDataFrame(list(r), "a int, k string, m int").withColumn("t", at(F.col("m"))).drop("m")
    right = lambda *r: spark.createDataFrame(list(r), "b int, rk string, rm int").withColumn("rt", at(F.col("rm"))).drop("rm")
    view = outer_interval_view(str(tmp_path), {"k": "rk"}, "t", "rt", "a", "b", "10 minutes", "0 minutes", how, width="30 minutes", buckets=2)
    steps = [({"left": left((1, "x", 100), (2, None, 5)), "right": right((1, "y", 95))}, [(1, None, "Insert"), (2, None, "Insert"), (None, 1, "Insert")]),
             ({"left": left(), "right": right((2, "x", 92), (3, "x", 89))}, [(1, None, "Delete"), (1, 2, "Insert"), (None, 3, "Insert")]),
             ({"left": left((3, "x", 99)), "right": right((4, "x", None))}, [(3, 2, "Insert"), (3, 3, "Insert"), (None, 3, "Delete"), (None, 4, "Insert")])]
    if how == "left":
        steps = [(b, [c for c in changes if c[0]]) for b, changes in steps]
    for i, (batch, changes) in enumerate(steps):
        got = view.process(batch, i).collect()
        assert sorted(map(str, ((r["a"], r["b"], r["op"]) for r in got))) == sorted(map(str, changes))


def test_rows_that_come_together_wait_as_one_entry():
    """What state is asked to do follows the batches, not the rows, and rows still leave one by one when due."""
    import pandas as pd

    from tidemill.streaming.expiry import Retention

    class Fake:
        def __init__(self):
            self.held, self.calls, self.timers, self.now = [], 0, [], 0

        def getListState(self, name, schema):
            return self

        def appendValue(self, value):
            self.calls += 1
            self.held.append(value)

        def put(self, values):
            self.held = list(values)

        def get(self):
            return iter(self.held)

        def clear(self):
            self.held = []

        def registerTimer(self, at):
            self.timers.append(at)

        def getCurrentWatermarkInMs(self):
            return self.now

        def getExpiryTimeInMs(self):
            return self.now

    state = Fake()
    kept = Retention(True)
    kept.init(state)
    rows = pd.DataFrame({"row": [f'{{"n":{i}}}' for i in range(1000)], "due": [100 + i % 10 for i in range(1000)]})
    came = pd.concat(kept.handleInputRows(None, iter([rows]), state))
    assert len(came) == 1000 and state.calls == 1 and state.timers == [100]
    state.now = 104
    left = pd.concat(kept.handleExpiredTimer(None, state, state))
    assert sorted(left["row"]) == sorted(rows["row"][rows["due"] <= 104]) and state.timers == [100, 105]
    state.now = 200
    left = pd.concat(kept.handleExpiredTimer(None, state, state))
    assert sorted(left["row"]) == sorted(rows["row"][rows["due"] > 104]) and state.held == []


def test_a_large_batch_lands_as_several_files(spark, monkeypatch):
    from tidemill.checks import streams

    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    seen = []
    stream = streams.as_stream(spark, spark.range(1000).toDF("n"), parts=2)
    query = stream.writeStream.foreachBatch(lambda b, i: seen.append(b.select("n", F.input_file_name().alias("f")).collect())).option(
        "checkpointLocation", streams.scratch_dir(spark, "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [len({r["f"] for r in rows}) for rows in seen] == [5, 5]
    assert sorted(r["n"] for rows in seen for r in rows) == list(range(1000))


def test_moves_take_one_aggregate_over_the_versions(spark, tmp_path):
    view = MaintainedView(str(tmp_path), lambda rows: rows, ["k"], ["s"], keyed={"rows": Keyed(("k",), ("v",), "op")}, buckets=2)
    schema = "k int, s string, v int, op string"
    view._moves("rows", spark.createDataFrame([(1, "a", 1, "insert"), (2, "a", 1, "insert"), (None, "a", 1, "insert"), (4, None, 1, "insert"), (5, "a", 5, "insert")], schema), 0)
    moved = view._moves("rows", spark.createDataFrame(
        [(1, "b", 2, "update"), (2, "a", 2, "delete"), (None, "a", 2, "update"), (4, "c", 2, "update"), (5, "z", 1, "update"), (6, "a", 1, "delete")], schema), 1)
    assert "LeftAnti" not in moved._jdf.queryExecution().optimizedPlan().toString()
    # A move marks the old scope; deletes leave only the mark; a late version moves nothing.
    assert sorted(map(str, moved.collect())) == sorted(map(str, [
        Row(k=1, s="b", v=2, _gone=False), Row(k=1, s="a", v=1, _gone=True), Row(k=2, s="a", v=1, _gone=True),
        Row(k=None, s="a", v=2, _gone=False), Row(k=4, s="c", v=2, _gone=False), Row(k=4, s=None, v=1, _gone=True),
        Row(k=5, s="a", v=5, _gone=False)]))
