"""Every maintained view: random splits into batches end where one batch query ends."""

import random
import re

import pytest
from compare import compare
from pyspark.sql import functions as F

from tidemill.checks import load_all
from tidemill.checks.harness import load, plain
from tidemill.plans import ledger
from tidemill.streaming.catalog import VIEWS, Layered
from tidemill.streaming.runners import MaintainedView

DAY = {"size": "1 day"}
LONG = {"horizon": "2 days"}
# Sample inputs of each view, in the order of its inputs, and the options for sparse data.
BOUND = {
    "page_visits": (["visits"], {}), "city_average_age": (["members"], {"at_least": 42}),
    "actions_per_window": (["user_actions", "user_names"], DAY), "user_request_metrics": (["web_logs"], DAY),
    "top_actions": (["web_logs"], DAY), "referrer_activity": (["web_logs"], DAY), "status_distribution": (["web_logs"], DAY),
    "price_and_spread": (["ticks"], LONG), "volatility": (["ticks"], LONG), "unusual_volume": (["trades"], LONG),
    "price_spike": (["quotes"], LONG), "quiet_tight_spread": (["quotes"], LONG),
    "spoofing_alerts": (["book", "best"], {"size": "1 day", "lookback": "2 days"}),
    "campaign_performance": (["marketing_events", "campaigns"], DAY), "channel_attribution": (["marketing_events"], DAY),
    "ab_test_results": (["marketing_events", "campaigns", "variants"], DAY),
    "demand_forecast": (["stock", "unit_sales"], {"as_of": "2001-10-01 00:00:00", "within": "300 days"}),
    "recent_sales": (["unit_sales"], {"as_of": "2001-10-01 00:00:00", "within": "300 days"}),
    "latest_orders": (["order_updates"], {}), "latest_vehicles": (["gps"], {}), "order_eta": (["order_updates", "gps", "road_cells"], {}),
    "position_overview": (["positions", "odds"], {}), "market_summary": (["positions", "odds"], {}), "betting_patterns": (["bets"], {}),
    "user_exposure": (["stakes"], {}), "high_risk_users": (["bettors", "stakes", "bets"], {}), "meal_status": (["checkins", "meals"], {}),
    "meal_shortages": (["checkins", "meals"], {}), "airline_flights": (["flights"], DAY), "airport_traffic": (["flights"], {"size": "30 days"}),
    "timezone_traffic": (["flights"], {"size": "30 days"}), "minute_deltas": (["purchases", "restocks"], DAY),
    "stock_status": (["product_inventory", "purchases", "restocks"], DAY), "clicks_per_window": (["web_clicks"], DAY),
    "latest_competitor_prices": (["offers"], {}), "lowest_competitor_price": (["offers"], {}),
    "click_behaviour": (["shop_events"], {"as_of": "2024-01-31 00:00:00"}), "rfm_scores": (["shop_orders"], {}),
    "customer_segments": (["shop_events", "shop_orders"], {"as_of": "2024-01-31 00:00:00"}),
    "energy_per_house": (["consumption", "production"], DAY), "single_alerts": (["vitals", "limits"], {}), "trend_alerts": (["vitals"], {"size": "3 days"}),
    "machine_averages": (["readings"], DAY), "machine_anomalies": (["readings"], {"size": "3 days", "outlier_sigmas": 2}),
    "device_metrics": (["network"], DAY), "sales_per_window": (["item_sales", "products"], DAY), "top_products": (["item_sales", "products"], DAY),
    "top_spenders": (["logins", "item_sales"], DAY),
    "net_purchases": (["inflow", "outflow"], {}), "team_figures": (["match_stats"], DAY), "mental_states": (["match_stats"], DAY),
    "spikes": (["match_stats"], {"slide": "1 day", "size": "2 days"}), "match_leaders": (["match_stats"], DAY),
    "impact_leaders": (["match_stats"], {"slide": "1 day", "size": "2 days"}), "block_stats": (["tx_batches"], {}),
    "window_stats": (["tx_batches"], {"slide": "1 hour", "size": "2 hours"}), "road_features": (["sensors", "cameras"], DAY),
    "session_figures": (["click_sessions", "click_events", "click_users", "click_devices"], {}),
    "conversion_funnel": (["funnel_views", "funnel_carts", "funnel_buys"], DAY),
}


def test_every_view_is_bound():
    assert set(BOUND) == set(VIEWS)


@pytest.mark.parametrize("name", list(BOUND))
def test_splits_do_not_matter(spark, sf, tmp_path, name):
    load_all()
    inputs, options = BOUND[name]
    view = VIEWS[name]
    frames = {}
    for param, source in zip(view.inputs, inputs):
        df = load(spark, sf, source)
        frames[param] = ledger.transactions(df) if source == "tx_batches" else df
    seed = random.Random(name).randrange(1000)
    stored = view.at(str(tmp_path / "v"), buckets=3, **options)
    batches = 2
    for i in range(batches):
        part = {n: df.filter(F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns]), F.lit(batches)) == i) for n, df in frames.items()}
        stored.process(part, i)
    want = plain(view.plan(**frames, **options))
    got = plain(stored.read(spark)).select(want.columns).toPandas()
    assert len(got) > 0
    verdict = compare(got, want.toPandas())
    assert verdict == "" or verdict.startswith("~digits"), verdict


def test_batch_reads_only_the_slots_it_reaches(spark, tmp_path):
    """A tick reads the slots its frame needs, however long the asset's history is; a late one reaches its own time."""
    from tidemill.plans import markets
    from tidemill.streaming.runners import Slots

    def ticks(*hours):
        rows = [("A", float(h), 1.0, 2.0, f"2024-01-{1 + h // 24:02d} {h % 24:02d}:59:59") for h in hours]
        return spark.createDataFrame(rows, "asset_id string, price double, bid_price double, ask_price double, ts string").select(
            "*", F.col("ts").cast("timestamp_ntz").alias("timestamp")).drop("ts")

    read = []

    def plan(ticks):
        pruned = re.search(r"PartitionFilters: \[[^\]]*_part#", ticks._jdf.queryExecution().executedPlan().toString())
        read.append((ticks.count(), bool(pruned)))
        return markets.price_and_spread(ticks, "2 hours")

    view = MaintainedView(str(tmp_path / "v"), plan, ["asset_id", "timestamp"], ["asset_id"], buckets=256,
                          slots=Slots({"ticks": "timestamp"}, "timestamp", after="2 hours", width="2 hours"))
    view.process({"ticks": ticks(*range(200))}, 0)
    view.process({"ticks": ticks(200)}, 1)
    view.process({"ticks": ticks(40).withColumn("price", F.lit(1000.0)).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 SECOND"))}, 2)
    assert read[0][0] == 200
    assert all(rows <= 8 and pruned for rows, pruned in read[1:]), read
    late = ticks(40).withColumn("price", F.lit(1000.0)).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 SECOND"))
    want = markets.price_and_spread(ticks(*range(201)).unionByName(late), "2 hours")
    assert compare(plain(view.read(spark)).toPandas(), plain(want).toPandas()) == ""


def test_every_view_is_bounded():
    """No view is recomputed as a whole: each has a scope or slots, or is built in layers that have."""
    for view in VIEWS.values():
        if isinstance(view, Layered):
            layers = [layer for layer, _ in view.at("/nowhere").layers.values()]
            assert all(layer.place for layer in layers if isinstance(layer, MaintainedView))
        else:
            assert view.scope or view.times
