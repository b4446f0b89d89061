"""The ready-made views as continuously maintained results.

Each entry says how far one new row can reach (its scope), so that a
micro-batch recomputes only what it touches.  ``by_window`` adds the window of
a row as scope, for plans that rank or share inside one window.  ``times``
adds time slots, for frames and windows per key: a batch then touches the
slots near its rows, not the whole history of their keys.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemill.functions.scalar import event_micros, micros
from tidemill.operators import tumble
from tidemill.plans import (
    betting, clicks, energy, games, health, ledger, logistics, machines, markets, marketing, pricing, sales, segments,
    traffic, travel, web,
)
from tidemill.streaming.layers import LatestView, Layers, MovingMaximum
from tidemill.streaming.ranking import ranked_layers
from tidemill.streaming.runners import Keyed, MaintainedView, Slots


@dataclass(frozen=True)
class View:
    plan: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    keys: tuple[str, ...]
    scope: tuple[str, ...] = ()
    shared: tuple[str, ...] = ()
    by_window: Mapping[str, str] = field(default_factory=dict)  # input -> its time column
    keyed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)  # input whose rows change -> its key
    times: Mapping[str, str] = field(default_factory=dict)  # input -> its time column, where results reach a bounded time
    result_time: str = "window_start"
    reach: str = "size"  # the plan's option that says how far: the length of a window, or of a frame
    frame: bool = False  # a frame looks back from its row, a window forward from its start

    def at(self, path: str, size: str | None = None, **options) -> MaintainedView:
        """The view stored at ``path``; ``size`` is the window size of a by-window view.

        ``keyed`` replaces how keyed inputs are told apart, to name the order of
        their versions and a delete column, ``slot`` sets the length of time slots.
        Other options go to the plan, or to ``MaintainedView`` where it knows them.
        """
        slot = options.pop("slot", None)
        runner = {k: options.pop(k) for k in ("on_change", "on_delete", "compact_every", "buckets") if k in options}
        runner["keyed"] = {n: Keyed(k) for n, k in self.keyed.items()} | options.pop("keyed", {})
        if size is not None:
            options["size"] = size
        derive = {}
        for name, ts in self.by_window.items():
            if size is None:
                raise ValueError("a by-window view needs its window size")
            derive[name] = lambda df, ts=ts: tumble(df, ts, size).drop("window_end")
        if self.times:
            length = options.get(self.reach, inspect.signature(self.plan).parameters[self.reach].default)
            runner["slots"] = Slots(self.times, self.result_time, width=slot, **{"after" if self.frame else "before": length})
        return MaintainedView(path, lambda **frames: self.plan(**frames, **options), self.keys, self.scope,
                              self.shared, derive, **runner)


@dataclass(frozen=True)
class Layered:
    """A view in layers: ``build(path, runner, keyed, **options)`` gives them, ``plan`` is the batch query it follows."""

    plan: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    build: Callable[..., Layers]
    keyed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def at(self, path: str, **options) -> Layers:
        """The view stored at ``path``; ``keyed`` replaces how keyed inputs are told apart, ``buckets`` and ``compact_every`` go to every layer."""
        runner = {k: options.pop(k) for k in ("compact_every", "buckets") if k in options}
        keyed = {n: Keyed(k) for n, k in self.keyed.items()} | options.pop("keyed", {})
        return self.build(path.rstrip("/"), runner, keyed, **options)


def _fed(*keys: str) -> Keyed:
    """An input that is the change feed of another layer."""
    return Keyed(keys, op="op")


def _top_products(path: str, runner: dict, keyed: dict, size: str = "1 minute", n: int = 5, slack: int | None = None) -> Layers:
    sold = MaintainedView(f"{path}/sold", lambda **frames: sales.product_windows(**frames, size=size),
                          ("product_id", "window_start"), ("product_id",), keyed=keyed, **runner)
    named = MaintainedView(f"{path}/named", sales.named_windows, ("category", "product_name", "window_start"),
                           ("category", "product_name"), keyed={"sold": _fed("product_id", "window_start")}, **runner)
    return Layers(ranked_layers(path, {"sold": (sold, ("sales", "products")), "named": (named, ("sold",))}, sales.PRODUCT_ORDER, n, slack))


def _top_spenders(path: str, runner: dict, keyed: dict, size: str = "1 minute", n: int = 10, slack: int | None = None) -> Layers:
    spent = MaintainedView(f"{path}/spent", lambda **frames: sales.spending(**frames, size=size),
                           ("user_id", "username", "email", "window_start"), ("user_id",), keyed=keyed, **runner)
    return Layers(ranked_layers(path, {"spent": (spent, ("users", "sales"))}, sales.SPENDER_ORDER, n, slack))


def _order_eta(path: str, runner: dict, keyed: dict) -> Layers:
    """Orders are placed by vehicle, then timed by cell: the buckets of either scope are the index from a report to its orders."""
    latest = {"orders": (LatestView(f"{path}/orders", ["order_id"], ["updated_at"], **runner), ("updates",)),
              "vehicles": (LatestView(f"{path}/vehicles", ["vehicle_id"], ["gps_ts"], lambda df: logistics.gps_cells(df).withColumnRenamed("event_ts", "gps_ts"), **runner), ("gps",)),
              "cells": (LatestView(f"{path}/cells", ["grid_id"], ["event_ts", "region_id"], logistics.traffic_cells, **runner), ("traffic",))}
    placed = MaintainedView(f"{path}/placed", logistics.orders_on_vehicles, ("vehicle_id", "order_id"), ("vehicle_id",),
                            keyed={"orders": _fed("order_id"), "vehicles": _fed("vehicle_id")}, **runner)
    eta = MaintainedView(f"{path}/eta", logistics.eta_in_traffic, ("grid_id", "vehicle_id", "order_id"), ("grid_id",),
                         keyed={"placed": _fed("vehicle_id", "order_id"), "cells": _fed("grid_id")}, **runner)
    return Layers({**latest, "placed": (placed, ("orders", "vehicles")), "eta": (eta, ("placed", "cells"))})


SLOT_OF_ORDER = "order_slot"


def _rfm_layers(path: str, runner: dict, width: str) -> tuple[dict, MovingMaximum]:
    """Order totals by user, then scores by the slot of the last order: as the newest order moves on, only slots at a step's edge change."""
    newest = MovingMaximum(f"{path}/newest")
    now: dict[str, int | None] = {}
    slot = lambda df: df.withColumn(SLOT_OF_ORDER, F.floor(event_micros("last_order_time") / micros(width)))

    def scores(totals: DataFrame) -> DataFrame:
        latest = F.timestamp_micros(F.lit(now["value"]).cast("long")).cast(totals.schema["last_order_time"].dataType)
        return segments.rfm_points(totals.withColumn("max_order_time", latest), SLOT_OF_ORDER)

    def crossed(spark: SparkSession, batch_id: int) -> DataFrame:
        now["value"] = newest.at(spark, batch_id)
        limits = [limit for limit, _ in segments.RECENCY_STEPS]
        return newest.crossed(spark, batch_id, limits, width).withColumnRenamed("slot", SLOT_OF_ORDER)

    totals = MaintainedView(f"{path}/totals", lambda orders: segments.user_orders(orders), ("user_id",), ("user_id",), **runner)
    rfm = MaintainedView(f"{path}/rfm", scores, (SLOT_OF_ORDER, "user_id"), (SLOT_OF_ORDER,), derive={"totals": slot},
                         keyed={"totals": _fed("user_id")}, also=crossed, **runner)
    return {"totals": (totals, ("orders",)), "rfm": (rfm, ("totals",))}, newest


def _rfm_scores(path: str, runner: dict, keyed: dict, width: str = "1 day") -> Layers:
    layers, newest = _rfm_layers(path, runner, width)
    return Layers(layers, hidden=[SLOT_OF_ORDER], first=lambda batches, i: newest.advance(batches["orders"], "order_time", i))


def _customer_segments(path: str, runner: dict, keyed: dict, as_of=None, width: str = "1 day") -> Layers:
    layers, newest = _rfm_layers(path, runner, width)
    whole = MaintainedView(f"{path}/segments", lambda events, rfm: segments.segments_of(events, rfm, as_of), ("user_id",), ("user_id",),
                           keyed={"rfm": _fed(SLOT_OF_ORDER, "user_id")}, **runner)
    return Layers({**layers, "segments": (whole, ("events", "rfm"))}, first=lambda batches, i: newest.advance(batches["orders"], "order_time", i))


VIEWS: dict[str, View | Layered] = {
    # web
    "page_visits": View(web.page_visits, ("visits",), ("page_id",), ("page_id",)),
    "city_average_age": View(web.city_average_age, ("users",), ("city",), ("city",), keyed={"users": ("id",)}),
    "actions_per_window": View(web.actions_per_window, ("visits", "users"), ("user_id", "page_id", "window_end"), ("user_id",), keyed={"users": ("user_id",)}),
    "user_request_metrics": View(web.user_request_metrics, ("logs",), ("username", "window_start"), ("username",), times={"logs": "request_timestamp"}),
    "top_actions": View(web.top_actions, ("logs",), ("window_start", "user_action"), ("window_start",), by_window={"logs": "request_timestamp"}),
    "referrer_activity": View(web.referrer_activity, ("logs",), ("referrer", "window_start"), ("referrer",), times={"logs": "request_timestamp"}),
    "status_distribution": View(web.status_distribution, ("logs",), ("window_start", "status_code"), ("window_start",), by_window={"logs": "request_timestamp"}),
    # markets
    "price_and_spread": View(markets.price_and_spread, ("ticks",), ("asset_id", "timestamp"), ("asset_id",), times={"ticks": "timestamp"}, result_time="timestamp", reach="horizon", frame=True),
    "volatility": View(markets.volatility, ("ticks",), ("asset_id", "timestamp"), ("asset_id",), times={"ticks": "timestamp"}, result_time="timestamp", reach="horizon", frame=True),
    "unusual_volume": View(markets.unusual_volume, ("trades",), ("trade_id",), ("asset_id",), times={"trades": "timestamp"}, result_time="timestamp", reach="horizon", frame=True),
    "price_spike": View(markets.price_spike, ("quotes",), ("asset_id", "timestamp"), ("asset_id",), times={"quotes": "timestamp"}, result_time="timestamp", reach="horizon", frame=True),
    "quiet_tight_spread": View(markets.quiet_tight_spread, ("quotes",), ("asset_id", "timestamp"), ("asset_id",), times={"quotes": "timestamp"}, result_time="timestamp", reach="horizon", frame=True),
    "spoofing_alerts": View(markets.spoofing_alerts, ("orders", "best"), ("symbol", "exchange", "window_start"), ("symbol", "exchange")),
    # marketing
    "campaign_performance": View(marketing.campaign_performance, ("events", "campaigns"), ("window_start", "campaign_id"), ("campaign_id",), keyed={"campaigns": ("campaign_id",)}),
    "channel_attribution": View(marketing.channel_attribution, ("events",), ("window_start", "channel_type", "utm_source", "utm_medium"), ("channel_type",), times={"events": "timestamp"}),
    "ab_test_results": View(marketing.ab_test_results, ("events", "campaigns", "variants"),
                            ("window_start", "campaign_id", "variant_name", "variant_type"), ("campaign_id",), ("variants",), keyed={"campaigns": ("campaign_id",), "variants": ("variant_id",)}),
    # logistics
    "demand_forecast": View(logistics.demand_forecast, ("inventory", "sales"), ("warehouse_id", "product_id"), ("warehouse_id", "product_id")),
    "recent_sales": View(logistics.recent_sales, ("sales",), ("warehouse_id", "product_id"), ("warehouse_id", "product_id")),
    "latest_orders": View(logistics.latest_orders, ("updates",), ("order_id",), ("order_id",)),
    "latest_vehicles": View(logistics.latest_vehicles, ("gps",), ("vehicle_id",), ("vehicle_id",)),
    "order_eta": Layered(logistics.order_eta, ("updates", "gps", "traffic"), _order_eta),
    # betting
    "position_overview": View(betting.position_overview, ("positions", "market"), ("position_id",), ("position_id",)),
    "market_summary": View(betting.market_summary, ("positions", "market"), ("position_id", "bookmaker"), ("position_id",)),
    "betting_patterns": View(betting.betting_patterns, ("history",), ("user_id",), ("user_id",)),
    "user_exposure": View(betting.user_exposure, ("positions",), ("user_id",), ("user_id",)),
    "high_risk_users": View(betting.high_risk_users, ("profiles", "positions", "history"), ("user_id",), ("user_id",)),
    # travel
    "meal_status": View(travel.meal_status, ("checkins", "meals"), ("flight_id", "flight_number", "class", "available_meals"), ("flight_id",)),
    "meal_shortages": View(travel.meal_shortages, ("checkins", "meals"), ("flight_id", "flight_number", "class", "available_meals"), ("flight_id",)),
    "airline_flights": View(travel.airline_flights, ("flights",), ("airline_name", "window_start"), ("airline_name",), times={"flights": "arrival_scheduled"}),
    "airport_traffic": View(travel.airport_traffic, ("flights",), ("arrival_airport", "window_start"), ("window_start",), by_window={"flights": "arrival_scheduled"}),
    "timezone_traffic": View(travel.timezone_traffic, ("flights",), ("arrival_timezone", "window_start"), ("window_start",), by_window={"flights": "arrival_scheduled"}),
    # pricing
    "minute_deltas": View(pricing.minute_deltas, ("purchases", "restocks"), ("product_id", "window_start"), ("product_id",), times={"purchases": "purchase_time", "restocks": "restock_time"}),
    "stock_status": View(pricing.stock_status, ("inventory", "purchases", "restocks"), ("product_id", "inventory_window"), ("product_id",), keyed={"inventory": ("product_id",)}),
    "clicks_per_window": View(pricing.clicks_per_window, ("clicks",), ("product_id", "window_start"), ("product_id",), times={"clicks": "event_time"}),
    "latest_competitor_prices": View(pricing.latest_competitor_prices, ("offers",), ("product_id", "competitor"), ("product_id",)),
    "lowest_competitor_price": View(pricing.lowest_competitor_price, ("offers",), ("product_id",), ("product_id",)),
    # segments: scores compare with the newest order of all users; orders are only added
    "click_behaviour": View(segments.click_behaviour, ("events",), ("user_id",), ("user_id",)),
    "rfm_scores": Layered(segments.rfm_scores, ("orders",), _rfm_scores),
    "customer_segments": Layered(segments.customer_segments, ("events", "orders"), _customer_segments),
    # energy and health
    "energy_per_house": View(energy.energy_per_house, ("consumed", "produced"), ("meter_id", "window_end"), ("meter_id",)),
    "single_alerts": View(health.single_alerts, ("vitals", "thresholds"), ("alert_id",), ("patient_id",), keyed={"thresholds": ("patient_id",)}),
    "trend_alerts": View(health.trend_alerts, ("vitals",), ("alert_id",), ("patient_id",)),
    # machines
    "machine_averages": View(machines.machine_averages, ("readings",), ("machine_id", "window_start"), ("machine_id",), times={"readings": "ts"}),
    "machine_anomalies": View(machines.machine_anomalies, ("readings",), ("machine_id", "window_start"), ("machine_id",)),
    "device_metrics": View(machines.device_metrics, ("metrics",), ("device_id", "window_start"), ("device_id",), times={"metrics": "timestamp"}),
    # sales
    "sales_per_window": View(sales.sales_per_window, ("sales", "products"), ("sale_id", "product_id", "window_start"), ("product_id",), keyed={"products": ("product_id",)}),
    "top_products": Layered(sales.top_products, ("sales", "products"), _top_products, keyed={"products": ("product_id",)}),
    "top_spenders": Layered(sales.top_spenders, ("users", "sales"), _top_spenders, keyed={"users": ("user_id",)}),
    "net_purchases": View(sales.net_purchases, ("constant", "varying"), ("customer_id",), ("customer_id",)),
    # games
    "team_figures": View(games.team_figures, ("stats",), ("window_start",), ("window_start",), by_window={"stats": "ts"}),
    "mental_states": View(games.mental_states, ("stats",), ("window_start", "mental_state"), ("mental_state",)),
    "spikes": View(games.spikes, ("stats",), ("window_start", "player_name"), ("player_name",)),
    "match_leaders": View(games.match_leaders, ("stats",), ("window_start", "match_id", "rk"), ("match_id",)),
    "impact_leaders": View(games.impact_leaders, ("stats",), ("window_start", "rn"), times={"stats": "ts"}),
    # ledger, traffic, clicks
    "block_stats": View(ledger.block_stats, ("tx",), ("slot",), ("slot",)),
    "window_stats": View(ledger.window_stats, ("tx",), ("window_start",), times={"tx": "blockTime"}),
    "road_features": View(traffic.road_features, ("sensors", "cameras"), ("road_id", "window_start"), ("road_id",), times={"sensors": "timestamp_entry", "cameras": "timestamp"}),
    "session_figures": View(clicks.session_figures, ("sessions", "events", "users", "devices"), ("session_id",), ("session_id",), ("users", "devices")),
    "conversion_funnel": View(clicks.conversion_funnel, ("views", "carts", "purchases"), ("window_start",), times={"views": "event_time", "carts": "event_time", "purchases": "event_time"}),
}


def follow(name: str, streams: Mapping[str, DataFrame], path: str, checkpoint: str, every: str | None = None,
           **options) -> tuple[MaintainedView | Layers, StreamingQuery]:
    """Keep a ready-made view up to date from its input streams."""
    view = VIEWS[name].at(path, **options)
    missing = set(VIEWS[name].inputs) - set(streams)
    if missing:
        raise ValueError(f"{name} also reads {sorted(missing)}")
    return view, view.start(streams, checkpoint, every)
