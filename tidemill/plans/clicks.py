"""Clickstream: enrichment, session figures, live queries, conversion funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import moment, ratio, round_numeric, seconds_between, span
from tidemill.operators import count_where, in_window_counts, latest_by, sum_where, top_k, zero_filled


def _current(dimension: DataFrame, key: str) -> DataFrame:
    """Dimensions are re-sent without a key; the last version sent is the current one."""
    return latest_by(dimension, [key], ["ingested_at"])


def enriched_clicks(events: DataFrame, users: DataFrame, sessions: DataFrame, devices: DataFrame,
                    pages: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Every event with its user, session, device, page and campaign, where known."""
    who = _current(users, "user_id").select("user_id", "full_name", "country", "marketing_opt_in")
    visit = _current(sessions, "session_id").select(
        "session_id", F.col("session_id").alias("_session"), "session_start", "geo_city", "geo_region", "device_id")
    gear = _current(devices, "device_id").select("device_id", "device_type", "os", "browser")
    where = _current(pages, "page_url").select("page_url", "page_category", "product_id", "product_category")
    source = _current(campaigns, "campaign_id").select(
        "campaign_id", F.col("source").alias("campaign_source"), F.col("medium").alias("campaign_medium"),
        F.col("campaign").alias("campaign_name"), F.col("content").alias("campaign_content"),
        F.col("term").alias("campaign_term"))
    joined = (
        events.join(who, "user_id", "left").join(visit, "session_id", "left").join(gear, "device_id", "left")
        .join(where, "page_url", "left").join(source, "campaign_id", "left")
    )
    return joined.select(
        "event_id", "event_time", events["ingested_at"], "event_type", "user_id", "full_name", "country",
        "marketing_opt_in", F.col("_session").alias("session_id"), "session_start", "geo_city", "geo_region",
        "device_type", "os", "browser", "page_url", "page_category", "product_id", "product_category", "element_id",
        "referrer", "campaign_source", "campaign_medium", "campaign_name", "campaign_content", "campaign_term",
        "revenue_usd")


def session_figures(sessions: DataFrame, events: DataFrame, users: DataFrame, devices: DataFrame) -> DataFrame:
    """Engagement and conversion per session.

    Events are aggregated by session before the joins: one row per session is
    shuffled on, and sessions without events keep zeros.
    """
    kinds = {"page_view": "page_views", "click": "clicks", "add_to_cart": "add_to_cart",
             "checkout_start": "checkout_start", "purchase": "purchases"}
    acted = events.groupBy("session_id").agg(
        F.min("event_time").alias("first_event_time"), F.max("event_time").alias("last_event_time"),
        *[sum_where(F.col("event_type") == kind, F.lit(1)).alias(name) for kind, name in kinds.items()],
        F.sum("revenue_usd").alias("_revenue"))
    who = _current(users, "user_id").select("user_id", "country")
    gear = _current(devices, "device_id").select("device_id", "device_type")
    base = _current(sessions, "session_id").select("session_id", "user_id", "device_id")
    joined = base.join(acted, "session_id", "left").join(who, "user_id", "left").join(gear, "device_id", "left")
    done = lambda name: F.coalesce(F.col(name) > 0, F.lit(False))
    return joined.select(
        "session_id", "user_id", "country", "device_type", "first_event_time", "last_event_time",
        seconds_between("first_event_time", "last_event_time").alias("session_duration_seconds"),
        *[zero_filled(F.col(name)).alias(name) for name in kinds.values()],
        zero_filled(F.col("_revenue")).alias("revenue_usd"),
        done("add_to_cart").alias("did_add_to_cart"), done("purchases").alias("did_purchase"))


def live_traffic(events: DataFrame, as_of: Column | str | None = None, within: str = "5 minutes",
                 grain: str = "minute") -> DataFrame:
    """Events, purchases and revenue per minute of the recent past, newest first."""
    return events.filter(F.col("event_time") > moment(as_of) - span(within)).groupBy(
        F.date_trunc(grain, "event_time").alias("minute")).agg(
        F.count(F.lit(1)).alias("events"), sum_where(F.col("event_type") == "purchase", F.lit(1)).alias("purchases"),
        F.sum(F.coalesce("revenue_usd", F.lit(0))).alias("revenue")).orderBy(F.desc("minute"))


def top_pages(clicks: DataFrame, as_of: Column | str | None = None, within: str = "10 minutes", n: int = 10) -> DataFrame:
    seen = clicks.filter((F.col("event_type") == "page_view") & (F.col("event_time") > moment(as_of) - span(within)))
    return top_k(seen.groupBy("page_url").agg(F.count(F.lit(1)).alias("views")), [F.desc("views"), F.asc("page_url")], n)


def conversion_by_device(figures: DataFrame) -> DataFrame:
    out = figures.groupBy("device_type").agg(
        count_where(F.col("did_purchase")).alias("converted_sessions"), F.count(F.lit(1)).alias("sessions"))
    rate = F.try_divide((F.col("converted_sessions") * 100).cast("decimal(20,0)"), F.col("sessions").cast("decimal(20,0)"))
    return out.withColumn("conversion_rate_pct", round_numeric(rate, 2)).orderBy(F.desc("conversion_rate_pct"))


def conversion_funnel(views: DataFrame, carts: DataFrame, purchases: DataFrame, size: str = "1 minute") -> DataFrame:
    """Viewers, those who also put into the cart, and those who also bought, per window."""
    counted = in_window_counts(views, {"carters": (carts, "event_time"), "purchasers": (purchases, "event_time")},
                               "event_time", "user_id", size, "viewers")
    rate = lambda part, whole: F.coalesce(round_numeric(ratio(part, whole), 2), F.lit(0).cast("decimal(38,2)"))
    return counted.select("window_start", "viewers", "carters", "purchasers",
                          rate("carters", "viewers").alias("view_to_cart_rate"),
                          rate("purchasers", "carters").alias("cart_to_buy_rate"))
