"""Marketing: campaign performance, channel attribution, A/B tests, dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import ratio
from tidemill.operators import distinct_per_kind, distinct_where, sum_where, tumble


# Result column per kind of event.
FUNNEL = {"impressions": "impression", "clicks": "click", "conversions": "conversion"}


def _funnel(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct events per kind and conversion revenue."""
    return distinct_per_kind(rows, keys, "event_type", "event_id", FUNNEL, {"revenue": ("conversion", "amount")})


def campaign_performance(events: DataFrame, campaigns: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Impressions, clicks, conversions, revenue and rates per campaign and window."""
    named = campaigns.select("campaign_id", "campaign_name", "campaign_type")
    rows = tumble(events, "timestamp", size).join(named, "campaign_id")
    out = _funnel(rows, ["window_start", "window_end", "campaign_id", "campaign_name", "campaign_type"])
    return out.withColumns({"ctr": ratio("clicks", "impressions"), "conversion_rate": ratio("conversions", "clicks")})


def channel_attribution(events: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Users, conversions, revenue and order value per channel, source, medium and window."""
    out = tumble(events, "timestamp", size).groupBy(
        "window_start", "window_end", "channel_type", "utm_source", "utm_medium").agg(
        F.count_distinct("user_id").alias("unique_users"),
        distinct_where(F.col("event_type") == "conversion", "event_id").alias("conversions"),
        sum_where(F.col("event_type") == "conversion", "amount").alias("revenue"))
    return out.withColumn("avg_order_value", ratio("revenue", "conversions"))


def ab_test_results(events: DataFrame, campaigns: DataFrame, variants: DataFrame,
                    size: str = "5 minutes") -> DataFrame:
    """Results per test campaign and variant; only events that carry a variant count."""
    tests = campaigns.filter(F.col("campaign_type") == "ab_test").select("campaign_id", "campaign_name")
    arms = variants.select("variant_id", "variant_name", "variant_type")
    rows = tumble(events.filter(F.col("variant_id").isNotNull()), "timestamp", size).join(tests, "campaign_id").join(
        arms, "variant_id")
    out = _funnel(rows, ["window_start", "window_end", "campaign_id", "campaign_name", "variant_name", "variant_type"])
    return out.withColumn("conversion_rate", ratio("conversions", "clicks"))


def chart_series(df: DataFrame, ts: str, grain: str, by: str, metric: Column, name: str) -> DataFrame:
    """One dashboard chart: a metric per time grain and dimension."""
    return df.groupBy(F.window(ts, grain)["start"].alias("time_slot"), by).agg(metric.alias(name))


def events_over_time(events: DataFrame, grain: str = "1 minute") -> DataFrame:
    return chart_series(events, "timestamp", grain, "event_type", F.count("event_id"), "total_events")


def revenue_over_time(performance: DataFrame, grain: str = "1 minute") -> DataFrame:
    return chart_series(performance, "window_start", grain, "campaign_id", F.sum("revenue"), "revenue_over_time")


def revenue_by_channel(attribution: DataFrame, grain: str = "1 hour") -> DataFrame:
    return chart_series(attribution, "window_start", grain, "channel_type", F.sum("revenue"), "revenue_by_channel")


def conversion_by_variant(results: DataFrame, grain: str = "1 hour") -> DataFrame:
    return chart_series(results, "window_start", grain, "variant_name", F.avg("conversion_rate"),
                        "average_conversion_rate")
