"""Customer segmentation: click and order behaviour, RFM and activity scores, segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import first_match, moment, span, step_score
from tidemill.operators import count_where

# Score thresholds, best first; anything below scores 1.
RECENCY_STEPS = (("3 days", 5), ("10 days", 4), ("30 days", 3), ("60 days", 2))
FREQUENCY_STEPS = ((15, 5), (8, 4), (5, 3), (2, 2))
MONETARY_STEPS = ((5000, 5), (2500, 4), (1000, 3), (200, 2))
BROWSE_STEPS = ((30, 5), (15, 4), (8, 3), (2, 2))
INTENT_STEPS = ((10, 5), (7, 4), (4, 3), (2, 2))


def click_behaviour(events: DataFrame, as_of: Column | str | None = None, months: int = 2) -> DataFrame:
    """Views, carts and purchases per user over the last calendar months."""
    kind = F.col("event_type")
    since = moment(as_of) - F.expr(f"INTERVAL '{int(months)}' MONTH")
    return events.filter(F.col("event_time") >= since).groupBy("user_id").agg(
        *[count_where(kind == k).alias(f"{k}_count") for k in ("view", "cart", "purchase")])


def user_orders(orders: DataFrame) -> DataFrame:
    """Order totals and the last order of each user."""
    return orders.groupBy("user_id").agg(
        count_where(F.col("order_status") == "completed").alias("completed_orders"),
        F.sum("price").alias("total_spent"), F.max("order_time").alias("last_order_time"))


def order_behaviour(orders: DataFrame) -> DataFrame:
    """Order totals per user beside the latest order time of all users (a scalar subquery)."""
    return user_orders(orders).withColumn("max_order_time", orders.agg(F.max("order_time")).scalar())


def rfm_points(behaviour: DataFrame, *carried: str) -> DataFrame:
    """Recency, frequency and monetary scores, 1 to 5, of order behaviour; ``carried`` columns go along."""
    idle = F.col("max_order_time") - F.col("last_order_time")
    return behaviour.select(
        *carried, "user_id",
        step_score(idle, [(span(limit), points) for limit, points in RECENCY_STEPS], descending=True).alias("r_score"),
        step_score("completed_orders", FREQUENCY_STEPS).alias("f_score"),
        step_score("total_spent", MONETARY_STEPS).alias("m_score"))


def rfm_scores(orders: DataFrame) -> DataFrame:
    """Recency, frequency and monetary scores per user."""
    return rfm_points(order_behaviour(orders))


def behaviour_scores(events: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    return click_behaviour(events, as_of).select(
        "user_id", step_score("view_count", BROWSE_STEPS).alias("browse_score"),
        step_score("cart_count", INTENT_STEPS).alias("intent_score"))


def customer_segments(events: DataFrame, orders: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Segment per active user, from clicks and orders."""
    return segments_of(events, rfm_scores(orders), as_of)


def segments_of(events: DataFrame, scores: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Segment per active user, from clicks and RFM scores.

    Users without orders have no scores.  Some rules compare the raw score, so
    they fail on NULL; others read a missing score as 1.
    """
    r, f, m = F.col("_r"), F.col("_f"), F.col("_m")
    low_r, low_f = F.coalesce(r, F.lit(1)) <= 2, F.coalesce(f, F.lit(1)) <= 2
    browse, intent = F.col("browse_score"), F.col("intent_score")
    rules = [
        ((r >= 4) & (f >= 4) & (m >= 4) & (browse >= 3), "ACTIVE"),
        ((r >= 4) & (f == 1), "NEW"),
        ((browse >= 4) & (intent >= 3) & low_r, "HIGH_POTENTIAL"),
        (low_r & (m >= 4), "DORMANT_HIGH_VALUE"),
        ((r >= 2) & (f >= 2) & (m >= 2), "AVERAGE_ACTIVE"),
        (low_r & low_f, "CHURNED"),
    ]
    scores = scores.withColumnsRenamed({"r_score": "_r", "f_score": "_f", "m_score": "_m"})
    return behaviour_scores(events, as_of).join(scores, "user_id", "left").select(
        "user_id", "browse_score", "intent_score", *[F.coalesce(f"_{k}", F.lit(1)).alias(f"{k}_score") for k in "rfm"],
        first_match(rules, "OTHER").alias("segment"))


def segment_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("user_count")).orderBy("segment")
