"""Website visits, user actions, page edits (page counts, enrichment, log metrics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators import count_where, exact_median, key_join, sum_where, top_n, tumble


def page_visits(visits: DataFrame) -> DataFrame:
    """Visits, unique visitors and last visit per page."""
    return visits.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("total_visits"),
        F.count_distinct("user_id").alias("unique_visitors"),
        F.max("timestamp").alias("last_visit_time"),
    )


def visits_with_users(visits: DataFrame, users: DataFrame) -> DataFrame:
    """Visits of known users, with name and age."""
    return visits.join(users, visits["user_id"] == users["id"]).select(
        "timestamp", "user_id", F.col("name").alias("user_name"), F.col("age").alias("user_age"),
        "page_id", "action")


def popular_pages(visits: DataFrame, users: DataFrame, under_age: int = 35, n: int = 3) -> DataFrame:
    """The ``n`` pages with most distinct visitors below an age; page_id settles ties."""
    counted = (
        visits_with_users(visits, users).filter(F.col("user_age") < under_age)
        .groupBy("page_id").agg(F.count_distinct("user_id").alias("total_visits"))
    )
    return counted.orderBy(F.desc("total_visits"), "page_id").limit(n)


def city_average_age(users: DataFrame, at_least: float = 21) -> DataFrame:
    """Average age of the cities that reach ``at_least``."""
    return users.groupBy("city").agg(F.avg("age").alias("avg_age")).filter(F.col("avg_age") >= at_least)


def actions_per_window(visits: DataFrame, users: DataFrame, size: str = "3 minutes") -> DataFrame:
    """Actions per user, page and window, with the user's names where known."""
    counted = tumble(visits, "action_time", size).groupBy("user_id", "page_id", "window_end").agg(
        F.count("action").alias("num_actions"))
    return counted.join(users, "user_id", "left").select(
        "user_id", "first_name", "last_name", "age", "page_id", "num_actions", "window_end")


# -- request logs ----------------------------------------------------------------

def user_request_metrics(logs: DataFrame, size: str = "1 minute") -> DataFrame:
    """Requests, response times with exact median, errors and sessions per user and window."""
    framed = tumble(logs, "request_timestamp", size)
    keys = ["username", "window_start", "window_end"]
    stats = framed.groupBy(*keys).agg(
        F.count("username").alias("total_requests"),
        F.min("response_time").alias("min_response_time"),
        F.max("response_time").alias("max_response_time"),
        F.avg("response_time").alias("avg_response_time"),
        sum_where(F.col("status_code") >= 400, F.lit(1)).alias("total_errors"),
        sum_where(F.col("user_action") == "login", F.lit(1)).alias("login_count"),
        sum_where(F.col("user_action") == "logout", F.lit(1)).alias("logout_count"),
        F.count_distinct("ip_address").alias("unique_ips"),
    )
    median = exact_median(framed, keys, "response_time", "median_response_time")
    return key_join(stats, median, keys, "left")


def top_actions(logs: DataFrame, size: str = "1 minute", n: int = 5) -> DataFrame:
    """The most frequent user actions of each window, busiest first."""
    counted = tumble(logs, "request_timestamp", size).groupBy("user_action", "window_start", "window_end").agg(
        F.count("user_action").alias("count_user_activity"))
    ranked = top_n(counted, ["window_start", "window_end"],
                   [F.desc("count_user_activity"), F.asc("user_action")], n, "action_rank")
    return ranked.orderBy("window_start", "action_rank").drop("action_rank")


# The action names that make up each class of referrer activity.
ACTION_CLASSES = {
    "page_visits": ("view_page", "navigate_page"),
    "interactions": ("submit_form", "login", "logout"),
    "content_interactions": ("scroll_page", "download_file", "upload_file"),
    "window_interactions": ("close_window", "open_new_tab"),
}


def referrer_activity(logs: DataFrame, size: str = "1 minute", classes=None) -> DataFrame:
    """Visits per referrer and window, split into classes of action."""
    classes = classes or ACTION_CLASSES
    return tumble(logs, "request_timestamp", size).groupBy("referrer", "window_start", "window_end").agg(
        F.count("referrer").alias("referrer_visit_count"),
        *[sum_where(F.col("user_action").isin(*names), F.lit(1)).alias(c) for c, names in classes.items()])


def status_distribution(logs: DataFrame, size: str = "1 minute") -> DataFrame:
    """Status codes per window with cumulative count and percentage."""
    counted = tumble(logs, "request_timestamp", size).groupBy("status_code", "window_start", "window_end").agg(
        F.count("status_code").alias("count_status_code"), F.avg("response_time").alias("avg_response_time"))
    whole = Window.partitionBy("window_start", "window_end")
    running = F.sum("count_status_code").over(whole.orderBy("status_code"))
    return counted.select(
        "status_code", "count_status_code", "avg_response_time", running.alias("cumulative_count"),
        (F.lit(100.0) * running / F.sum("count_status_code").over(whole)).alias("cumulative_percentage"),
        "window_start", "window_end",
    ).orderBy(F.desc("window_start"), "status_code")


# -- page edits ----------------------------------------------------------------------

def clean_edits(edits: DataFrame) -> DataFrame:
    """Edits typed and without the rows that lack a time, registration or edit count."""
    return edits.filter(
        F.col("edit_timestamp").isNotNull() & F.col("registration").isNotNull() & F.col("edit_count").isNotNull()
    ).select(
        "contributor", "title", F.col("edit_timestamp").cast("timestamp_ntz"),
        F.col("registration").cast("timestamp_ntz"), "gender", F.col("edit_count").cast("int").alias("edit_count"))


def _edit_split(edits: DataFrame, size: str, **parts) -> DataFrame:
    return tumble(edits, "edit_timestamp", size).groupBy("window_start", "window_end").agg(
        F.count(F.lit(1)).alias("total_contributions"),
        *[count_where(cond).alias(name) for name, cond in parts.items()])


def edits_by_gender(edits: DataFrame, size: str = "1 minute") -> DataFrame:
    gender = F.col("gender")
    return _edit_split(edits, size, contributions_by_unknown=gender == "unknown",
                       contributions_by_male_or_female=gender != "unknown")


def edits_by_registration(edits: DataFrame, size: str = "1 minute",
                          border: str = "2020-01-01 01:00:00") -> DataFrame:
    since, at = F.col("registration"), F.lit(border).cast("timestamp_ntz")
    return _edit_split(edits, size, contributions_by_someone_registered_before_2020=since < at,
                       contributions_by_someone_registered_after_2020=since > at)


def edits_by_experience(edits: DataFrame, size: str = "1 minute", border: int = 1000) -> DataFrame:
    n = F.col("edit_count")
    return _edit_split(edits, size, contributions_less_than_1000=n < border,
                       contributions_1000_or_more=n >= border)
