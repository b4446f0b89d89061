"""Patient monitoring: single and trend alerts, unified alerts, alert desk queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import (
    any_match, code_label, concat_text, first_match, int_div, moment, round_numeric, slot, span, stable_id, time_text,
)
from tidemill.operators import count_where, distinct_where, first_by, last_by, latest_by, tumble, update_where

# Default thresholds of a patient row that leaves them out.
THRESHOLD_DEFAULTS = {
    "heart_rate_min": 50, "heart_rate_max": 120, "blood_oxygen_min": 93.00,
    "blood_glucose_min": 3.90, "blood_glucose_max": 7.20, "update_by": "admin",
}
TREND_ALERT = "multi_vital_signs_deterioration"  # fixed value: name of the trend alert


def single_alerts(vitals: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Level 1: one reading outside the patient's own limits.

    Each limit is one entry of a rule list; the type, the text and the filter
    are all generated from it.
    """
    limits = [
        ("heart_rate", "low", "Heart rate too low: ", " bpm"),
        ("heart_rate", "high", "Heart rate too high: ", " bpm"),
        ("blood_oxygen", "low", "Blood oxygen too low: ", "%"),
        ("blood_glucose", "low", "Blood glucose too low: ", " mmol/L"),
        ("blood_glucose", "high", "Blood glucose too high: ", " mmol/L"),
    ]

    def broken(sign: str, side: str) -> Column:
        return F.col(sign) < F.col(f"{sign}_min") if side == "low" else F.col(sign) > F.col(f"{sign}_max")

    kinds = [(broken(sign, side), sign) for sign, side, _, _ in limits]
    texts = [(broken(sign, side), concat_text(F.lit(lead), sign, F.lit(unit))) for sign, side, lead, unit in limits]
    bounds = thresholds.select("patient_id", "heart_rate_min", "heart_rate_max", "blood_oxygen_min",
                               "blood_glucose_min", "blood_glucose_max")
    return vitals.join(bounds, "patient_id").filter(any_match(kinds)).select(
        "patient_id", "measure_time", first_match(kinds).alias("alert_type"), first_match(texts).alias("alert_detail"),
        F.lit("level1").alias("alert_level"), stable_id("patient_id", time_text("measure_time")).alias("alert_id"))


def trend_alerts(vitals: DataFrame, size: str = "10 minutes", pulse_rise: int = 20, oxygen_drop: int = 5) -> DataFrame:
    """Level 2: pulse up and oxygen down between the first and last reading of a window."""
    at = "measure_time"
    trend = tumble(vitals, at, size).groupBy("patient_id", "window_end").agg(
        (last_by("heart_rate", at) - first_by("heart_rate", at)).alias("heart_rate_increase"),
        (first_by("blood_oxygen", at) - last_by("blood_oxygen", at)).alias("blood_oxygen_decrease"))
    return trend.filter((F.col("heart_rate_increase") >= pulse_rise) & (F.col("blood_oxygen_decrease") >= oxygen_drop)).select(
        "patient_id", F.col("window_end").alias("measure_time"), F.lit(TREND_ALERT).alias("alert_type"),
        "heart_rate_increase", "blood_oxygen_decrease", F.lit("level2").alias("alert_level"),
        stable_id("patient_id", time_text("window_end"), F.lit(TREND_ALERT)).alias("alert_id"))


def unified_alerts(single: DataFrame, trend: DataFrame, within: str = "30 seconds", literal_key: bool = False) -> DataFrame:
    """All alerts, one per patient, type and time slot: the latest.

    ``literal_key=True`` uses the key ``second - 30 s * (second / 30)`` of the
    time, under which :05 and :35 of a minute meet, instead of a true floor.
    """
    detail = concat_text(F.lit("Heart rate increased by "), "heart_rate_increase",
                         F.lit(" bpm and blood oxygen decreased by "), "blood_oxygen_decrease", F.lit("% in 10 minutes"))
    both = single.unionByName(trend.withColumn("alert_detail", detail).select(single.columns))
    both = both.withColumnRenamed("measure_time", "alert_time")
    if literal_key:
        seconds = F.round(F.extract(F.lit("SECOND"), "alert_time"), 0).cast("bigint")
        key = F.unix_seconds(F.date_trunc("second", "alert_time")) - 30 * int_div(seconds, F.lit(30))
    else:
        key = slot("alert_time", within)
    return latest_by(both, ["patient_id", "alert_type", key], ["alert_time", "alert_id"]).select(
        "patient_id", "alert_time", "alert_type", "alert_detail", "alert_level", "alert_id")


# -- alert desk -----------------------------------------------------------------------------

# Display labels.
TYPE_LABELS = {
    "heart_rate": "Heart Rate Abnormality", "blood_oxygen": "Blood Oxygen Abnormality",
    "blood_glucose": "Blood Glucose Abnormality", TREND_ALERT: "Multi-index Deterioration",
}
LEVEL_LABELS = {"level1": "Level 1 (Warning)", "level2": "Level 2 (Critical)"}
STATUS_LABELS = {"pending": "Pending", "confirmed": "Confirmed", "resolved": "Resolved"}


def alert_stats(alerts: DataFrame, as_of: Column | str | None = None, within: str = "12 hours") -> DataFrame:
    """Counts per level and status, handling rates and the 10-minute pending trend, in one pass."""
    level, status, at = F.col("alert_level"), F.col("handle_status"), F.col("alert_time")
    now = moment(as_of)
    n = alerts.filter(at >= now - span(within)).agg(
        F.count_distinct("alert_id").alias("total_alerts"),
        *[count_where(level == k).alias(f"{k}_count") for k in LEVEL_LABELS],
        *[count_where(status == k).alias(f"{k}_count") for k in STATUS_LABELS],
        distinct_where((status == "pending") & (at <= now - span("10 minutes")), "alert_id").alias("_before"))
    open_alerts = F.col("total_alerts") - F.col("resolved_count")
    trend = F.col("pending_count") - F.col("_before")
    percent = lambda part, whole: F.when(whole > 0, round_numeric(
        F.col(part).cast("decimal(20,0)") / whole.cast("decimal(20,0)") * 100, 1)).otherwise(F.lit(0).cast("decimal(38,1)"))
    return n.withColumns({
        "confirmed_rate": percent("confirmed_count", open_alerts),
        "resolved_rate": percent("resolved_count", F.col("total_alerts")),
        "pending_trend": F.concat(F.when(trend >= 0, "+").otherwise(""), trend.cast("string")),
    }).drop("_before")


def alert_list(alerts: DataFrame, level: str = "all", status: str = "all", as_of: Column | str | None = None,
               within: str = "12 hours") -> DataFrame:
    """Alerts of the period with display labels, newest first."""
    chosen = alerts.filter(F.col("alert_time") >= moment(as_of) - span(within))
    if level != "all":
        chosen = chosen.filter(F.col("alert_level") == level)
    if status != "all":
        chosen = chosen.filter(F.col("handle_status") == status)
    return chosen.withColumns({
        "alert_type_text": code_label("alert_type", TYPE_LABELS, "Unknown"),
        "alert_level_text": code_label("alert_level", LEVEL_LABELS, "Unknown"),
        "handle_status_text": code_label("handle_status", STATUS_LABELS, "Pending"),
    }).orderBy(F.desc("alert_time"), "alert_id")


def set_alert_status(alerts: DataFrame, handled: DataFrame) -> DataFrame:
    """Apply status changes ``(alert_id, handle_status, handle_time)`` to the alert table; the last of an alert wins."""
    allowed = handled.filter(F.col("handle_status").isin("confirmed", "resolved"))
    return update_where(alerts, allowed, ["alert_id"], ["handle_status", "handle_time"], ["handle_time", "handle_status"])
