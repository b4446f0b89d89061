"""Machine telemetry and network devices: window metrics, anomalies, maintenance, history search."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import any_match, contains_any, first_match, is_true, moment, span
from tidemill.operators import page, previous, tumble

MACHINE_METRICS = (
    "winding_temperature", "ambient_temperature", "vibration_level", "current_draw", "voltage_level",
    "nominal_speed", "power_consumption", "efficiency",
)


def machine_averages(readings: DataFrame, size: str = "1 minute") -> DataFrame:
    """Average of every metric per machine and window."""
    return tumble(readings, "ts", size).groupBy("machine_id", "window_start", "window_end").agg(
        *[F.avg(m).alias(f"avg_{m}") for m in MACHINE_METRICS])


# Watched metrics as (reading, result suffix of the mean, result
# suffix of spread and peak, outlier label, trend label), most important first.
WATCHED = (
    ("winding_temperature", "winding_temp", "winding_temp", "Anomalous Winding Temperature", "Rising Winding Temperature"),
    ("vibration_level", "vibration", "vibration", "Anomalous Vibration Level", "Increasing Vibration"),
    ("current_draw", "current_draw", "current_draw", "Anomalous Current Draw", "Rising Current Draw"),
    ("voltage_level", "voltage_level", "voltage_level", "Anomalous Voltage Level", "Rising Voltage Level"),
    ("power_consumption", "power_consumption", "power_consumption", "Anomalous Power Consumption",
     "Rising Power Consumption"),
)


def machine_anomalies(readings: DataFrame, size: str = "1 minute", outlier_sigmas: float = 3,
                      trend_sigmas: float = 2) -> DataFrame:
    """Windows with a peak beyond ``outlier_sigmas`` or a mean rising by ``trend_sigmas``.

    The label and the filter come from one rule list, so they cannot disagree.
    """
    aggs = []
    for source, mean, spread, _, _ in WATCHED:
        aggs += [F.avg(source).alias(f"avg_{mean}"), F.stddev_pop(source).alias(f"stddev_{spread}"),
                 F.max(source).alias(f"max_{spread}")]
    stats = tumble(readings, "ts", size).groupBy("machine_id", "window_start", "window_end").agg(*aggs)
    stats = previous(stats, ["machine_id"], "window_end", {f"_prev_{m}": f"avg_{m}" for _, m, _, _, _ in WATCHED})
    peaks = [(F.col(f"max_{s}") > F.col(f"avg_{m}") + outlier_sigmas * F.col(f"stddev_{s}"), label)
             for _, m, s, label, _ in WATCHED]
    rises = [(F.col(f"avg_{m}") - F.col(f"_prev_{m}") > trend_sigmas * F.col(f"stddev_{s}"), label)
             for _, m, s, _, label in WATCHED]
    rules = peaks + rises
    return (
        stats.filter(any_match(rules)).withColumn("anomaly_alert", first_match(rules, "Normal"))
        .drop(*[f"_prev_{m}" for _, m, _, _, _ in WATCHED]).orderBy(F.desc("window_end"))
    )


# Maintenance margins over the machine's own history.
TEMPERATURE_MARGIN, VIBRATION_MARGIN, CURRENT_MARGIN, EFFICIENCY_MARGIN = 5, 0.1, 2, 5
COMPARED = {"winding_temperature": "avg_winding_temp", "vibration_level": "avg_vibration",
            "current_draw": "avg_current_draw", "power_consumption": "avg_power_consumption",
            "efficiency": "avg_efficiency"}


def maintenance_alerts(readings: DataFrame, as_of: Column | str | None = None, settled: str = "5 minutes",
                       size: str = "1 minute") -> DataFrame:
    """Windows that drift from the machine's history (everything older than ``settled``)."""
    past = readings.filter(F.col("ts") < moment(as_of) - span(settled)).groupBy("machine_id").agg(
        *[F.avg(c).alias(f"_h_{n}") for c, n in COMPARED.items()])
    recent = tumble(readings, "ts", size).groupBy("machine_id", "window_start", "window_end").agg(
        *[F.avg(c).alias(n) for c, n in COMPARED.items()])
    now, was = F.col, lambda n: F.col(f"_h_{n}")
    rules = [
        (now("avg_winding_temp") > was("avg_winding_temp") + TEMPERATURE_MARGIN, "Potential Overheating"),
        (now("avg_vibration") > was("avg_vibration") + VIBRATION_MARGIN, "Increased Vibration"),
        (now("avg_current_draw") > was("avg_current_draw") + CURRENT_MARGIN, "Possible overcurrent condition"),
        (now("avg_efficiency") < was("avg_efficiency") - EFFICIENCY_MARGIN, "Efficiency Drop"),
    ]
    return recent.join(past, "machine_id").filter(any_match(rules)).select(
        "machine_id", "window_start", "window_end", *COMPARED.values(),
        first_match(rules, "Normal").alias("maintenance_alert")).orderBy(F.desc("window_end"))


# -- network devices ------------------------------------------------------------------------

# Anomaly limits per averaged metric.
LATENCY_LIMIT_MS, LOSS_LIMIT_PERCENT, BANDWIDTH_LIMIT_PERCENT = 100, 5, 90
ANOMALY_FLAGS = {"latency": "is_high_latency", "loss": "is_high_packet_loss", "bandwidth": "is_bandwidth_saturation"}


def device_metrics(metrics: DataFrame, size: str = "10 seconds") -> DataFrame:
    return tumble(metrics, "timestamp", size).groupBy("device_id", "window_start", "window_end").agg(
        F.avg("latency_ms").alias("avg_latency_ms"), F.avg("packet_loss_rate").alias("avg_packet_loss_rate"),
        F.avg("bandwidth_usage_percent").alias("avg_bandwidth_usage"), F.sum("flow_bytes").alias("total_flow_bytes"))


def network_anomalies(windows: DataFrame) -> DataFrame:
    """Windows over at least one limit, one flag per limit (NULL where the metric is missing)."""
    flagged = windows.select(
        "device_id", "window_start", "window_end", "avg_latency_ms", "avg_packet_loss_rate", "avg_bandwidth_usage",
        (F.col("avg_latency_ms") > LATENCY_LIMIT_MS).alias("is_high_latency"),
        (F.col("avg_packet_loss_rate") > LOSS_LIMIT_PERCENT).alias("is_high_packet_loss"),
        (F.col("avg_bandwidth_usage") > BANDWIDTH_LIMIT_PERCENT).alias("is_bandwidth_saturation"))
    return flagged.filter(any_match([(F.col(f), None) for f in ANOMALY_FLAGS.values()]))


def utc_instant(text: str, zone: str) -> datetime:
    """ISO time as naive UTC; a time without zone is local to ``zone``."""
    at = datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    at = at if at.tzinfo else at.replace(tzinfo=ZoneInfo(zone))
    return at.astimezone(timezone.utc).replace(tzinfo=None)


def search_anomalies(history: DataFrame, keyword: str | None = None, since: str | None = None,
                     until: str | None = None, types: Sequence[str] = (), newest_first: bool = True,
                     limit: int = 15, offset: int = 0, zone: str = "Asia/Singapore") -> DataFrame:
    """One page of the anomaly history with the total count; no type chosen finds nothing.

    Stored window times are local to ``zone``.  Every filter is pushed into the
    scan of the history; nothing is read to the driver.
    """
    at = F.to_utc_timestamp(F.col("window_start").cast("timestamp"), zone)
    found = history.filter(F.col("window_start").isNotNull())
    if keyword:
        found = found.filter(contains_any(["device_id", "window_start"], keyword))
    if since:
        found = found.filter(at >= F.lit(utc_instant(since, zone)))
    if until:
        found = found.filter(at <= F.lit(utc_instant(until, zone)))
    flags = [is_true(F.col(ANOMALY_FLAGS[t])) for t in types if t in ANOMALY_FLAGS]
    found = found.filter(reduce(lambda a, b: a | b, flags) if flags else F.lit(False))
    first = F.col("window_start").desc() if newest_first else F.col("window_start").asc()
    return page(found, [first, F.col("device_id").asc()], limit, offset)
