"""Household energy: net use, monthly totals, tiered and time-of-use bills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import days_in_month, tiered_charge
from tidemill.operators import tumble

# Tariffs.
TIER_LIMIT, TIER_RATE, OVER_RATE = 200, 0.2, 0.4
PEAK_FIRST_HOUR, PEAK_LAST_HOUR, PEAK_RATE, OFF_PEAK_RATE = 16, 20, 0.4, 0.2


def energy_per_house(consumed: DataFrame, produced: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Consumed, produced and net energy per meter and window (meters seen on both sides)."""
    used = tumble(consumed, "consumption_time", size).groupBy("meter_id", "window_end").agg(
        F.sum("energy_consumed").alias("energy_consumed"))
    made = tumble(produced, "production_time", size).groupBy("meter_id", "window_end").agg(
        F.sum("energy_produced").alias("energy_produced"))
    return used.join(made, ["meter_id", "window_end"]).select(
        "meter_id", "energy_consumed", "energy_produced",
        (F.col("energy_consumed") - F.col("energy_produced")).alias("total_energy"), "window_end")


def _month() -> Column:
    return F.date_trunc("month", "window_end").alias("month")


def _year() -> Column:
    return F.date_trunc("year", "window_end").alias("year")


def energy_per_month(per_house: DataFrame) -> DataFrame:
    """A window belongs to the month of its end, so a month's last window counts in the next."""
    return per_house.groupBy("meter_id", _month(), _year()).agg(F.sum("total_energy").alias("total_energy"))


def meters_on_plan(per_house: DataFrame, customers: DataFrame, plan: str) -> DataFrame:
    """Net energy of the meters on a price plan (``tier`` or ``time of use``)."""
    chosen = customers.filter(F.col("price_plan") == plan).select("meter_id")
    return per_house.join(chosen, "meter_id").select("meter_id", "total_energy", "window_end")


def _closed_days(meters: DataFrame, per_house: DataFrame) -> DataFrame:
    """Rows before the latest day seen anywhere."""
    latest = per_house.agg(F.max(F.date_trunc("day", "window_end")))
    return meters.filter(F.date_trunc("day", "window_end") < latest.scalar())


def _tier_cost(amount: str) -> Column:
    return tiered_charge(amount, TIER_LIMIT, TIER_RATE, OVER_RATE)


def tiered_bill(tier_meters: DataFrame) -> DataFrame:
    """Bill so far this month on the two-tier plan."""
    monthly = tier_meters.groupBy("meter_id", _month(), _year()).agg(F.sum("total_energy").alias("_energy"))
    return monthly.select("meter_id", _tier_cost("_energy").alias("current_bill"), "month", "year")


def projected_tiered_bill(tier_meters: DataFrame, per_house: DataFrame) -> DataFrame:
    """Month-end bill on the two-tier plan at the average daily use so far."""
    monthly = _closed_days(tier_meters, per_house).groupBy("meter_id", _month()).agg(
        F.sum("total_energy").alias("_sum"), F.dayofmonth(F.max("window_end")).alias("_days"))
    out = monthly.withColumn("estimated_total_energy", F.col("_sum") / F.col("_days") * days_in_month("month"))
    return out.select("meter_id", _tier_cost("estimated_total_energy").alias("estimated_total_bill"),
                      "estimated_total_energy", "month")


def _tou_cost(hour: Column) -> Column:
    peak = hour.between(PEAK_FIRST_HOUR, PEAK_LAST_HOUR)
    return F.when(peak, F.col("total_energy") * PEAK_RATE).otherwise(F.col("total_energy") * OFF_PEAK_RATE)


def time_of_use_bill(tou_meters: DataFrame) -> DataFrame:
    """Bill so far this month on the time-of-use plan."""
    return tou_meters.groupBy("meter_id", _month(), _year()).agg(
        F.sum(_tou_cost(F.hour("window_end"))).alias("monthly_cost"))


def projected_time_of_use_bill(tou_meters: DataFrame, per_house: DataFrame) -> DataFrame:
    """Month-end bill on the time-of-use plan at the average daily use so far."""
    monthly = _closed_days(tou_meters, per_house).groupBy("meter_id", _month()).agg(
        F.sum(_tou_cost(F.hour("window_end"))).alias("_cost"), F.sum("total_energy").alias("_sum"),
        F.max(F.dayofmonth("window_end")).alias("_days"))
    whole = lambda c: F.col(c) / F.col("_days") * days_in_month("month")
    return monthly.select("meter_id", whole("_cost").alias("estimated_monthly_bill"),
                          whole("_sum").alias("estimated_total_energy"), "month")
