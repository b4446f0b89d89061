"""Airlines: check-in notices, meals, and flight traffic per hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import moment, span
from tidemill.operators import tumble


def checkin_open(passengers: DataFrame, as_of: Column | str | None = None, ahead: bool = True,
                 near: str = "48 hours", far: str = "72 hours") -> DataFrame:
    """Opted-in passengers whose flight leaves ``near`` to ``far`` from now.

    ``ahead=False`` selects flights that left that long ago instead.
    """
    now, at = moment(as_of), F.col("departure_time")
    if ahead:
        due = (at >= now + span(near)) & (at < now + span(far))
    else:
        due = (at <= now - span(near)) & (at > now - span(far))
    return passengers.filter(F.col("opted_in") & due).select(
        "flight_id", "passenger_ref_number", "flight_number", "carrier_code", "departure_time", "contact_info")


MEAL_SHARE = 0.95  # fixed value: share of checked-in passengers assumed to eat


def meal_status(checkins: DataFrame, meals: DataFrame) -> DataFrame:
    """Checked-in passengers against meals per flight and class."""
    supply = meals.select("flight_id", "class", "available_meals")
    # Counting before the join keeps the shuffle to one row per flight and class;
    # a repeated supply row multiplies the count as joined rows would.
    boarded = checkins.groupBy("flight_id", "flight_number", "class").agg(
        F.count("passenger_ref_number").alias("_n"))
    joined = boarded.join(supply, ["flight_id", "class"], "left").groupBy(
        "flight_id", "flight_number", "class", "available_meals").agg(F.sum("_n").alias("checked_in_passengers"))
    short = F.col("checked_in_passengers") * MEAL_SHARE > F.col("available_meals")
    return joined.withColumn("meal_status", F.when(short, "Meal Shortage").otherwise("Sufficient Meals")).select(
        "flight_id", "flight_number", "class", "checked_in_passengers", "available_meals", "meal_status")


def meal_shortages(checkins: DataFrame, meals: DataFrame) -> DataFrame:
    return meal_status(checkins, meals).filter(F.col("meal_status") == "Meal Shortage")


# -- flights ----------------------------------------------------------------------------

def _per_window(flights: DataFrame, column: str, name: str, size: str) -> DataFrame:
    # Departures are windowed on the scheduled arrival too, as arrivals are.
    return tumble(flights, "arrival_scheduled", size).groupBy(column, "window_start", "window_end").agg(
        F.count(column).alias(name))


def airline_flights(flights: DataFrame, size: str = "1 hour") -> DataFrame:
    """Flights per airline and window, busiest first."""
    return _per_window(flights, "airline_name", "total_flights", size).orderBy(F.desc("total_flights"))


def _arrivals_and_departures(flights: DataFrame, by: str, size: str) -> DataFrame:
    arrive, depart = f"arrival_{by}", f"departure_{by}"
    arrivals = _per_window(flights, arrive, "total_flights_arrival", size)
    departures = _per_window(flights, depart, "total_flights_departure", size).withColumnsRenamed(
        {"window_start": "_start", "window_end": "_end"})
    return arrivals.join(
        departures, (F.col(arrive) == F.col(depart)) & (F.col("window_start") == F.col("_start"))
    ).select(arrive, "total_flights_arrival", depart, "total_flights_departure", "window_start", "window_end").orderBy(
        F.desc("total_flights_arrival"), F.desc("total_flights_departure"))


def airport_traffic(flights: DataFrame, size: str = "1 hour") -> DataFrame:
    return _arrivals_and_departures(flights, "airport", size)


def timezone_traffic(flights: DataFrame, size: str = "1 hour") -> DataFrame:
    return _arrivals_and_departures(flights, "timezone", size)
