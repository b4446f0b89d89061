"""Warehouses, fleets and shipments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import (
    event_micros, grid_id, haversine_km, int_div, moment, round_numeric, span,
)
from tidemill.operators import Factorised, count_where, latest_by

# -- warehouse stock -------------------------------------------------------------------


def inventory_status(inventory: DataFrame) -> DataFrame:
    """Stock rows with their reorder status."""
    return inventory.select(
        "warehouse_id", "product_id", "stock_level", "reorder_point", "location",
        F.when(F.col("stock_level") <= F.col("reorder_point"), "Reorder Needed")
        .otherwise("Stock Sufficient").alias("reorder_status"),
        F.col("timestamp").alias("last_update"))


def recent_sales(sales: DataFrame, as_of: Column | str | None = None, within: str = "7 days") -> DataFrame:
    """Units sold and last sale per warehouse and product in the moving window."""
    return sales.filter(F.col("timestamp") > moment(as_of) - span(within)).groupBy("warehouse_id", "product_id").agg(
        F.sum("quantity_sold").alias("total_quantity_sold"), F.max("timestamp").alias("last_sale"))


def demand_forecast(inventory: DataFrame, sales: DataFrame, as_of: Column | str | None = None,
                    within: str = "7 days") -> DataFrame:
    """Days of stock left at the recent pace (whole days; 0 where nothing sold, NULL where unknown)."""
    sold = F.col("weekly_sales")
    recent = recent_sales(sales, as_of, within).select(
        "warehouse_id", "product_id", F.col("total_quantity_sold").alias("weekly_sales"))
    return inventory.join(recent, ["warehouse_id", "product_id"], "left").select(
        "warehouse_id", "product_id", "stock_level", "weekly_sales",
        F.when(sold == 0, F.lit(0)).otherwise(int_div("stock_level", sold)).alias("stock_days_remaining"))


# -- seven-way fleet join ---------------------------------------------------------------

def fleet(drivers: DataFrame, trucks: DataFrame, shipments: DataFrame, routes: DataFrame,
          warehouses: DataFrame, fuel: DataFrame, maintenance: DataFrame) -> Factorised:
    """Every driver with the truck, its shipments, routes, destination, fuel and service logs, kept as parts by truck.

    The driver-to-truck join is inner: later joins need the truck in any case.
    Log rows of trucks without a driver are left out before the logs are shuffled.
    """
    stops = shipments.join(
        warehouses.select(F.col("location").alias("warehouse_location"),
                          F.col("capacity_tons").alias("warehouse_capacity_tons")),
        F.col("destination") == F.col("warehouse_location"))
    return Factorised(["truck_id"], {
        "base": drivers.join(trucks, F.col("assigned_truck_id") == F.col("truck_id")), "stops": stops,
        "legs": routes.select("truck_id", "route_id", "estimated_departure_time", "distance_km"),
        "fuel": fuel, "service": maintenance}).reduced(["base"])


def fleet_assignments(drivers: DataFrame, trucks: DataFrame, shipments: DataFrame, routes: DataFrame,
                      warehouses: DataFrame, fuel: DataFrame, maintenance: DataFrame) -> DataFrame:
    """The rows of ``fleet``: all pairs of a truck's logs, as many as the products of their counts.

    Where only counts or sums are wanted, ``fleet_totals`` needs none of the pairs.
    """
    return fleet(drivers, trucks, shipments, routes, warehouses, fuel, maintenance).rows().select(
        "truck_id", "driver_id", "driver_name", "license_number", "truck_model", "capacity_tons", "current_location",
        "shipment_id", "origin", "warehouse_location", "warehouse_capacity_tons", "route_id",
        "estimated_departure_time", "distance_km", "fuel_log_id", "fuel_date", "liters_filled",
        "maintenance_id", "maintenance_date", "cost_usd")


def fleet_totals(drivers: DataFrame, trucks: DataFrame, shipments: DataFrame, routes: DataFrame,
                 warehouses: DataFrame, fuel: DataFrame, maintenance: DataFrame) -> DataFrame:
    """Rows, distance, liters and cost over ``fleet_assignments`` per driver, without its pairs."""
    return fleet(drivers, trucks, shipments, routes, warehouses, fuel, maintenance).totals(
        "base", ["driver_id", "driver_name"],
        {"distance_km": ("legs", "distance_km"), "liters_filled": ("fuel", "liters_filled"), "cost_usd": ("service", "cost_usd")})


FUEL_PRICE = 1.2  # fixed value: price per liter


def fleet_overview(trucks: DataFrame, shipments: DataFrame, routes: DataFrame, drivers: DataFrame,
                   fuel: DataFrame, maintenance: DataFrame, repeat_costs: bool = True) -> DataFrame:
    """Load, utilisation, cost, route and driver per truck.

    With ``repeat_costs`` each fuel row counts once per service row and the
    other way round, as in a join of the two logs; without it, each log is
    totalled on its own.  Neither builds the pairs.
    """
    load = shipments.groupBy("truck_id").agg(F.sum("shipment_weight").alias("total_shipment_weight"))
    fuel_sum = fuel.groupBy("truck_id").agg(
        F.sum(F.col("liters_filled") * F.lit(FUEL_PRICE)).alias("_fuel"), F.count(F.lit(1)).alias("_n_fuel"))
    service = maintenance.groupBy("truck_id").agg(
        F.sum("cost_usd").alias("_cost"), F.count(F.lit(1)).alias("_n_service"))
    costs = (
        trucks.join(load, "truck_id", "left").join(fuel_sum, "truck_id", "left").join(service, "truck_id", "left")
        .withColumn("max_capacity_weight", F.col("capacity_tons") * 1000)
    )
    times = lambda n: F.coalesce(F.col(n), F.lit(1)) if repeat_costs else F.lit(1)
    costs = costs.withColumns({
        "total_fuel_cost": F.col("_fuel") * times("_n_service"),
        "total_maintenance_cost": F.col("_cost") * times("_n_fuel"),
    })
    people = drivers.select("driver_id", "driver_name", "license_number")
    used = round_numeric(F.col("total_shipment_weight") * F.lit(100) / F.col("max_capacity_weight"), 2)
    return costs.join(routes, "truck_id").join(people, "driver_id").select(
        "truck_id", "truck_model", "total_shipment_weight", "max_capacity_weight",
        used.alias("capacity_utilization_percentage"), "total_fuel_cost", "total_maintenance_cost",
        (F.col("total_fuel_cost") + F.col("total_maintenance_cost")).alias("total_operational_cost"),
        "route_id", "estimated_departure_time", "estimated_arrival_time", "distance_km",
        "driver_name", "license_number")


# -- live shipment tracking ---------------------------------------------------------------

def gps_cells(gps: DataFrame) -> DataFrame:
    return gps.withColumn("grid_id", grid_id("lat", "lon"))


def traffic_cells(traffic: DataFrame) -> DataFrame:
    middle = lambda a, b: (F.col(a) + F.col(b)) / 2
    return traffic.withColumn("grid_id", grid_id(middle("min_lat", "max_lat"), middle("min_lon", "max_lon")))


def latest_orders(updates: DataFrame) -> DataFrame:
    return latest_by(updates, ["order_id"], ["updated_at"])


def latest_vehicles(gps: DataFrame) -> DataFrame:
    return latest_by(gps_cells(gps), ["vehicle_id"], ["event_ts"]).withColumnRenamed("event_ts", "gps_ts")


def latest_traffic(traffic: DataFrame) -> DataFrame:
    return latest_by(traffic_cells(traffic), ["grid_id"], ["event_ts", "region_id"]).withColumnRenamed("event_ts", "traffic_ts")


MIN_SPEED_KMH = 5.0        # fixed value: effective speed never falls below this
CONGESTION_SLOWDOWN = 0.6  # fixed value: share of speed lost at full congestion


def order_eta(updates: DataFrame, gps: DataFrame, traffic: DataFrame) -> DataFrame:
    """Distance, effective speed, arrival time and delay of every order, from the latest reports."""
    return eta_in_traffic(orders_on_vehicles(latest_orders(updates), latest_vehicles(gps)), latest_traffic(traffic))


def orders_on_vehicles(orders: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Current orders beside the position of their vehicle."""
    where = vehicles.select("vehicle_id", F.col("lat").alias("vehicle_lat"), F.col("lon").alias("vehicle_lon"),
                            F.col("speed_kmh").alias("vehicle_speed_kmh"), "gps_ts", "grid_id")
    return orders.select("order_id", "vehicle_id", "status", "dest_lat", "dest_lon", "promised_ts", "updated_at").join(where, "vehicle_id")


def eta_in_traffic(placed: DataFrame, cells: DataFrame) -> DataFrame:
    """Arrival of placed orders, slowed by the traffic of the vehicle's cell."""
    flow = cells.select("grid_id", "region_id", F.col("congestion").alias("_cong"), F.col("traffic_speed_kmh").alias("_flow"))
    joined = placed.join(flow, "grid_id", "left").withColumns({
        "congestion": F.coalesce("_cong", F.lit(0.0)),
        "traffic_speed_kmh": F.coalesce("_flow", "vehicle_speed_kmh"),
    })
    pace = F.least("vehicle_speed_kmh", "traffic_speed_kmh") * (F.lit(1) - F.col("congestion") * CONGESTION_SLOWDOWN)
    timed = (
        joined
        .withColumn("distance_km", haversine_km("vehicle_lat", "vehicle_lon", "dest_lat", "dest_lon"))
        .withColumn("effective_speed_kmh", F.greatest(F.lit(MIN_SPEED_KMH), pace))
        .withColumn("eta_minutes", F.col("distance_km") / F.col("effective_speed_kmh") * 60.0)
        .withColumn("eta_ts", F.col("gps_ts") + F.make_dt_interval(secs=(F.col("eta_minutes") * 60).cast("decimal(18,6)")))
        .withColumn("delay_interval", F.col("eta_ts") - F.col("promised_ts"))
    )
    return timed.select(
        "order_id", "vehicle_id", "status", "dest_lat", "dest_lon", "promised_ts", "updated_at", "vehicle_lat",
        "vehicle_lon", "vehicle_speed_kmh", "gps_ts", "grid_id", "region_id", "congestion", "traffic_speed_kmh",
        "distance_km", "effective_speed_kmh", "eta_minutes", "eta_ts", "delay_interval")


def delayed_first(eta: DataFrame, max_rows: int = 200) -> DataFrame:
    """The ``max_rows`` most delayed open orders."""
    if max_rows < 1:
        raise ValueError("max_rows must be positive")
    return eta.filter(F.col("status").isin("in_transit", "delayed")).orderBy(
        F.col("delay_interval").desc_nulls_last(), "order_id").limit(max_rows)


def transit_kpis(eta: DataFrame) -> DataFrame:
    late = event_micros("eta_ts") > event_micros("promised_ts")
    return eta.filter(F.col("status") == "in_transit").agg(
        F.count(F.lit(1)).alias("in_transit"), count_where(late).alias("delayed_in_transit"),
        F.avg("eta_minutes").alias("avg_eta_minutes"))


def order_by_id(eta: DataFrame, order_id: str) -> DataFrame:
    return eta.filter(F.col("order_id") == order_id).limit(1)
