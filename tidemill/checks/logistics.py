"""Checks for warehouses, fleets and shipments."""

from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.plans import logistics as g

declare(
    stock="""SELECT p_size AS warehouse_id, p_partkey AS product_id, TIMESTAMP '2001-11-04 00:00:00' AS timestamp,
               CAST(floor(p_retailprice) AS BIGINT) AS stock_level, 20 * p_size + 400 AS reorder_point, p_type AS location FROM {part}""",
    unit_sales="""SELECT l_orderkey AS sale_id, p_size AS warehouse_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) - 1 AS quantity_sold,
               l_shipdate AS timestamp FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    trucks="""SELECT o_orderkey AS truck_id, o_orderpriority AS truck_model, 5 + o_orderkey % 20 AS capacity_tons, o_orderstatus AS current_location
              FROM {orders}""",
    drivers="""SELECT c_custkey AS driver_id, c_name AS driver_name, 'L' || c_custkey AS license_number, c_custkey * 7 AS assigned_truck_id FROM {customer}""",
    shipments="""SELECT 's' || l_orderkey || '-' || l_linenumber AS shipment_id, l_shipmode_origin AS origin, 'NATION_' || l_suppkey % 30 AS destination,
                   CAST(l_quantity AS BIGINT) * 100 AS shipment_weight, l_orderkey AS truck_id
                 FROM (SELECT *, l_returnflag AS l_shipmode_origin FROM {lineitem})""",
    depots="""SELECT 'w' || n_nationkey AS warehouse_id, n_name AS location, 100 + n_nationkey AS capacity_tons FROM {nation}""",
    routes="""SELECT 'r' || o_orderkey AS route_id, o_orderkey AS truck_id, o_custkey AS driver_id, o_orderdate AS estimated_departure_time,
                o_orderdate + INTERVAL '8' HOUR AS estimated_arrival_time, 10 + o_orderkey % 500 AS distance_km FROM {orders}""",
    fuel_logs="""SELECT 'f' || l_orderkey || '-' || l_linenumber AS fuel_log_id, l_orderkey AS truck_id, l_shipdate AS fuel_date,
                   CAST(l_quantity AS BIGINT) AS liters_filled FROM {lineitem} WHERE l_returnflag = 'R'""",
    service_logs="""SELECT 'm' || l_orderkey || '-' || l_linenumber AS maintenance_id, l_orderkey AS truck_id, l_shipdate AS maintenance_date,
                   CAST(floor(l_extendedprice) AS BIGINT) AS cost_usd FROM {lineitem} WHERE l_returnflag <> 'R'""",
    gps="""SELECT ts AS event_ts, 'v' || user_id AS vehicle_id, 1.0E0 + (user_id % 40) * 0.0005E0 AS lat,
             103.0E0 + (event_id % 40) * 0.0005E0 AS lon, 20.0E0 + event_id % 60 AS speed_kmh FROM {events}""",
    road_cells="""SELECT ts AS event_ts, 'reg' || event_id % 9 AS region_id, 1.0E0 + (user_id % 40) * 0.0005E0 AS min_lat,
             103.0E0 + (event_id % 30) * 0.0005E0 AS min_lon, 1.002E0 + (user_id % 40) * 0.0005E0 AS max_lat,
             103.002E0 + (event_id % 30) * 0.0005E0 AS max_lon, (event_id % 10) / 10.0E0 AS congestion,
             10.0E0 + event_id % 50 AS traffic_speed_kmh FROM {events}""",
    order_updates="""SELECT 'o' || o_custkey AS order_id, 'v' || o_custkey % 120 AS vehicle_id, 1.05E0 + (o_orderkey % 50) * 0.001E0 AS dest_lat,
             103.05E0 + (o_orderkey % 50) * 0.001E0 AS dest_lon, TIMESTAMP '2024-01-30 10:00:00' + (o_custkey % 20) * INTERVAL '1' HOUR AS promised_ts,
             CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'in_transit' ELSE 'delayed' END AS status,
             o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND AS updated_at FROM {orders}""",
)

check("q17_inventory_status", "stock", oracle="""
    SELECT warehouse_id, product_id, stock_level, reorder_point, location, timestamp AS last_update,
      if(stock_level <= reorder_point, 'Reorder Needed', 'Stock Sufficient') AS reorder_status FROM stock""")(g.inventory_status)

_NOW = "2001-10-01 00:00:00"
_RECENT = """SELECT warehouse_id, product_id, sum(quantity_sold)::BIGINT AS total_quantity_sold, max(timestamp) AS last_sale
    FROM unit_sales WHERE timestamp > TIMESTAMP '2001-10-01' - INTERVAL 7 DAY GROUP BY ALL"""
check("q18_recent_sales", "unit_sales", oracle=_RECENT)(lambda s: g.recent_sales(s, _NOW))
check("q19_demand_forecast", "stock", "unit_sales", oracle=f"""
    SELECT s.warehouse_id, s.product_id, stock_level, total_quantity_sold AS weekly_sales,
      if(total_quantity_sold = 0, 0, stock_level // nullif(total_quantity_sold, 0)) AS stock_days_remaining
    FROM stock s LEFT JOIN ({_RECENT}) r ON r.warehouse_id = s.warehouse_id AND r.product_id = s.product_id""")(
    lambda s, u: g.demand_forecast(s, u, _NOW))

check("q66_fleet_assignments", "drivers", "trucks", "shipments", "routes", "depots", "fuel_logs", "service_logs", oracle="""
    SELECT t.truck_id, d.driver_id, driver_name, license_number, truck_model, t.capacity_tons, current_location, shipment_id, origin,
      w.location AS warehouse_location, w.capacity_tons AS warehouse_capacity_tons, route_id, estimated_departure_time, distance_km,
      fuel_log_id, fuel_date, liters_filled, maintenance_id, maintenance_date, cost_usd
    FROM trucks t, drivers d, shipments s, routes r, depots w, fuel_logs f, service_logs m
    WHERE d.assigned_truck_id = t.truck_id AND s.truck_id = t.truck_id AND r.truck_id = t.truck_id AND w.location = s.destination
      AND f.truck_id = t.truck_id AND m.truck_id = t.truck_id""")(g.fleet_assignments)
_WHOLE = ("n_rows", "distance_km", "liters_filled", "cost_usd")
check("q66_fleet_totals", "drivers", "trucks", "shipments", "routes", "depots", "fuel_logs", "service_logs", oracle="""
    SELECT d.driver_id, driver_name, count(*) AS n_rows, sum(distance_km)::BIGINT AS distance_km,
      sum(liters_filled)::BIGINT AS liters_filled, sum(cost_usd)::BIGINT AS cost_usd
    FROM trucks t, drivers d, shipments s, routes r, depots w, fuel_logs f, service_logs m
    WHERE d.assigned_truck_id = t.truck_id AND s.truck_id = t.truck_id AND r.truck_id = t.truck_id AND w.location = s.destination
      AND f.truck_id = t.truck_id AND m.truck_id = t.truck_id GROUP BY ALL""")(
    lambda *a: g.fleet_totals(*a).withColumns({c: F.col(c).cast("bigint") for c in _WHOLE}))


def _overview(fuel: str, service: str) -> str:
    return f"""SELECT t.truck_id, truck_model, w::BIGINT AS total_shipment_weight, capacity_tons * 1000 AS max_capacity_weight,
      round((w * 100::DOUBLE / (capacity_tons * 1000))::DECIMAL(38,10), 2)::DOUBLE AS capacity_utilization_percentage,
      round(fc, 4) AS total_fuel_cost, mc::BIGINT AS total_maintenance_cost, round(fc + mc, 4) AS total_operational_cost,
      route_id, estimated_departure_time, estimated_arrival_time, distance_km, driver_name, license_number
    FROM trucks t LEFT JOIN (SELECT truck_id, sum(shipment_weight) AS w FROM shipments GROUP BY ALL) USING (truck_id)
    LEFT JOIN ({fuel}) USING (truck_id) {service}
    JOIN routes USING (truck_id) JOIN drivers USING (driver_id)"""


_ROUND = lambda df: df.withColumns({c: F.round(c, 4) for c in ("total_fuel_cost", "total_operational_cost")})
check("q67_fleet_overview", "trucks", "shipments", "routes", "drivers", "fuel_logs", "service_logs", oracle=_overview(
    """SELECT t.truck_id, sum(liters_filled * 1.2::DOUBLE) AS fc, sum(cost_usd) AS mc FROM trucks t
       LEFT JOIN fuel_logs f ON f.truck_id = t.truck_id LEFT JOIN service_logs m ON m.truck_id = t.truck_id GROUP BY ALL""", ""))(
    lambda *a: _ROUND(g.fleet_overview(*a)))
check("q67_fleet_overview_once", "trucks", "shipments", "routes", "drivers", "fuel_logs", "service_logs", oracle=_overview(
    "SELECT truck_id, sum(liters_filled * 1.2::DOUBLE) AS fc FROM fuel_logs GROUP BY ALL",
    "LEFT JOIN (SELECT truck_id, sum(cost_usd) AS mc FROM service_logs GROUP BY ALL) USING (truck_id)"))(
    lambda *a: _ROUND(g.fleet_overview(*a, repeat_costs=False)))

_CELL = "CAST(floor({0} / 0.002::DOUBLE) AS BIGINT) || '_' || CAST(floor({1} / 0.002::DOUBLE) AS BIGINT) AS grid_id"
_GPS = f"SELECT *, {_CELL.format('lat', 'lon')} FROM gps"
_ROAD = f"SELECT *, {_CELL.format('((min_lat + max_lat) / 2)', '((min_lon + max_lon) / 2)')} FROM road_cells"
_ORD1 = "SELECT DISTINCT ON (order_id) * FROM order_updates ORDER BY order_id, updated_at DESC"
_VEH1 = f"SELECT DISTINCT ON (vehicle_id) * RENAME (event_ts AS gps_ts) FROM ({_GPS}) ORDER BY vehicle_id, event_ts DESC"
_CELL1 = f"SELECT DISTINCT ON (grid_id) * RENAME (event_ts AS traffic_ts) FROM ({_ROAD}) ORDER BY grid_id, event_ts DESC, region_id DESC"
check("q68_gps_cells", "gps", oracle=_GPS)(g.gps_cells)
check("q68_traffic_cells", "road_cells", oracle=_ROAD)(g.traffic_cells)
check("q69_latest_orders", "order_updates", oracle=_ORD1)(g.latest_orders)
check("q69_latest_vehicles", "gps", oracle=_VEH1)(g.latest_vehicles)
check("q69_latest_traffic", "road_cells", oracle=_CELL1)(g.latest_traffic)

_ETA = f"""o AS ({_ORD1}), v AS ({_VEH1}), c AS ({_CELL1}), j AS (
    SELECT o.*, v.lat, v.lon, v.speed_kmh, v.gps_ts, v.grid_id, region_id, coalesce(c.congestion, 0) AS cg, coalesce(c.traffic_speed_kmh, v.speed_kmh) AS fl
    FROM o JOIN v USING (vehicle_id) LEFT JOIN c USING (grid_id)),
  d AS (SELECT *, 12742 * asin(sqrt(pow(sin(radians(dest_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(dest_lat)) *
          pow(sin(radians(dest_lon - lon) / 2), 2))) AS km, greatest(5, least(speed_kmh, fl) * (1 - cg * 0.6::DOUBLE)) AS kmh FROM j),
  e AS (SELECT *, km / kmh * 60 AS mins FROM d)"""
_SHOW = ("order_id", "vehicle_id", "status", "dest_lat", "dest_lon", "promised_ts", "updated_at", "vehicle_lat", "vehicle_lon",
         "vehicle_speed_kmh", "gps_ts", "grid_id", "region_id", "congestion", "traffic_speed_kmh")


def eta_rounded(df):
    return df.select(*_SHOW, *[F.round(x, 6).alias(x) for x in ("distance_km", "effective_speed_kmh", "eta_minutes")],
                     F.date_trunc("second", "eta_ts").alias("eta_ts"),
                     (F.unix_seconds(F.date_trunc("second", "eta_ts")) - F.unix_seconds(F.col("promised_ts").cast("timestamp"))).alias("delay_seconds"))


_ETA_OUT = """SELECT order_id, vehicle_id, status, dest_lat, dest_lon, promised_ts, updated_at, lat AS vehicle_lat, lon AS vehicle_lon,
   speed_kmh AS vehicle_speed_kmh, gps_ts, grid_id, region_id, cg::DOUBLE AS congestion, fl AS traffic_speed_kmh, round(km, 6) AS distance_km,
   round(kmh, 6)::DOUBLE AS effective_speed_kmh, round(mins, 6) AS eta_minutes,
   date_trunc('second', gps_ts + to_microseconds(round(mins * 60000000)::BIGINT)) AS eta_ts,
   (epoch_ms(date_trunc('second', gps_ts + to_microseconds(round(mins * 60000000)::BIGINT))) - epoch_ms(promised_ts)) // 1000 AS delay_seconds FROM e"""
ETA_ORACLE = f"WITH {_ETA} {_ETA_OUT}"
check("q70_order_eta", "order_updates", "gps", "road_cells", oracle=ETA_ORACLE)(
    lambda *a: eta_rounded(g.order_eta(*a)))
check("q71_delayed_first", "order_updates", "gps", "road_cells", oracle=f"""WITH {_ETA} SELECT order_id, status, delay_seconds FROM ({_ETA_OUT})
    WHERE status IN ('in_transit', 'delayed') ORDER BY delay_seconds DESC NULLS LAST, order_id LIMIT 50""")(
    lambda *a: eta_rounded(g.delayed_first(g.order_eta(*a), 50)).select("order_id", "status", "delay_seconds"))
check("q71_transit_kpis", "order_updates", "gps", "road_cells", oracle=f"""WITH {_ETA}
    SELECT count(*) AS in_transit, count(*) FILTER (gps_ts + to_microseconds(round(mins * 60000000)::BIGINT) > promised_ts) AS delayed_in_transit,
      round(avg(mins), 6) AS avg_eta_minutes FROM e WHERE status = 'in_transit'""")(
    lambda *a: g.transit_kpis(g.order_eta(*a)).withColumn("avg_eta_minutes", F.round("avg_eta_minutes", 6)))
check("q71_order_by_id", "order_updates", "gps", "road_cells", oracle=f"""WITH {_ETA} SELECT order_id, vehicle_id, status FROM e WHERE order_id = 'o7'""")(
    lambda *a: g.order_by_id(g.order_eta(*a), "o7").select("order_id", "vehicle_id", "status"))
