"""Checks for road traffic."""

from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.plans import traffic as t

declare(
    sensors="SELECT ts AS timestamp_entry, 'R' || user_id % 20 AS road_id FROM {events}",
    cameras="SELECT ts AS timestamp, CASE WHEN event_type = 'click' THEN 'S' ELSE 'R' END || user_id % 20 AS road_id, CAST(floor(value) AS DOUBLE) AS vehicle_speed_kph FROM {events}",
    flow="""SELECT 'R' || user_id % 20 AS road_id, ts AS datetime, CAST(floor(value) AS DOUBLE) AS avg_speed_kph, CAST(event_id % 50 AS DOUBLE) AS traffic_flow,
              CASE WHEN event_id % 4 > 0 THEN CAST(event_id % 47 AS DOUBLE) END AS predicted_flow_next_minute FROM {events}""",
)

_F = """SELECT road_id, window_start, vehicle_count, avg_speed_kph FROM
   (SELECT road_id, time_bucket(INTERVAL '1 day', timestamp_entry) AS window_start, count(*) AS vehicle_count FROM sensors GROUP BY ALL) LEFT JOIN
   (SELECT road_id, time_bucket(INTERVAL '1 day', timestamp) AS window_start, avg(vehicle_speed_kph) AS avg_speed_kph FROM cameras GROUP BY ALL) USING (road_id, window_start)"""
_RECENT = f"SELECT * FROM ({_F}) WHERE window_start BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-29'"


def _features(s, c):
    return t.road_features(s, c, "1 day")


def _recent(s, c):
    return t.recent_features(_features(s, c), "2024-01-30 00:00:00", "1 day", "6 days")


check("q85_road_features", "sensors", "cameras", oracle=_F)(_features)
check("q86_recent_features", "sensors", "cameras", oracle=_RECENT)(_recent)
check("q86_flow_history", "flow", oracle="SELECT * FROM flow WHERE datetime >= TIMESTAMP '2024-01-29 12:00:00' - INTERVAL 3 HOUR")(
    lambda f: t.flow_history(f, "2024-01-29 12:00:00"))
check("q87_next_flow", "sensors", "cameras", oracle=f"""
    SELECT road_id, max(window_start) AS datetime, arg_max(vehicle_count, window_start) AS traffic_flow, arg_max_null(avg_speed_kph, window_start) AS avg_speed_kph,
      round(if(count(avg_speed_kph) = 5, avg(vehicle_count), NULL), 6) AS predicted_flow_next_minute
    FROM (SELECT * FROM ({_RECENT}) QUALIFY row_number() OVER (PARTITION BY road_id ORDER BY window_start DESC) <= 5) GROUP BY road_id""")(
    lambda s, c: t.next_flow(_recent(s, c)).withColumn("predicted_flow_next_minute", F.round("predicted_flow_next_minute", 6)))
check("q87_forecast_errors", "flow", oracle="""
    SELECT avg((traffic_flow - predicted_flow_next_minute) ** 2) AS mse, sqrt(avg((traffic_flow - predicted_flow_next_minute) ** 2)) AS rmse,
      avg(abs(traffic_flow - predicted_flow_next_minute)) AS mae FROM flow""")(
    lambda f: t.forecast_errors(f, "traffic_flow", "predicted_flow_next_minute"))
check("x8_sequences", "sensors", "cameras", oracle=f"""
    WITH r AS (SELECT min(vehicle_count) AS a, max(vehicle_count) AS b, min(avg_speed_kph) AS c, max(avg_speed_kph) AS d FROM ({_F})),
      s AS (SELECT road_id, window_start, (vehicle_count - a)::DOUBLE / (b - a) AS f, (avg_speed_kph - c) / (d - c) AS g FROM ({_F}), r),
      p AS (SELECT road_id, window_start, f AS y, lag(f, 5) OVER w AS f5, lag(g, 5) OVER w AS g5, lag(f, 1) OVER w AS f1, lag(g, 1) OVER w AS g1
            FROM s WINDOW w AS (PARTITION BY road_id ORDER BY window_start))
    SELECT road_id, window_start, round(y, 9) AS y, round(f5, 9) AS f5, round(g5, 9) AS g5, round(f1, 9) AS f1, round(g1, 9) AS g1 FROM p WHERE f5 IS NOT NULL""")(
    lambda s, c: t.sequences(_features(s, c)).select("road_id", "window_start", F.round("y", 9).alias("y"),
        *[F.round(F.col("x")[i][j], 9).alias(n) for n, i, j in (("f5", 0, 0), ("g5", 0, 1), ("f1", 4, 0), ("g1", 4, 1))]))
check("x9_error_metrics", "flow", oracle="""
    SELECT avg((traffic_flow - avg_speed_kph) ** 2) AS mse, sqrt(avg((traffic_flow - avg_speed_kph) ** 2)) AS rmse, avg(abs(traffic_flow - avg_speed_kph)) AS mae FROM flow""")(
    lambda f: t.forecast_errors(f, "traffic_flow", "avg_speed_kph"))
