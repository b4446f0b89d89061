"""Checks for machine telemetry and network devices."""

from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.plans import machines as m

declare(
    readings="""SELECT user_id % 12 AS machine_id, ts, CAST(floor(value) AS DOUBLE) AS winding_temperature, CAST(event_id % 30 AS DOUBLE) AS ambient_temperature,
        CAST((event_id * 7) % 11 AS DOUBLE) AS vibration_level, CAST(floor(value / 3) AS DOUBLE) AS current_draw, CAST(220 + event_id % 5 AS DOUBLE) AS voltage_level,
        CAST(1500 + user_id AS DOUBLE) AS nominal_speed, CAST(floor(value * 2) AS DOUBLE) AS power_consumption, CAST(90 - event_id % 20 AS DOUBLE) AS efficiency FROM {events}""",
    network="""SELECT 'dev' || user_id % 30 AS device_id, ts AS timestamp, CAST(floor(value) AS DOUBLE) AS latency_ms, CAST(event_id % 8 AS DOUBLE) AS packet_loss_rate,
        CAST(50 + event_id % 50 AS DOUBLE) AS bandwidth_usage_percent, event_id AS flow_bytes FROM {events}""",
)

_W = "time_bucket(INTERVAL '{0}', {1}) AS window_start, window_start + INTERVAL '{0}' AS window_end"
check("q54_machine_averages", "readings", oracle=f"""SELECT machine_id, {_W.format('6 hours', 'ts')}, {', '.join(f'avg({c}) AS avg_{c}' for c in m.MACHINE_METRICS)}
    FROM readings GROUP BY ALL""")(lambda r: m.machine_averages(r, "6 hours"))

_NAMES = ("winding_temp", "vibration", "current_draw", "voltage_level", "power_consumption")
_SRC = dict(zip(_NAMES, ("winding_temperature", "vibration_level", "current_draw", "voltage_level", "power_consumption")))
_STAT = ", ".join(f"avg({s}) AS avg_{n}, stddev_pop({s}) AS stddev_{n}, max({s}) AS max_{n}" for n, s in _SRC.items())
_PEAK = [f"max_{n} > avg_{n} + 3 * stddev_{n}" for n in _NAMES]
_RISE = [f"avg_{n} - lag(avg_{n}) OVER w > 2 * stddev_{n}" for n in _NAMES]
_LABEL = [x[3] for x in m.WATCHED] + [x[4] for x in m.WATCHED]
check("q55_machine_anomalies", "readings", oracle=f"""
    WITH s AS (SELECT machine_id, {_W.format('1 day', 'ts')}, {_STAT} FROM readings GROUP BY ALL),
      t AS (SELECT *, CASE {' '.join(f"WHEN {c} THEN '{lab}'" for c, lab in zip(_PEAK + _RISE, _LABEL))} END AS anomaly_alert
            FROM s WINDOW w AS (PARTITION BY machine_id ORDER BY window_end))
    SELECT * REPLACE ({', '.join(f'round(stddev_{n}, 6) AS stddev_{n}' for n in _NAMES)}) FROM t WHERE anomaly_alert IS NOT NULL""")(
    lambda r: m.machine_anomalies(r, "1 day").withColumns({f"stddev_{n}": F.round(f"stddev_{n}", 6) for n in _NAMES}))

_AVG = ", ".join(f"avg({c}) AS {n}" for c, n in m.COMPARED.items())
check("q56_maintenance_alerts", "readings", oracle=f"""
    WITH h AS (SELECT machine_id, {_AVG} FROM readings WHERE ts < TIMESTAMP '2024-01-25' GROUP BY ALL),
      r AS (SELECT machine_id, {_W.format('6 hours', 'ts')}, {_AVG} FROM readings GROUP BY ALL)
    SELECT r.*, CASE WHEN r.avg_winding_temp > h.avg_winding_temp + 5 THEN 'Potential Overheating' WHEN r.avg_vibration > h.avg_vibration + 0.1 THEN 'Increased Vibration'
      WHEN r.avg_current_draw > h.avg_current_draw + 2 THEN 'Possible overcurrent condition' WHEN r.avg_efficiency < h.avg_efficiency - 5 THEN 'Efficiency Drop' END AS maintenance_alert
    FROM r JOIN h USING (machine_id) WHERE maintenance_alert IS NOT NULL""")(
    lambda r: m.maintenance_alerts(r, "2024-01-30 00:00:00", "5 days", "6 hours"))

_DEV = f"""SELECT device_id, {_W.format('6 hours', 'timestamp')}, avg(latency_ms) AS avg_latency_ms, avg(packet_loss_rate) AS avg_packet_loss_rate,
    avg(bandwidth_usage_percent) AS avg_bandwidth_usage, sum(flow_bytes)::BIGINT AS total_flow_bytes FROM network GROUP BY ALL"""
_ANOM = f"""SELECT * EXCLUDE (total_flow_bytes), avg_latency_ms > 100 AS is_high_latency, avg_packet_loss_rate > 5 AS is_high_packet_loss,
    avg_bandwidth_usage > 90 AS is_bandwidth_saturation FROM ({_DEV}) WHERE is_high_latency OR is_high_packet_loss OR is_bandwidth_saturation"""


def _devices(n):
    return m.device_metrics(n, "6 hours")


check("q82_device_metrics", "network", oracle=_DEV)(_devices)
check("q83_network_anomalies", "network", oracle=_ANOM)(lambda n: m.network_anomalies(_devices(n)))
check("q84_search_anomalies", "network", oracle=f"""
    SELECT *, count(*) OVER () AS total FROM ({_ANOM}) WHERE lower(device_id) LIKE '%dev1%' AND window_start BETWEEN TIMESTAMP '2024-01-03 08:00:00' AND TIMESTAMP '2024-01-25'
      AND (is_high_latency OR is_high_packet_loss) ORDER BY window_start DESC, device_id LIMIT 20 OFFSET 5""")(
    lambda n: m.search_anomalies(m.network_anomalies(_devices(n)), "DEV1", "2024-01-03T00:00:00Z", "2024-01-25T00:00:00", ["latency", "loss"], limit=20, offset=5))
