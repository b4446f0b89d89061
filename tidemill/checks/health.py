"""Checks for patient monitoring."""

from tidemill.checks.harness import check, declare
from tidemill.plans import health as h

declare(
    vitals="""SELECT 'P' || user_id AS patient_id, ts AS measure_time, 40 + CAST(floor(value) AS INT) % 90 AS heart_rate,
        CAST(88 + event_id % 13 + 0.5 AS DECIMAL(5,2)) AS blood_oxygen, CAST(3 + event_id % 6 + 0.25 AS DECIMAL(5,2)) AS blood_glucose FROM {events}""",
    limits="""SELECT 'P' || c_custkey AS patient_id, 50 AS heart_rate_min, 110 + CAST(c_custkey % 10 AS INT) AS heart_rate_max, CAST(93 AS DECIMAL(5,2)) AS blood_oxygen_min,
        CAST(3.90 AS DECIMAL(5,2)) AS blood_glucose_min, CAST(7.20 AS DECIMAL(5,2)) AS blood_glucose_max FROM {customer}""",
    alerts="""SELECT 'a' || event_id AS alert_id, 'P' || user_id AS patient_id, ts AS alert_time,
        CASE event_id % 5 WHEN 0 THEN 'heart_rate' WHEN 1 THEN 'blood_oxygen' WHEN 2 THEN 'blood_glucose' WHEN 3 THEN 'multi_vital_signs_deterioration' ELSE 'other' END AS alert_type,
        CASE WHEN event_id % 5 = 3 THEN 'level2' ELSE 'level1' END AS alert_level,
        CASE event_type WHEN 'click' THEN 'confirmed' WHEN 'view' THEN 'resolved' ELSE 'pending' END AS handle_status,
        CASE WHEN event_type = 'click' THEN ts + INTERVAL '5' MINUTE END AS handle_time FROM {events}""",
    handled="""SELECT 'a' || event_id AS alert_id, CASE WHEN event_id % 3 = 0 THEN 'resolved' ELSE 'confirmed' END AS handle_status,
        TIMESTAMP '2024-02-01 00:00:00' AS handle_time FROM {events} WHERE event_type = 'error'""",
)

_T = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
_SINGLE = f"""SELECT patient_id, measure_time, 'level1' AS alert_level, md5(patient_id || {_T.format('measure_time')}) AS alert_id,
    CASE WHEN heart_rate NOT BETWEEN heart_rate_min AND heart_rate_max THEN 'heart_rate' WHEN blood_oxygen < blood_oxygen_min THEN 'blood_oxygen'
         ELSE 'blood_glucose' END AS alert_type,
    CASE alert_type WHEN 'heart_rate' THEN 'Heart rate too ' || if(heart_rate < heart_rate_min, 'low', 'high') || ': ' || heart_rate || ' bpm'
      WHEN 'blood_oxygen' THEN 'Blood oxygen too low: ' || blood_oxygen || '%'
      ELSE 'Blood glucose too ' || if(blood_glucose < blood_glucose_min, 'low', 'high') || ': ' || blood_glucose || ' mmol/L' END AS alert_detail
  FROM vitals JOIN limits USING (patient_id) WHERE heart_rate NOT BETWEEN heart_rate_min AND heart_rate_max OR blood_oxygen < blood_oxygen_min
    OR blood_glucose NOT BETWEEN blood_glucose_min AND blood_glucose_max"""
_TREND = f"""SELECT patient_id, time_bucket(INTERVAL '1 day', measure_time) + INTERVAL 1 DAY AS m,
    arg_max(heart_rate, measure_time) - arg_min(heart_rate, measure_time) AS heart_rate_increase,
    arg_min(blood_oxygen, measure_time) - arg_max(blood_oxygen, measure_time) AS blood_oxygen_decrease
  FROM vitals GROUP BY 1, 2 HAVING heart_rate_increase >= 20 AND blood_oxygen_decrease >= 5"""
_TREND = f"""SELECT patient_id, m AS measure_time, 'multi_vital_signs_deterioration' AS alert_type, heart_rate_increase, blood_oxygen_decrease,
    'level2' AS alert_level, md5(patient_id || {_T.format('m')} || 'multi_vital_signs_deterioration') AS alert_id FROM ({_TREND})"""


def _trend(v):
    return h.trend_alerts(v, "1 day")


check("q50_single_alerts", "vitals", "limits", oracle=_SINGLE)(h.single_alerts)
check("q51_trend_alerts", "vitals", oracle=f"SELECT * REPLACE (blood_oxygen_decrease::DOUBLE AS blood_oxygen_decrease) FROM ({_TREND})")(_trend)
_UNION = f"""u AS (SELECT patient_id, measure_time AS alert_time, alert_type, alert_detail, alert_level, alert_id FROM ({_SINGLE}) UNION ALL
    SELECT patient_id, measure_time, alert_type, 'Heart rate increased by ' || heart_rate_increase || ' bpm and blood oxygen decreased by ' ||
      blood_oxygen_decrease || '% in 10 minutes', alert_level, alert_id FROM ({_TREND}))"""
check("q52_unified_alerts", "vitals", "limits", oracle=f"""WITH {_UNION} SELECT * FROM u
    QUALIFY row_number() OVER (PARTITION BY patient_id, alert_type, time_bucket(INTERVAL '1 day', alert_time) ORDER BY alert_time DESC, alert_id DESC) = 1""")(
    lambda v, t: h.unified_alerts(h.single_alerts(v, t), _trend(v), "1 day"))
check("q52_unified_alerts_literal_key", "vitals", "limits", oracle=f"""WITH {_UNION} SELECT * FROM u
    QUALIFY row_number() OVER (PARTITION BY patient_id, alert_type, date_trunc('second', alert_time)
      - to_seconds(30 * (round(second(alert_time) + (microsecond(alert_time) % 1000000) / 1000000.0)::BIGINT // 30)) ORDER BY alert_time DESC, alert_id DESC) = 1""")(
    lambda v, t: h.unified_alerts(h.single_alerts(v, t), _trend(v), literal_key=True))

check("q53_alert_stats", "alerts", oracle="""WITH r AS (SELECT * FROM alerts WHERE alert_time >= TIMESTAMP '2024-01-20' - INTERVAL 7 DAY),
    c AS (SELECT count(DISTINCT alert_id) AS total_alerts, count(*) FILTER (alert_level = 'level1') AS level1_count, count(*) FILTER (alert_level = 'level2') AS level2_count,
      count(*) FILTER (handle_status = 'pending') AS pending_count, count(*) FILTER (handle_status = 'confirmed') AS confirmed_count,
      count(*) FILTER (handle_status = 'resolved') AS resolved_count,
      count(*) FILTER (handle_status = 'pending' AND alert_time <= TIMESTAMP '2024-01-20' - INTERVAL 10 MINUTE) AS old FROM r)
    SELECT * EXCLUDE (old), round(confirmed_count * 100 / (total_alerts - resolved_count), 1) AS confirmed_rate,
      round(resolved_count * 100 / total_alerts, 1) AS resolved_rate, if(pending_count >= old, '+', '') || (pending_count - old) AS pending_trend FROM c""")(
    lambda a: h.alert_stats(a, "2024-01-20 00:00:00", "7 days"))
check("q53_alert_list", "alerts", oracle="""SELECT *, CASE alert_type WHEN 'heart_rate' THEN 'Heart Rate Abnormality' WHEN 'blood_oxygen' THEN 'Blood Oxygen Abnormality'
      WHEN 'blood_glucose' THEN 'Blood Glucose Abnormality' WHEN 'other' THEN 'Unknown' ELSE 'Multi-index Deterioration' END AS alert_type_text,
      if(alert_level = 'level1', 'Level 1 (Warning)', 'Level 2 (Critical)') AS alert_level_text, upper(handle_status[1]) || handle_status[2:] AS handle_status_text
    FROM alerts WHERE alert_time >= TIMESTAMP '2024-01-20' - INTERVAL 7 DAY AND alert_level = 'level1' AND handle_status = 'pending'""")(
    lambda a: h.alert_list(a, "level1", "pending", "2024-01-20 00:00:00", "7 days"))
check("q53_set_alert_status", "alerts", "handled", oracle="""
    SELECT a.* REPLACE (coalesce(h.handle_status, a.handle_status) AS handle_status, coalesce(h.handle_time, a.handle_time) AS handle_time)
    FROM alerts a LEFT JOIN handled h USING (alert_id)""")(h.set_alert_status)
