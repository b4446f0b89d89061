"""Checks for visits, request logs and page edits."""

from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.plans import web

declare(
    visits="""SELECT ts AS timestamp, user_id, event_type AS page_id, CASE WHEN value < 200 THEN 'scroll' ELSE 'click' END AS action
              FROM {events}""",
    members="""SELECT c_custkey AS id, c_name AS name, 18 + c_custkey % 50 AS age, 'city ' || c_nationkey AS city FROM {customer}""",
    user_actions="""SELECT ts AS action_time, user_id, event_type AS page_id, CASE WHEN value > 5 THEN event_type END AS action
                    FROM {events}""",
    user_names="""SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END AS user_id, c_name AS first_name, c_mktsegment AS last_name, 18 + c_custkey % 50 AS age
                  FROM {customer}""",
    web_logs="""SELECT ts AS request_timestamp, 'u' || user_id AS username, CAST(floor(value) AS BIGINT) AS response_time,
                  CASE WHEN event_type = 'error' THEN 400 + user_id % 5 ELSE 200 + event_id % 3 END AS status_code,
                  CASE event_type WHEN 'signup' THEN 'login' WHEN 'purchase' THEN 'submit_form' WHEN 'view' THEN 'view_page'
                       WHEN 'click' THEN 'scroll_page' ELSE 'logout' END AS user_action,
                  '10.0.0.' || event_id % 7 AS ip_address, 'ref' || event_id % 4 AS referrer
                FROM {events}""",
    edits="""SELECT 'c' || user_id AS contributor, event_type AS title, ts AS edit_timestamp,
               CASE WHEN user_id % 11 <> 0 THEN TIMESTAMP '2018-06-01 00:00:00' + user_id * INTERVAL '10' DAY END AS registration,
               CASE event_type WHEN 'click' THEN 'male' WHEN 'view' THEN 'female' ELSE 'unknown' END AS gender,
               CASE WHEN value > 3 THEN CAST(CAST(floor(value * 7) AS BIGINT) AS STRING) END AS edit_count
             FROM {events}""",
)


check("q1_page_visits", "visits", oracle="""
    SELECT page_id, count(*) AS total_visits, count(DISTINCT user_id) AS unique_visitors, max(timestamp) AS last_visit_time
    FROM visits GROUP BY ALL""")(web.page_visits)

check("q2_visits_with_users", "visits", "members", oracle="""
    SELECT v.timestamp, v.user_id, m.name AS user_name, m.age AS user_age, v.page_id, v.action
    FROM visits v, members m WHERE m.id = v.user_id""")(web.visits_with_users)

check("q3_popular_pages", "visits", "members", oracle="""
    SELECT page_id, count(DISTINCT user_id) AS total_visits FROM visits JOIN members ON id = user_id
    WHERE age < 35 GROUP BY ALL ORDER BY total_visits DESC, page_id LIMIT 3""")(web.popular_pages)

check("q4_city_average_age", "members", oracle="""
    SELECT * FROM (SELECT city, avg(age) AS avg_age FROM members GROUP BY city) WHERE avg_age >= 42""")(
    lambda members: web.city_average_age(members, 42))

check("q4_city_age_lookup", "members", oracle="""
    SELECT * FROM (SELECT city, avg(age) AS avg_age FROM members GROUP BY city) WHERE avg_age >= 21 AND avg_age < 42""")(
    lambda members: web.city_average_age(members).filter(F.col("avg_age") < 42))

check("q5_actions_per_window", "user_actions", "user_names", oracle="""
    WITH a AS (SELECT user_id, page_id, time_bucket(INTERVAL '6 hours', action_time) + INTERVAL '6 hours' AS window_end,
                      count(action) AS num_actions FROM user_actions GROUP BY ALL)
    SELECT a.user_id, first_name, last_name, age, page_id, num_actions, window_end FROM a LEFT JOIN user_names USING (user_id)""")(
    lambda a, u: web.actions_per_window(a, u, "6 hours"))

check("q88_user_request_metrics", "web_logs", oracle="""
    SELECT username, time_bucket(INTERVAL '1 day', request_timestamp) AS window_start, window_start + INTERVAL 1 DAY AS window_end,
      count(username) AS total_requests, min(response_time) AS min_response_time, max(response_time) AS max_response_time,
      avg(response_time) AS avg_response_time, quantile_cont(response_time, 0.5) AS median_response_time,
      count(*) FILTER (status_code >= 400) AS total_errors, count(*) FILTER (user_action = 'login') AS login_count,
      count(*) FILTER (user_action = 'logout') AS logout_count, count(DISTINCT ip_address) AS unique_ips
    FROM web_logs GROUP BY ALL""")(lambda logs: web.user_request_metrics(logs, "1 day"))

check("q89_top_actions", "web_logs", oracle="""
    WITH c AS (SELECT user_action, time_bucket(INTERVAL '1 hour', request_timestamp) AS window_start, count(*) AS count_user_activity
               FROM web_logs GROUP BY ALL)
    SELECT *, window_start + INTERVAL 1 HOUR AS window_end FROM c
    QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY count_user_activity DESC, user_action) <= 3""")(
    lambda logs: web.top_actions(logs, "1 hour", 3))

check("q90_referrer_activity", "web_logs", oracle="""
    SELECT referrer, time_bucket(INTERVAL '1 hour', request_timestamp) AS window_start, window_start + INTERVAL 1 HOUR AS window_end,
      count(*) AS referrer_visit_count, count(*) FILTER (user_action = 'view_page') AS page_visits,
      count(*) FILTER (user_action IN ('submit_form', 'login', 'logout')) AS interactions,
      count(*) FILTER (user_action = 'scroll_page') AS content_interactions, 0::BIGINT AS window_interactions
    FROM web_logs GROUP BY ALL""")(lambda logs: web.referrer_activity(logs, "1 hour"))

check("q91_status_distribution", "web_logs", oracle="""
    WITH c AS (SELECT status_code, time_bucket(INTERVAL '6 hours', request_timestamp) AS window_start,
                      count(*) AS count_status_code, avg(response_time) AS avg_response_time FROM web_logs GROUP BY ALL),
         r AS (SELECT *, sum(count_status_code) OVER (PARTITION BY window_start ORDER BY status_code)::BIGINT AS cumulative_count,
                      sum(count_status_code) OVER (PARTITION BY window_start)::BIGINT AS n FROM c)
    SELECT status_code, count_status_code, avg_response_time, cumulative_count,
      100.0::DOUBLE * cumulative_count / n AS cumulative_percentage, window_start, window_start + INTERVAL 6 HOUR AS window_end FROM r""")(
    lambda logs: web.status_distribution(logs, "6 hours"))

_CLEAN = "SELECT * REPLACE (edit_count::INTEGER AS edit_count) FROM edits WHERE registration IS NOT NULL AND edit_count IS NOT NULL"

check("q92_clean_edits", "edits", oracle=_CLEAN)(web.clean_edits)


def _split(one: str, other: str, first: str, second: str) -> str:
    return f"""SELECT count(*) AS total_contributions, count(*) FILTER ({one}) AS {first}, count(*) FILTER ({other}) AS {second},
        time_bucket(INTERVAL '1 hour', edit_timestamp) AS window_start, window_start + INTERVAL 1 HOUR AS window_end
        FROM ({_CLEAN}) GROUP BY window_start"""


check("q93_edits_by_gender", "edits", oracle=_split(
    "gender = 'unknown'", "gender <> 'unknown'", "contributions_by_unknown", "contributions_by_male_or_female"))(
    lambda e: web.edits_by_gender(web.clean_edits(e), "1 hour"))
check("q94_edits_by_registration", "edits", oracle=_split(
    "registration < TIMESTAMP '2020-01-01 01:00:00'", "registration > TIMESTAMP '2020-01-01 01:00:00'",
    "contributions_by_someone_registered_before_2020", "contributions_by_someone_registered_after_2020"))(
    lambda e: web.edits_by_registration(web.clean_edits(e), "1 hour"))
check("q95_edits_by_experience", "edits", oracle=_split(
    "edit_count < 1000", "edit_count >= 1000", "contributions_less_than_1000", "contributions_1000_or_more"))(
    lambda e: web.edits_by_experience(web.clean_edits(e), "1 hour"))
