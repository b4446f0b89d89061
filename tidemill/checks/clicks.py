"""Checks for the clickstream."""

from tidemill.checks.harness import check, declare
from tidemill.plans import clicks as c

declare(
    click_events="""SELECT event_id, user_id, 's' || user_id AS session_id,
        CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'checkout_start' ELSE event_type END AS event_type,
        'http://p/' || event_id % 60 AS page_url, 'el' || event_id % 5 AS element_id, ts AS event_time, 'ref' || event_id % 3 AS referrer, 'c' || event_id % 8 AS campaign_id,
        CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS DOUBLE) END AS revenue_usd, ts + INTERVAL '1' SECOND AS ingested_at FROM {events}""",
    click_users="""SELECT c_custkey AS user_id, c_name AS full_name, 'N' || c_nationkey AS country, c_acctbal > 3000 AS marketing_opt_in, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at FROM {customer}
        UNION ALL SELECT c_custkey, c_name || '!', 'M' || c_nationkey, c_acctbal > 5000, TIMESTAMP '2024-01-02 00:00:00' FROM {customer} WHERE c_custkey % 3 = 0""",
    click_sessions="""SELECT CASE WHEN c_custkey % 10 = 0 THEN 'x' ELSE 's' END || c_custkey AS session_id, c_custkey AS user_id, 'd' || c_custkey % 30 AS device_id, TIMESTAMP '2024-01-01 00:00:00' AS session_start, 'city' || c_custkey % 9 AS geo_city,
        'g' || c_custkey % 4 AS geo_region, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at FROM {customer}""",
    click_devices="""SELECT 'd' || n_nationkey AS device_id, CASE WHEN n_nationkey % 3 = 0 THEN 'mobile' ELSE 'desktop' END AS device_type, 'os' || n_nationkey % 4 AS os, 'b' || n_nationkey % 5 AS browser,
        TIMESTAMP '2024-01-01 00:00:00' AS ingested_at FROM {nation}""",
    click_pages="""SELECT 'http://p/' || p_partkey AS page_url, p_type AS page_category, p_partkey AS product_id, p_brand AS product_category, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at FROM {part}""",
    click_campaigns="""SELECT 'c' || r_regionkey AS campaign_id, r_name AS source, 'cpc' AS medium, 'k' || r_regionkey AS campaign, 'x' AS content, 'y' AS term, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at FROM {region}""",
    funnel_carts="SELECT user_id, event_type AS item_id, ts AS event_time FROM {events} WHERE event_type IN ('click', 'signup') UNION ALL SELECT user_id, 'border', date_trunc('day', ts) FROM {events} WHERE event_type = 'error'",
    funnel_views="SELECT user_id, props AS page_id, ts AS event_time FROM {events} WHERE event_type = 'view'",
    funnel_buys="SELECT user_id, value AS amount, ts AS event_time FROM {events} WHERE event_type = 'purchase'",
)

_DIMS = ("click_users", "click_sessions", "click_devices", "click_pages", "click_campaigns")
_USERS = "(SELECT DISTINCT ON (user_id) * FROM click_users ORDER BY user_id, ingested_at DESC)"
_RICH = f"""SELECT e.event_id, event_time, e.ingested_at, event_type, e.user_id, full_name, country, marketing_opt_in, s.session_id, session_start, geo_city, geo_region, device_type, os, browser,
    e.page_url, page_category, product_id, product_category, element_id, referrer, source AS campaign_source, medium AS campaign_medium, campaign AS campaign_name, content AS campaign_content,
    term AS campaign_term, revenue_usd FROM click_events e LEFT JOIN {_USERS} u USING (user_id) LEFT JOIN click_sessions s USING (session_id) LEFT JOIN click_devices d USING (device_id)
    LEFT JOIN click_pages p USING (page_url) LEFT JOIN click_campaigns c USING (campaign_id)"""
check("q100_enriched_clicks", "click_events", *_DIMS, oracle=_RICH)(c.enriched_clicks)

_KINDS = {"page_view": "page_views", "click": "clicks", "add_to_cart": "add_to_cart", "checkout_start": "checkout_start", "purchase": "purchases"}
_SESSION = f"""SELECT s.session_id, s.user_id, any_value(country) AS country, any_value(device_type) AS device_type, min(event_time) AS first_event_time, max(event_time) AS last_event_time,
    round(epoch_us(max(event_time) - min(event_time)) / 1000000)::BIGINT AS session_duration_seconds, {', '.join(f"count(*) FILTER (event_type = '{k}') AS {v}" for k, v in _KINDS.items())},
    coalesce(sum(revenue_usd), 0) AS revenue_usd, count(*) FILTER (event_type = 'add_to_cart') > 0 AS did_add_to_cart, count(*) FILTER (event_type = 'purchase') > 0 AS did_purchase
  FROM click_sessions s LEFT JOIN click_events e USING (session_id) LEFT JOIN {_USERS} u ON u.user_id = s.user_id LEFT JOIN click_devices d USING (device_id) GROUP BY ALL"""
_SARGS = ("click_sessions", "click_events", "click_users", "click_devices")
check("q101_session_figures", *_SARGS, oracle=_SESSION)(c.session_figures)
check("q102_live_traffic", "click_events", oracle="""SELECT date_trunc('hour', event_time) AS minute, count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases,
    sum(coalesce(revenue_usd, 0)) AS revenue FROM click_events WHERE event_time > TIMESTAMP '2024-01-25' GROUP BY 1""")(
    lambda e: c.live_traffic(e, "2024-01-30 00:00:00", "5 days", "hour"))
check("q103_top_pages", "click_events", *_DIMS, oracle=f"""SELECT page_url, count(*) AS views FROM ({_RICH}) WHERE event_type = 'page_view' AND event_time > TIMESTAMP '2024-01-20'
    GROUP BY 1 ORDER BY views DESC, page_url LIMIT 10""")(lambda *a: c.top_pages(c.enriched_clicks(*a), "2024-01-30 00:00:00", "10 days"))
check("q104_conversion_by_device", *_SARGS, oracle=f"""SELECT device_type, count(*) FILTER (did_purchase) AS converted_sessions, count(*) AS sessions,
    round((100 * count(*) FILTER (did_purchase) / count(*))::DECIMAL(38,10), 2)::DOUBLE AS conversion_rate_pct FROM ({_SESSION}) GROUP BY device_type""")(
    lambda *a: c.conversion_by_device(c.session_figures(*a)))
check("q112_conversion_funnel", "funnel_views", "funnel_carts", "funnel_buys", oracle="""
    WITH w AS (SELECT *, time_bucket(INTERVAL '1 day', event_time) AS window_start FROM funnel_views),
      n AS (SELECT window_start, count(DISTINCT w.user_id) AS viewers, count(DISTINCT k.user_id) AS carters, count(DISTINCT b.user_id) AS purchasers FROM w
        LEFT JOIN funnel_carts k ON k.user_id = w.user_id AND k.event_time BETWEEN window_start AND window_start + INTERVAL 1 DAY
        LEFT JOIN funnel_buys b ON b.user_id = w.user_id AND b.event_time BETWEEN window_start AND window_start + INTERVAL 1 DAY GROUP BY 1)
    SELECT *, coalesce(round((carters / nullif(viewers, 0))::DECIMAL(38,10), 2), 0)::DOUBLE AS view_to_cart_rate,
      coalesce(round((purchasers / nullif(carters, 0))::DECIMAL(38,10), 2), 0)::DOUBLE AS cart_to_buy_rate FROM n""")(
    lambda v, k, b: c.conversion_funnel(v, k, b, "1 day"))
