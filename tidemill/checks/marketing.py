"""Checks for marketing."""

from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.plans import marketing as m

declare(
    marketing_events="""SELECT event_id, user_id, 'c' || user_id % 6 AS campaign_id, CASE WHEN user_id % 3 = 0 THEN 'email' ELSE 'social' END AS channel_type,
        CASE event_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'conversion' ELSE event_type END AS event_type,
        CAST(value AS DECIMAL(18,2)) AS amount, 'src' || user_id % 2 AS utm_source, 'med' || event_id % 2 AS utm_medium,
        CASE WHEN event_id % 5 > 0 THEN 'v' || event_id % 5 END AS variant_id, ts AS timestamp
        FROM (SELECT * FROM {events} UNION ALL SELECT * FROM {events} WHERE value > 50)""",
    campaigns="""SELECT 'c' || n_nationkey AS campaign_id, n_name AS campaign_name,
        CASE WHEN n_nationkey % 2 = 0 THEN 'ab_test' ELSE 'brand' END AS campaign_type FROM {nation}""",
    variants="""SELECT 'v' || r_regionkey AS variant_id, r_name AS variant_name,
        CASE WHEN r_regionkey % 2 = 0 THEN 'control' ELSE 'treatment' END AS variant_type FROM {region}""",
)

_WIN = "time_bucket(INTERVAL '1 day', timestamp) AS window_start, window_start + INTERVAL 1 DAY AS window_end"
# Some events arrive twice: counts are of different events, sums of all rows.
_FUNNEL = """count(DISTINCT event_id) FILTER (event_type = 'impression') AS impressions, count(DISTINCT event_id) FILTER (event_type = 'click') AS clicks,
    count(DISTINCT event_id) FILTER (event_type = 'conversion') AS conversions,
    coalesce(sum(amount) FILTER (event_type = 'conversion'), 0)::DOUBLE AS revenue"""
_PERF = f"""SELECT {_WIN}, campaign_id, campaign_name, campaign_type, {_FUNNEL},
    clicks::DOUBLE / nullif(impressions, 0) AS ctr, conversions::DOUBLE / nullif(clicks, 0) AS conversion_rate
    FROM marketing_events JOIN campaigns USING (campaign_id) GROUP BY ALL"""
_CHANNEL = f"""SELECT {_WIN}, channel_type, utm_source, utm_medium, count(DISTINCT user_id) AS unique_users,
    count(DISTINCT event_id) FILTER (event_type = 'conversion') AS conversions, coalesce(sum(amount) FILTER (event_type = 'conversion'), 0)::DOUBLE AS revenue,
    revenue / nullif(conversions, 0) AS avg_order_value FROM marketing_events GROUP BY ALL"""
_AB = f"""SELECT {_WIN}, campaign_id, campaign_name, variant_name, variant_type, {_FUNNEL},
    conversions::DOUBLE / nullif(clicks, 0) AS conversion_rate
    FROM marketing_events JOIN campaigns USING (campaign_id) JOIN variants USING (variant_id)
    WHERE campaign_type = 'ab_test' GROUP BY ALL"""

check("q13_campaign_performance", "marketing_events", "campaigns", oracle=_PERF)(
    lambda e, c: m.campaign_performance(e, c, "1 day"))
check("q14_channel_attribution", "marketing_events", oracle=_CHANNEL)(lambda e: m.channel_attribution(e, "1 day"))
check("q15_ab_test_results", "marketing_events", "campaigns", "variants", oracle=_AB)(
    lambda e, c, v: m.ab_test_results(e, c, v, "1 day"))
check("q16_events_over_time", "marketing_events", oracle="""
    SELECT time_bucket(INTERVAL '1 hour', timestamp) AS time_slot, event_type, count(*) AS total_events
    FROM marketing_events GROUP BY ALL""")(lambda e: m.events_over_time(e, "1 hour"))
check("q16_revenue_over_time", "marketing_events", "campaigns", oracle=f"""
    SELECT time_bucket(INTERVAL '5 days', window_start, TIMESTAMP '1970-01-01') AS time_slot, campaign_id,
      sum(revenue::DECIMAL(18,2))::DOUBLE AS revenue_over_time FROM ({_PERF}) GROUP BY ALL""")(
    lambda e, c: m.revenue_over_time(m.campaign_performance(e, c, "1 day"), "5 days"))
check("q16_revenue_by_channel", "marketing_events", oracle=f"""
    SELECT window_start AS time_slot, channel_type, sum(revenue::DECIMAL(18,2))::DOUBLE AS revenue_by_channel FROM ({_CHANNEL}) GROUP BY ALL""")(
    lambda e: m.revenue_by_channel(m.channel_attribution(e, "1 day"), "1 day"))
check("q16_conversion_by_variant", "marketing_events", "campaigns", "variants", oracle=f"""
    SELECT window_start AS time_slot, variant_name, round(avg(conversion_rate), 9) AS average_conversion_rate FROM ({_AB}) GROUP BY ALL""")(
    lambda e, c, v: m.conversion_by_variant(m.ab_test_results(e, c, v, "1 day"), "1 day").withColumn(
        "average_conversion_rate", F.round("average_conversion_rate", 9)))
