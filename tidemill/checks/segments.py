"""Checks for customer segmentation."""

from tidemill.checks.harness import check, declare
from tidemill.plans import segments as s

declare(
    shop_events="""SELECT 'u' || user_id AS user_id, event_id, CASE event_type WHEN 'signup' THEN 'cart' WHEN 'click' THEN 'cart' WHEN 'error' THEN 'view' ELSE event_type END AS event_type,
        value AS price, ts - CAST(user_id % 4 AS INT) * INTERVAL '20' DAY AS event_time FROM {events}""",
    shop_orders="""SELECT o_orderkey AS order_id, 'u' || o_custkey AS user_id, CASE o_orderstatus WHEN 'P' THEN 'open' ELSE 'completed' END AS order_status,
        floor(o_totalprice / 800) AS price, o_orderdate + CAST(o_orderkey % 24 AS INT) * INTERVAL '1' HOUR AS order_time FROM {orders}""",
)

_NOW = "TIMESTAMP '2024-01-31'"
_CLICKS = f"""SELECT user_id, count(*) FILTER (event_type = 'view') AS view_count, count(*) FILTER (event_type = 'cart') AS cart_count,
    count(*) FILTER (event_type = 'purchase') AS purchase_count FROM shop_events WHERE event_time >= {_NOW} - INTERVAL 2 MONTH GROUP BY 1"""
_ORDERS = """SELECT user_id, count(*) FILTER (order_status = 'completed') AS completed_orders, sum(price)::BIGINT AS total_spent,
    max(order_time) AS last_order_time, (SELECT max(order_time) FROM shop_orders) AS max_order_time FROM shop_orders GROUP BY 1"""


def _steps(value: str, *bounds: object, op: str = ">=") -> str:
    return "CASE " + " ".join(f"WHEN {value} {op} {b} THEN {5 - i}" for i, b in enumerate(bounds)) + " ELSE 1 END"


_SINCE = "(max_order_time - last_order_time)"
_RECENT = [f"INTERVAL {days} DAY" for days in (3, 10, 30, 60)]
_RFM = f"""SELECT user_id, {_steps(_SINCE, *_RECENT, op='<=')} AS r_score,
    {_steps('completed_orders', 15, 8, 5, 2)} AS f_score, {_steps('total_spent', 5000, 2500, 1000, 200)} AS m_score FROM ({_ORDERS})"""
_BEHAVE = f"SELECT user_id, {_steps('view_count', 30, 15, 8, 2)} AS browse_score, {_steps('cart_count', 10, 7, 4, 2)} AS intent_score FROM ({_CLICKS})"
SEGMENTS_ORACLE = f"""SELECT user_id, browse_score, intent_score, coalesce(r_score, 1) AS r_score, coalesce(f_score, 1) AS f_score, coalesce(m_score, 1) AS m_score,
    CASE WHEN least(q.r_score, q.f_score, q.m_score) >= 4 AND browse_score >= 3 AND q.r_score IS NOT NULL THEN 'ACTIVE'
         WHEN q.r_score >= 4 AND q.f_score = 1 THEN 'NEW'
         WHEN browse_score >= 4 AND intent_score >= 3 AND coalesce(q.r_score, 1) <= 2 THEN 'HIGH_POTENTIAL'
         WHEN coalesce(q.r_score, 1) <= 2 AND q.m_score >= 4 THEN 'DORMANT_HIGH_VALUE'
         WHEN least(q.r_score, q.f_score, q.m_score) >= 2 AND q.r_score IS NOT NULL THEN 'AVERAGE_ACTIVE'
         WHEN coalesce(q.r_score, 1) <= 2 AND coalesce(q.f_score, 1) <= 2 THEN 'CHURNED' ELSE 'OTHER' END AS segment
  FROM ({_BEHAVE}) LEFT JOIN ({_RFM}) q USING (user_id)"""

check("q35_click_behaviour", "shop_events", oracle=_CLICKS)(lambda e: s.click_behaviour(e, "2024-01-31 00:00:00"))
check("q36_order_behaviour", "shop_orders", oracle=_ORDERS)(s.order_behaviour)
check("q37_rfm_scores", "shop_orders", oracle=_RFM)(s.rfm_scores)
check("q38_behaviour_scores", "shop_events", oracle=_BEHAVE)(lambda e: s.behaviour_scores(e, "2024-01-31 00:00:00"))
check("q39_customer_segments", "shop_events", "shop_orders", oracle=SEGMENTS_ORACLE)(
    lambda e, o: s.customer_segments(e, o, "2024-01-31 00:00:00"))
check("q39_segment_counts", "shop_events", "shop_orders", oracle=f"""
    SELECT segment, count(*) AS user_count FROM ({SEGMENTS_ORACLE}) GROUP BY 1""")(
    lambda e, o: s.segment_counts(s.customer_segments(e, o, "2024-01-31 00:00:00")))
