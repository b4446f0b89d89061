"""Checks for inventory and pricing."""

from tidemill.checks.harness import check, declare
from tidemill.plans import pricing as p
from tidemill.session import stored

declare(
    product_inventory="""SELECT p_partkey AS product_id, p_name AS product_name, 5 + p_size AS stock_level, CAST(p_size AS BIGINT) AS reorder_threshold,
        CAST(p_retailprice AS DECIMAL(10,2)) AS base_price FROM {part}""",
    purchases="""SELECT l_partkey AS product_id, l_shipdate + (l_orderkey % 1440) * INTERVAL '1' MINUTE AS purchase_time,
        CAST(l_quantity AS BIGINT) AS quantity_purchased, l_orderkey AS customer_id FROM {lineitem} WHERE l_returnflag <> 'R'""",
    restocks="""SELECT CASE WHEN l_partkey % 9 = 0 THEN -l_partkey ELSE l_partkey END AS product_id, l_shipdate + (l_orderkey % 1440) * INTERVAL '1' MINUTE AS restock_time,
        CAST(l_quantity AS BIGINT) * 2 AS quantity_restocked FROM {lineitem} WHERE l_returnflag = 'R'""",
    web_clicks="""SELECT l_partkey AS product_id, l_shipdate + (l_suppkey % 24) * INTERVAL '1' HOUR AS event_time, l_linestatus AS event_type FROM {lineitem}""",
    offers="""SELECT CASE WHEN l_partkey % 5 = 0 THEN -l_partkey ELSE l_partkey END AS product_id, 'k' || l_suppkey % 4 AS competitor, CAST(900 + floor((l_extendedprice / l_quantity) / 20) AS DECIMAL(12,2)) AS competitor_price,
        l_shipdate AS ts FROM {lineitem}""",
    product_orders="""SELECT l_orderkey AS order_id, l_partkey AS product_id, l_shipdate + INTERVAL '12' HOUR AS order_time,
        CAST(l_quantity AS BIGINT) AS quantity FROM {lineitem}""",
)

_DELTAS = """SELECT product_id, window_start, coalesce(sum(b), 0)::BIGINT AS total_purchased, coalesce(sum(r), 0)::BIGINT AS total_restocked FROM (
    SELECT product_id, time_bucket(INTERVAL '1 day', purchase_time) AS window_start, quantity_purchased AS b, NULL AS r FROM purchases UNION ALL
    SELECT product_id, time_bucket(INTERVAL '1 day', restock_time), NULL, quantity_restocked FROM restocks) GROUP BY ALL"""
_CTE = f"""deltas AS ({_DELTAS}), lvl AS (SELECT i.*, d.window_start AS inventory_window,
      (stock_level + sum(coalesce(total_restocked - total_purchased, 0)) OVER (PARTITION BY i.product_id ORDER BY d.window_start))::BIGINT AS current_inventory
    FROM product_inventory i LEFT JOIN deltas d USING (product_id)),
  status AS (SELECT product_id, product_name, inventory_window, current_inventory, base_price, reorder_threshold,
      CASE WHEN current_inventory < 20 THEN 'Low' WHEN current_inventory <= 50 THEN 'Medium' ELSE 'High' END AS stock_level_category FROM lvl),
  ruled AS (SELECT *, base_price * CASE stock_level_category WHEN 'Low' THEN 1.2 WHEN 'High' THEN 0.9 ELSE 1.0 END AS rule FROM status),
  prices AS (SELECT * EXCLUDE (rule, reorder_threshold), round(rule, 2)::DECIMAL(12,2) AS new_price FROM ruled)"""
_SALES = """SELECT s.product_id, p.product_name, sum(quantity_purchased)::BIGINT AS total_purchased,
      sum(new_price * quantity_purchased)::DOUBLE AS total_profit
    FROM purchases s ASOF LEFT JOIN (SELECT * FROM prices WHERE inventory_window IS NOT NULL) p
      ON p.product_id = s.product_id AND s.purchase_time >= p.inventory_window GROUP BY ALL"""
_ELASTIC = """SELECT s.product_id, n.product_name, new_price::DOUBLE AS price_range, (sum(quantity_purchased) * any_value(k))::BIGINT AS total_quantity,
      (sum(quantity_purchased * new_price) * any_value(k))::DOUBLE AS total_revenue, total_quantity::DOUBLE AS avg_quantity_sold
    FROM purchases s ASOF JOIN (SELECT * FROM prices WHERE inventory_window IS NOT NULL) p
      ON p.product_id = s.product_id AND s.purchase_time >= p.inventory_window
    JOIN (SELECT product_id, product_name, count(*) AS k FROM status GROUP BY ALL) n ON n.product_id = s.product_id GROUP BY ALL"""
_BASE = ("product_inventory", "purchases", "restocks")


SLOT = "60 days"  # windows of one day: at most 60 rows of a product in a slice


def _status(i, b, r):
    return p.stock_status(i, b, r, "1 day")


def _prices(i, b, r):
    return p.stock_rule_prices(_status(i, b, r))


def _sales(i, b, r):
    return p.sales_at_price(b, p.stock_rule_prices(stored(_status(i, b, r))), SLOT)


def _elasticity(i, b, r):
    status = stored(_status(i, b, r))
    return p.demand_elasticity(b, p.stock_rule_prices(status), status, SLOT)


check("q29_stock_status", *_BASE, oracle=f"WITH {_CTE} SELECT * REPLACE (base_price::DOUBLE AS base_price) FROM status")(_status)
check("q30_stock_rule_prices", *_BASE, oracle=f"WITH {_CTE} SELECT * REPLACE (base_price::DOUBLE AS base_price, new_price::DOUBLE AS new_price) FROM prices")(_prices)
check("q31_sales_at_price", *_BASE, oracle=f"WITH {_CTE} {_SALES}")(_sales)
check("q32_excess_inventory", *_BASE, oracle=f"""WITH {_CTE} SELECT product_id, product_name,
      time_bucket(INTERVAL '5 days', inventory_window, TIMESTAMP '1970-01-01') AS window_start, sum(current_inventory)::BIGINT AS current_inventory,
      avg(reorder_threshold) AS reorder_level, if(sum(current_inventory) > 1.5 * avg(reorder_threshold), 'Excess', 'Normal') AS inventory_status
    FROM status WHERE inventory_window IS NOT NULL GROUP BY ALL""")(lambda *a: p.excess_inventory(_status(*a), "5 days"))
check("q33_demand_elasticity", *_BASE, oracle=f"WITH {_CTE} {_ELASTIC}")(
    _elasticity)
check("q34_latest_prices", *_BASE, oracle=f"""WITH {_CTE} SELECT DISTINCT ON (product_id) product_id, product_name, inventory_window,
      base_price::DOUBLE AS base_price, new_price::DOUBLE AS new_price FROM prices ORDER BY product_id, inventory_window DESC""")(
    lambda *a: p.latest_prices(_prices(*a)))
check("q34_latest_stock", *_BASE, oracle=f"""WITH {_CTE} SELECT DISTINCT ON (product_id) product_id, product_name, inventory_window,
      current_inventory, stock_level_category FROM status ORDER BY product_id, inventory_window DESC""")(
    lambda *a: p.latest_stock(_status(*a)))
check("q34_revenue_by_price", *_BASE, oracle=f"""WITH {_CTE} SELECT product_id, product_name, price_range, total_quantity AS total_quantity_sold,
      total_revenue FROM ({_ELASTIC})""")(
    lambda *a: p.revenue_by_price(_elasticity(*a)))
check("q34_profit_ranking", *_BASE, oracle=f"WITH {_CTE} SELECT product_id::VARCHAR AS product_id, total_profit FROM ({_SALES})")(
    lambda *a: p.profit_ranking(_sales(*a)))
check("q34_units_ranking", *_BASE, oracle=f"WITH {_CTE} SELECT product_id::VARCHAR AS product_id, total_purchased FROM ({_SALES})")(
    lambda *a: p.profit_ranking(_sales(*a), "total_purchased"))

check("q57_minute_deltas", "purchases", "restocks", oracle=_DELTAS)(lambda b, r: p.minute_deltas(b, r, "1 day"))
check("q58_live_stock", *_BASE, oracle=f"""WITH {_CTE} SELECT product_id, inventory_window, current_inventory, stock_level_category FROM status""")(
    lambda *a: _status(*a).select("product_id", "inventory_window", "current_inventory", "stock_level_category"))
_CLICKS = "SELECT product_id, time_bucket(INTERVAL '1 day', event_time) AS window_start, count(*) AS clicks FROM web_clicks GROUP BY ALL"
_RIVAL = "SELECT product_id, competitor, max_by(competitor_price, (ts, competitor_price)) AS competitor_price, max(ts) AS ts FROM offers GROUP BY ALL"
check("q59_clicks_per_window", "web_clicks", oracle=_CLICKS)(lambda c: p.clicks_per_window(c, "1 day"))
check("q60_latest_competitor_prices", "offers", oracle=f"SELECT * REPLACE (competitor_price::DOUBLE AS competitor_price) FROM ({_RIVAL})")(
    p.latest_competitor_prices)
check("q60_lowest_competitor_price", "offers", oracle=f"""
    SELECT product_id, min(competitor_price)::DOUBLE AS min_competitor_price FROM ({_RIVAL}) GROUP BY 1""")(p.lowest_competitor_price)
_FINAL = f"""{_CTE}, demand AS (SELECT product_id, window_start AS inventory_window, sum(clicks) OVER (PARTITION BY product_id ORDER BY window_start
      RANGE BETWEEN INTERVAL '90 days' PRECEDING AND CURRENT ROW)::BIGINT AS clicks_15m FROM ({_CLICKS})),
  rival AS (SELECT product_id, min(competitor_price) AS low FROM ({_RIVAL}) GROUP BY 1),
  final AS (SELECT r.*, clicks_15m, low, greatest(round(CASE WHEN base_price <= low AND coalesce(clicks_15m, 0) > 1 THEN rule * 1.02
      WHEN rule > low THEN rule * 0.99 ELSE rule END, 2), round(base_price * 0.5, 2)) AS final_price
    FROM ruled r LEFT JOIN demand USING (product_id, inventory_window) LEFT JOIN rival USING (product_id))"""


def _final(i, b, r, c, o):
    return p.enriched_prices(_status(i, b, r), c, o, "1 day", "90 days", busy=1)


check("q61_enriched_prices", *_BASE, "web_clicks", "offers", oracle=f"""WITH {_FINAL} SELECT product_id, product_name, inventory_window, current_inventory,
      stock_level_category, base_price::DOUBLE AS base_price, clicks_15m, low::DOUBLE AS min_competitor_price,
      round(rule, 2)::DOUBLE AS stock_rule_price, final_price::DOUBLE AS final_price FROM final""")(_final)
check("q62_order_revenue", *_BASE, "web_clicks", "offers", "product_orders", oracle=f"""WITH {_FINAL}
    SELECT o.product_id, any_value(i.product_name) AS product_name, sum(quantity)::BIGINT AS total_orders,
      sum(final_price * quantity)::DOUBLE AS revenue_estimate
    FROM product_orders o ASOF LEFT JOIN (SELECT * FROM final WHERE inventory_window IS NOT NULL) f
      ON f.product_id = o.product_id AND o.order_time >= f.inventory_window
    LEFT JOIN product_inventory i ON i.product_id = o.product_id GROUP BY o.product_id""")(
    lambda i, b, r, c, o, q: p.order_revenue(q, stored(_final(i, b, r, c, o).select("product_id", "inventory_window", "final_price")), i, SLOT))
