"""Checks for sales."""

from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.plans import sales as s

declare(
    products="SELECT CASE WHEN p_size > 3 THEN p_partkey ELSE -p_partkey END AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category FROM {part}",
    item_sales="""SELECT l_orderkey AS sale_id, l_orderkey % 900 AS user_id, l_partkey AS product_id, l_shipdate + (l_orderkey % 24) * INTERVAL '1' HOUR AS sale_timestamp,
        CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS total_price FROM {lineitem}""",
    logins="""SELECT c_custkey AS user_id, c_name AS username, c_mktsegment AS email, TIMESTAMP '2024-01-01 00:00:00' + (c_custkey * 37) * INTERVAL '1' MINUTE AS last_login FROM {customer}""",
    inflow="""SELECT l_orderkey AS order_id, 'c' || l_suppkey AS customer_id, CAST(l_quantity AS BIGINT) AS quant_in, CAST(l_extendedprice AS DECIMAL(18,2)) AS tot_amnt_in
        FROM {lineitem} WHERE l_returnflag = 'A'""",
    outflow="""SELECT l_orderkey AS order_id, 'c' || l_suppkey AS customer_id, CAST(l_quantity AS BIGINT) AS quant_out, CAST(l_extendedprice AS DECIMAL(18,2)) AS tot_amnt_out,
        CAST(l_shipdate + (l_orderkey % 24) * INTERVAL '1' HOUR AS STRING) AS ts FROM {lineitem} WHERE l_returnflag <> 'A'""",
    risk_rows="SELECT event_id AS id, event_id % 11 AS risk, CAST(floor(value * 10) AS BIGINT) AS cost, ts AS time FROM {events}",
    topic_sales="""SELECT l_orderkey AS transaction_id, p_type AS product_category, CASE l_linestatus WHEN 'O' THEN 'online' ELSE 'store' END AS sales_channel,
        'r' || l_suppkey % 6 AS region, CAST(l_shipdate AS DATE) AS date, l_returnflag AS customer_segment, 'pay' || l_linenumber % 4 AS payment_method,
        CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount, CAST(l_extendedprice AS DECIMAL(18,2)) - 900 AS profit_amount
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
)

_W = "time_bucket(INTERVAL '1 day', {0}) AS window_start, window_start + INTERVAL '1 day' AS window_end"
check("q63_sales_per_window", "item_sales", "products", oracle=f"""
    SELECT sale_id, product_id, sum(total_price)::DOUBLE AS total_sales, round(sum(total_price)::DOUBLE / count(*), 4) AS average_revenue_per_sale, {_W.format('sale_timestamp')}
    FROM item_sales SEMI JOIN products USING (product_id) GROUP BY ALL""")(
    lambda a, p: s.sales_per_window(a, p, "1 day").withColumn("average_revenue_per_sale", F.round("average_revenue_per_sale", 4)))
check("q64_active_users", "logins", oracle=f"""SELECT {_W.format('last_login')}, count(DISTINCT user_id) AS total_active_users FROM logins GROUP BY ALL""")(
    lambda u: s.active_users(u, "1 day"))
check("q65_top_products", "item_sales", "products", oracle=f"""
    SELECT category, product_name, sum(quantity)::BIGINT AS total_quantity_sold, {_W.format('sale_timestamp')}
    FROM item_sales JOIN products USING (product_id) GROUP BY ALL ORDER BY total_quantity_sold DESC, category, product_name, window_start LIMIT 5""")(
    lambda a, p: s.top_products(a, p, "1 day"))
check("q65_top_spenders", "logins", "item_sales", oracle=f"""
    SELECT user_id, username, email, sum(total_price)::DOUBLE AS total_spent, {_W.format('last_login')}
    FROM logins JOIN item_sales USING (user_id) GROUP BY ALL ORDER BY total_spent DESC, user_id LIMIT 10""")(
    lambda u, a: s.top_spenders(u, a, "1 day"))
check("q98_net_purchases", "inflow", "outflow", oracle="""
    SELECT customer_id, (sum(quant_in) - sum(quant_out))::BIGINT AS quant_tot, (sum(tot_amnt_in) - sum(tot_amnt_out))::DOUBLE AS amnt_tot
    FROM inflow JOIN outflow USING (customer_id) GROUP BY 1""")(s.net_purchases)
check("q99_outgoing_per_window", "outflow", oracle="""
    SELECT time_bucket(INTERVAL '6 hours', ts::TIMESTAMP) + INTERVAL 6 HOUR AS window_end, sum(quant_out)::BIGINT AS quant_out, sum(tot_amnt_out)::DOUBLE AS tot_amnt_out
    FROM outflow GROUP BY 1""")(lambda o: s.outgoing_per_window(o, "6 hours"))
check("q109_highest_risk", "risk_rows", oracle="SELECT id, risk, time FROM risk_rows QUALIFY risk = max(risk) OVER ()")(s.highest_risk)
check("q109_cost_by_risk", "risk_rows", oracle="""
    SELECT risk, count(*) AS user_count, sum(cost)::BIGINT AS total_cost, avg(cost) AS avg_cost FROM risk_rows GROUP BY 1""")(s.cost_by_risk)
_ROLL = "count(*) AS transactions, sum(quantity)::BIGINT AS units, sum(total_amount)::DOUBLE AS revenue, sum(profit_amount)::DOUBLE AS profit"
for _name, _keys, _more in (
    ("by_category", "product_category", ", profit / revenue AS margin"), ("by_channel", "sales_channel", ""),
    ("by_region_and_day", "region, date::TIMESTAMP AS date", ""), ("by_segment", "customer_segment", ", revenue / transactions AS average_order"),
    ("by_payment", "payment_method", ""),
):
    check(f"q110_sales_{_name}", "topic_sales", oracle=f"SELECT {_keys}, {_ROLL}{_more} FROM topic_sales GROUP BY ALL")(
        lambda t, name=_name: s.topic_rollups(t)[name])
