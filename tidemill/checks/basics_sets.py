"""Checks for joins, aggregates, window functions, top-n, set operators and mutations."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.functions import scalar as s
from tidemill.operators import (
    asof_join, band_join, count_where, distinct_where, exact_median, exact_quantile, first_by, hop, lagged, last_by, latest_by, net_of_sums,
    page, previous, range_frame, running_sum, sum_where, top_k, top_n, tumble, update_where, upsert, windows_holding, zero_filled,
)
from tidemill.session import stored

E, L, C, O, P, N, R, S = "events", "lineitem", "customer", "orders", "part", "nation", "region", "supplier"  # noqa: E741

# -- joins ------------------------------------------------------------------------------------

check("j1_inner_join", O, C, oracle="SELECT o_orderkey, c_name FROM orders, customer WHERE c_custkey = o_custkey")(
    lambda o, c: o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", "c_name"))
check("j2_left_join", C, O, oracle="""SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON o_custkey = c_custkey""")(
    lambda c, o: c.join(o.filter("o_orderstatus = 'P'"), F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "o_orderkey"))
check("j3_full_join", L, O, oracle="""SELECT d, coalesce(sum(a), 0)::BIGINT AS ships, coalesce(sum(b), 0)::BIGINT AS books FROM
    (SELECT l_shipdate AS d, 1 AS a, 0 AS b FROM lineitem UNION ALL SELECT o_orderdate, 0, 1 FROM orders) GROUP BY 1""")(
    lambda x, o: x.groupBy(F.col("l_shipdate").alias("d")).agg(F.count("*").alias("ships")).join(
        o.groupBy(F.col("o_orderdate").alias("d")).agg(F.count("*").alias("books")), "d", "full").select(
        "d", zero_filled(F.col("ships")).alias("ships"), zero_filled(F.col("books")).alias("books")))
check("j4_key_and_window_join", E, oracle="""SELECT user_id, window_start, v, c FROM
    (SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS window_start, count(*) AS v FROM events WHERE event_type = 'view' GROUP BY ALL) JOIN
    (SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS window_start, count(*) AS c FROM events WHERE event_type = 'click' GROUP BY ALL) USING (user_id, window_start)""")(
    lambda e: _daily(e, "view", "v").join(_daily(e, "click", "c"), ["user_id", "window_start"]))


def _daily(events, kind, name):
    return tumble(events.filter(F.col("event_type") == kind), "ts", "1 day").groupBy("user_id", "window_start").agg(F.count("*").alias(name))


_VIEWS = "SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'"
_CLICKS = "SELECT event_id AS click_id, user_id AS click_user, ts AS click_ts FROM events WHERE event_type = 'click'"


def _sides(e):
    views = e.filter("event_type = 'view'").select("event_id", "user_id", "ts")
    clicks = e.filter("event_type = 'click'").select(F.col("event_id").alias("click_id"), F.col("user_id").alias("click_user"), F.col("ts").alias("click_ts"))
    return views, clicks


check("j5_band_join", E, oracle=f"""SELECT event_id, click_id FROM ({_VIEWS}) JOIN ({_CLICKS}) ON click_user = user_id AND click_ts BETWEEN ts - INTERVAL 5 HOUR AND ts + INTERVAL 5 HOUR""")(
    lambda e: band_join(*_sides(e), {"user_id": "click_user"}, "ts", "click_ts", "5 hours", "5 hours").select("event_id", "click_id"))
check("j6_lookback_left_join", E, oracle=f"""SELECT event_id, click_id FROM ({_VIEWS}) LEFT JOIN ({_CLICKS}) ON click_user = user_id AND click_ts BETWEEN ts - INTERVAL 3 HOUR AND ts""")(
    lambda e: band_join(*_sides(e), {"user_id": "click_user"}, "ts", "click_ts", before="3 hours", how="left").select("event_id", "click_id"))


def _asof(e, how):
    views, clicks = _sides(e)
    return asof_join(views, clicks.withColumnRenamed("click_user", "user_id"), ["user_id"], "ts", "click_ts", ["click_id", "click_ts"], how)


check("j7_asof_left_join", E, oracle=f"SELECT event_id, user_id, ts, click_id, click_ts FROM ({_VIEWS}) v ASOF LEFT JOIN ({_CLICKS}) c ON c.click_user = v.user_id AND v.ts >= c.click_ts")(
    lambda e: _asof(e, "left"))
check("j8_asof_inner_join", E, oracle=f"SELECT event_id, user_id, ts, click_id, click_ts FROM ({_VIEWS}) v ASOF JOIN ({_CLICKS}) c ON c.click_user = v.user_id AND v.ts >= c.click_ts")(
    lambda e: _asof(e, "inner"))
check("j9_one_row_relation", E, oracle="SELECT event_id, value - q AS above FROM events, (SELECT max_by(value, event_id) AS q FROM events)")(
    lambda e: e.withColumn("q", e.agg(F.max_by("value", "event_id")).scalar()).select("event_id", (F.col("value") - F.col("q")).alias("above")))
check("j10_global_aggregate", O, oracle="SELECT o_custkey, max(o_orderdate) AS last, any_value(m) AS overall FROM orders, (SELECT max(o_orderdate) AS m FROM orders) GROUP BY 1")(
    lambda o: o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last")).withColumn("overall", o.agg(F.max("o_orderdate")).scalar()))
check("j11_multiway_join", L, O, C, N, R, P, S, oracle="""SELECT l_orderkey, l_linenumber, c_name, n_name, r_name, p_name, s_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""")(
    lambda x, o, c, n, r, p, u: x.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("c_custkey") == F.col("o_custkey"), "left")
    .join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(r, F.col("r_regionkey") == F.col("n_regionkey")).join(p, F.col("p_partkey") == F.col("l_partkey"))
    .join(u, F.col("s_suppkey") == F.col("l_suppkey")).select("l_orderkey", "l_linenumber", "c_name", "n_name", "r_name", "p_name", "s_name"))
check("j12_star_join", L, P, S, O, C, N, oracle="""SELECT l_orderkey, l_linenumber, p_brand, s_name, o_orderpriority, c_mktsegment, n_name FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
    LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")(
    lambda x, p, u, o, c, n: x.join(p, F.col("p_partkey") == F.col("l_partkey"), "left").join(u, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    .join(o, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(c, F.col("c_custkey") == F.col("o_custkey"), "left").join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    .select("l_orderkey", "l_linenumber", "p_brand", "s_name", "o_orderpriority", "c_mktsegment", "n_name"))
check("j13_aggregates_to_base", O, L, oracle="SELECT o_orderkey, o_totalprice, q FROM orders JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")(
    lambda o, x: o.join(x.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "o_totalprice", "q"))
check("j14_join_latest", C, E, oracle="SELECT c_custkey, event_id, event_type FROM customer JOIN (SELECT DISTINCT ON (user_id) * FROM events ORDER BY user_id, ts DESC) ON user_id = c_custkey")(
    lambda c, e: c.join(latest_by(e, ["user_id"], ["ts"]), F.col("user_id") == F.col("c_custkey")).select("c_custkey", "event_id", "event_type"))
declare(on_border="SELECT user_id, CASE WHEN event_id % 4 = 0 THEN date_trunc('day', ts) ELSE ts END AS t FROM {events}")
check("j15_windows_holding", "on_border", oracle="""SELECT user_id, t, w AS window_start FROM on_border, (SELECT DISTINCT unnest([date_trunc('day', t), date_trunc('day', t) - INTERVAL 1 DAY]) AS w FROM on_border)
    WHERE t BETWEEN w AND w + INTERVAL 1 DAY""")(lambda b: windows_holding(b, "t", "1 day"))
check("j16_net_of_sums", L, oracle="""SELECT k, sum(a) - sum(b) AS net FROM (SELECT l_suppkey AS k, l_quantity AS a FROM lineitem WHERE l_returnflag = 'A')
    JOIN (SELECT l_suppkey AS k, l_quantity AS b FROM lineitem WHERE l_returnflag = 'R') USING (k) GROUP BY 1""")(
    lambda x: net_of_sums(x.filter("l_returnflag = 'A'").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("a")),
                          x.filter("l_returnflag = 'R'").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("b")), "k", {"net": ("a", "b")}))
check("j17_left_join_filtered", C, O, oracle="SELECT c_custkey, o_orderkey FROM customer, orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'")(
    lambda c, o: c.join(o, F.col("o_custkey") == F.col("c_custkey"), "left").filter("o_orderstatus = 'F'").select("c_custkey", "o_orderkey"))
declare(
    points="SELECT event_id, 1.0E0 + (user_id % 50) * 0.0007E0 AS lat, 103.0E0 + (event_id % 50) * 0.0007E0 AS lon FROM {events}",
    sites="SELECT c_custkey, 1.0E0 + (c_custkey % 50) * 0.0007E0 AS slat, 103.0E0 + (c_custkey % 45) * 0.0007E0 AS slon FROM {customer}",
)
_CELL = "floor({0} / 0.002::DOUBLE)::BIGINT || '_' || floor({1} / 0.002::DOUBLE)::BIGINT"
check("j18_grid_join", "points", "sites", oracle=f"""SELECT event_id, n FROM points JOIN (SELECT {_CELL.format('slat', 'slon')} AS g, count(*) AS n FROM sites GROUP BY 1) ON g = {_CELL.format('lat', 'lon')}""")(
    lambda p, t: p.withColumn("g", s.grid_id("lat", "lon")).join(t.groupBy(s.grid_id("slat", "slon").alias("g")).agg(F.count("*").alias("n")), "g").select("event_id", "n"))

# -- aggregates -----------------------------------------------------------------------------------

check("a1_counts", E, oracle="SELECT event_type, count(*) AS rows, count(nullif(user_id % 5, 0)) AS known FROM events GROUP BY 1")(
    lambda e: e.groupBy("event_type").agg(F.count("*").alias("rows"), F.count(F.nullif(F.col("user_id") % 5, F.lit(0))).alias("known")))
check("a2_sum_avg_min_max", L, oracle="SELECT l_returnflag, sum(l_quantity) AS s, avg(l_quantity) AS a, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY 1")(
    lambda x: x.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("s"), F.avg("l_quantity").alias("a"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi")))
check("a3_count_distinct", E, oracle="SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")(
    lambda e: e.groupBy("event_type").agg(F.count_distinct("user_id").alias("users")))
check("a4_conditional_distinct", E, oracle="SELECT user_id % 10 AS g, count(DISTINCT user_id) FILTER (event_type = 'click') AS clickers FROM events GROUP BY 1")(
    lambda e: e.groupBy((F.col("user_id") % 10).alias("g")).agg(distinct_where(F.col("event_type") == "click", "user_id").alias("clickers")))
check("a5_conditional_sum", E, oracle="SELECT user_id, sum(CASE WHEN event_type = 'click' THEN event_id ELSE 0 END)::BIGINT AS s, count(CASE WHEN value > 50 THEN 1 END) AS n FROM events GROUP BY 1")(
    lambda e: e.groupBy("user_id").agg(sum_where(F.col("event_type") == "click", "event_id").alias("s"), count_where(F.col("value") > 50).alias("n")))
check("a6_filter_clause", E, oracle="SELECT user_id, count(*) FILTER (event_type = 'view') AS views FROM events GROUP BY 1")(
    lambda e: e.groupBy("user_id").agg(count_where(F.col("event_type") == "view").alias("views")))
check("a7_stddev_pop", E, oracle="SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, round(stddev_pop(value), 6) AS sd FROM events GROUP BY 1")(
    lambda e: tumble(e, "ts", "1 day").groupBy("window_start").agg(F.round(F.stddev_pop("value"), 6).alias("sd")))
check("a8_exact_median", E, oracle="SELECT event_type, round(quantile_cont(value, 0.5), 9) AS median FROM events GROUP BY 1")(
    lambda e: exact_median(e, ["event_type"], "value", "median").withColumn("median", F.round("median", 9)))
check("a8_exact_quantile", L, oracle="SELECT l_returnflag, round(quantile_cont(l_extendedprice::DOUBLE, 0.9), 6) AS p90 FROM lineitem GROUP BY 1")(
    lambda x: exact_quantile(x, ["l_returnflag"], "l_extendedprice", "p90", 0.9, limit=2_000).withColumn("p90", F.round("p90", 6)))
check("a9_first_last", E, oracle="SELECT user_id, arg_min(value, ts) AS first, arg_max(value, ts) AS last FROM events GROUP BY 1")(
    lambda e: e.groupBy("user_id").agg(first_by("value", "ts", "event_id").alias("first"), last_by("value", "ts", "event_id").alias("last")))
check("a10_global_aggregate", O, oracle="SELECT max(o_orderdate) AS last, count(*) AS n FROM orders")(
    lambda o: o.agg(F.max("o_orderdate").alias("last"), F.count("*").alias("n")))
check("a11_group_by_expression", E, oracle="SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1")(
    lambda e: e.groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.count("*").alias("n")))
check("a12_guarded_ratio", E, oracle="SELECT user_id, count(*) FILTER (event_type = 'click') / nullif(count(*) FILTER (event_type = 'view' AND value > 150), 0) AS r FROM events GROUP BY 1")(
    lambda e: e.groupBy("user_id").agg(s.ratio(count_where(F.col("event_type") == "click"), count_where((F.col("event_type") == "view") & (F.col("value") > 150))).alias("r")))
check("a13_zero_filled", E, oracle="SELECT user_id, coalesce(sum(event_id) FILTER (value > 300), 0)::BIGINT AS big, coalesce(max(value) FILTER (value > 300), 0) AS top FROM events GROUP BY 1")(
    lambda e: e.groupBy("user_id").agg(zero_filled(F.sum(F.when(F.col("value") > 300, F.col("event_id")))).alias("big"), zero_filled(F.max(F.when(F.col("value") > 300, F.col("value")))).alias("top")))
check("a14_aggregate_of_aggregate", L, oracle="SELECT l_suppkey, max(q) AS best, avg(q) AS mean FROM (SELECT l_suppkey, l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY ALL) GROUP BY 1")(
    lambda x: x.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q")).groupBy("l_suppkey").agg(F.max("q").alias("best"), F.avg("q").alias("mean")))
check("a15_aggregate_by_key_function", E, oracle="SELECT month, count(*) / max(day(ts)) * day(last_day(month)) AS projected FROM (SELECT *, date_trunc('month', ts) AS month FROM events) GROUP BY month")(
    lambda e: e.groupBy(F.date_trunc("month", "ts").alias("month")).agg(F.count("*").alias("n"), F.max(F.dayofmonth("ts")).alias("d")).select(
        "month", (F.col("n") / F.col("d") * s.days_in_month("month")).alias("projected")))
check("a16_any_value_by_max", P, oracle="SELECT p_brand, max(p_name) AS name FROM part GROUP BY 1")(
    lambda p: p.groupBy("p_brand").agg(F.max("p_name").alias("name")))
check("a17_boolean_of_aggregate", E, oracle="SELECT user_id, count(*) FILTER (value > 300) > 0 AS big FROM events GROUP BY 1")(
    lambda e: e.groupBy("user_id").agg((sum_where(F.col("value") > 300, F.lit(1)) > 0).alias("big")))
check("a18_duration", E, oracle="SELECT user_id, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000)::BIGINT AS seconds FROM events GROUP BY 1")(
    lambda e: e.groupBy("user_id").agg(s.seconds_between(F.min("ts"), F.max("ts")).alias("seconds")))
check("a19_tiered_charge", L, oracle="SELECT l_suppkey, l_returnflag, if(sum(l_quantity) <= 5000, sum(l_quantity) * 0.2::DOUBLE, 1000 + (sum(l_quantity) - 5000) * 0.4::DOUBLE) AS bill FROM lineitem GROUP BY ALL")(
    lambda x: x.groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("q")).select("l_suppkey", "l_returnflag", s.tiered_charge("q", 5000, 0.2, 0.4).alias("bill")))
check("a20_status_dashboard", O, oracle="""SELECT count(DISTINCT o_orderkey) AS total, count(*) FILTER (o_orderstatus = 'F') AS filled, count(*) FILTER (o_orderstatus = 'O') AS open,
    round((count(*) FILTER (o_orderstatus = 'F') / count(DISTINCT o_orderkey) * 100)::DECIMAL(38,10), 1)::DOUBLE AS filled_rate FROM orders""")(
    lambda o: o.agg(F.count_distinct("o_orderkey").alias("total"), *[count_where(F.col("o_orderstatus") == k).alias(n) for k, n in (("F", "filled"), ("O", "open"))])
    .withColumn("filled_rate", s.round_numeric(s.ratio("filled", "total") * 100, 1)))

# -- window functions --------------------------------------------------------------------------------

_OVER = "(PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '{0}' PRECEDING AND CURRENT ROW)"
check("w1_rolling_average", E, oracle=f"SELECT event_id, avg(event_id) OVER {_OVER.format('12 hours')} AS a FROM events")(
    lambda e: range_frame(e, ["user_id"], "ts", "12 hours", {"a": ("avg", "event_id")}).select("event_id", "a"))
check("w2_rolling_min_max", E, oracle=f"SELECT event_id, max(value) OVER {_OVER.format('2 days')} AS hi, min(value) OVER {_OVER.format('2 days')} AS lo FROM events")(
    lambda e: range_frame(e, ["user_id"], "ts", "2 days", {"hi": ("max", "value"), "lo": ("min", "value")}, slot="2 days").select("event_id", "hi", "lo"))
check("w3_rolling_stddev", E, oracle=f"SELECT event_id, round(stddev_samp(value) OVER {_OVER.format('12 hours')}, 5) AS sd FROM events")(
    lambda e: range_frame(e, ["user_id"], "ts", "12 hours", {"sd": ("stddev_samp", "value")}).select("event_id", F.round("sd", 5).alias("sd")))
check("w4_running_total", L, oracle="SELECT l_suppkey, l_shipdate, l_orderkey, l_quantity, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS total FROM lineitem")(
    lambda x: running_sum(x.select("l_suppkey", "l_shipdate", "l_orderkey", "l_quantity"), ["l_suppkey"], "l_shipdate", {"total": "l_quantity"}, slot="30 days"))
check("w5_cumulative_share", E, oracle="""SELECT event_type, day(ts) AS d, 100::DOUBLE * sum(count(*)) OVER (PARTITION BY event_type ORDER BY day(ts)) / sum(count(*)) OVER (PARTITION BY event_type) AS pct FROM events GROUP BY 1, 2""")(
    lambda e: e.groupBy("event_type", F.dayofmonth("ts").alias("d")).agg(F.count("*").alias("n")).select("event_type", "d", (
        F.lit(100.0) * F.sum("n").over(Window.partitionBy("event_type").orderBy("d")) / F.sum("n").over(Window.partitionBy("event_type"))).alias("pct")))
check("w6_latest_per_key", E, oracle="SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1")(
    lambda e: latest_by(e, ["user_id", "event_type"], ["ts", "event_id"]))
check("w7_top_n_per_window", E, oracle="""SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, user_id, count(*) AS n, row_number() OVER (PARTITION BY window_start ORDER BY count(*) DESC, user_id) AS rank
    FROM events GROUP BY 1, 2 QUALIFY rank <= 3""")(
    lambda e: top_n(tumble(e, "ts", "1 day").groupBy("window_start", "user_id").agg(F.count("*").alias("n")), ["window_start"], [F.desc("n"), F.asc("user_id")], 3))
check("w8_lag_in_slots", E, oracle="""SELECT event_id, user_id, ts, lag(event_type) OVER w AS before, lag(value, 3) OVER w AS three_back FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id)""")(
    lambda e: lagged(e.select("event_id", "user_id", "ts", "event_type", "value"), ["user_id"], "ts", {"before": ("event_type", 1), "three_back": ("value", 3)}, "2 days", ["event_id"])
    .drop("event_type", "value"))
check("w8_lag", E, oracle="""SELECT user_id, window_end, n, lag(n) OVER (PARTITION BY user_id ORDER BY window_end) AS before FROM
    (SELECT user_id, time_bucket(INTERVAL '1 day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS n FROM events GROUP BY ALL)""")(
    lambda e: previous(tumble(e, "ts", "1 day").groupBy("user_id", "window_end").agg(F.count("*").alias("n")), ["user_id"], "window_end", {"before": "n"}))
check("w9_frame_over_windows", E, oracle="""SELECT user_id, window_start, sum(n) OVER (PARTITION BY user_id ORDER BY window_start RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW)::BIGINT AS n4 FROM
    (SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS window_start, count(*) AS n FROM events GROUP BY ALL)""")(
    lambda e: range_frame(tumble(e, "ts", "1 day").groupBy("user_id", "window_start").agg(F.count("*").alias("n")), ["user_id"], "window_start", "3 days", {"n4": F.sum("n")})
    .select("user_id", "window_start", "n4"))
check("w10_rank_tie_break", L, oracle="""SELECT l_suppkey, l_partkey, q, n, row_number() OVER (PARTITION BY l_suppkey ORDER BY q DESC, n DESC, l_partkey DESC) AS rank FROM
    (SELECT l_suppkey, l_partkey, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY ALL) QUALIFY rank <= 5""")(
    lambda x: top_n(x.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"), F.count("*").alias("n")), ["l_suppkey"], [F.desc("q"), F.desc("n"), F.desc("l_partkey")], 5))

# -- sort, limit, look-up -----------------------------------------------------------------------------

check("t1_order_by", C, oracle="SELECT c_custkey, c_acctbal FROM customer ORDER BY c_nationkey DESC, c_acctbal DESC")(
    lambda c: c.orderBy(F.desc("c_nationkey"), F.desc("c_acctbal")).select("c_custkey", "c_acctbal"))
check("t2_top_k", O, oracle="SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")(
    lambda o: top_k(o.groupBy("o_custkey").agg(F.count("*").alias("n")), [F.desc("n"), F.asc("o_custkey")], 10))
check("t3_any_rows", E)(lambda e: e.limit(5))
check("t3_any_rows_belong", E, oracle="SELECT least(5, count(*)) AS chosen FROM events")(
    lambda e: stored(e.limit(5)).intersectAll(e).agg(F.count(F.lit(1)).alias("chosen")))
check("t4_nulls_last", E, oracle="SELECT event_id, v FROM (SELECT event_id, if(event_type = 'view', NULL, value) AS v FROM events) ORDER BY v DESC NULLS LAST, event_id LIMIT 100")(
    lambda e: top_k(e.select("event_id", F.when(F.col("event_type") != "view", F.col("value")).alias("v")), [F.col("v").desc_nulls_last(), F.asc("event_id")], 100))
check("t5_page", O, oracle="SELECT o_orderkey, o_orderdate, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS total FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 20 OFFSET 40")(
    lambda o: page(o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate"), [F.desc("o_orderdate"), F.asc("o_orderkey")], 20, 40))
check("t6_vector_top_k", "vectors", oracle="""WITH q AS (SELECT max_by(embedding, file_name) AS e FROM vectors)
    SELECT file_name, round(list_sum(list_transform(list_zip(embedding, e), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)) / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))
      * list_sum(list_transform(e, lambda x: x::DOUBLE * x::DOUBLE))), 9) AS similarity FROM vectors, q ORDER BY similarity DESC, file_name LIMIT 10""")(
    lambda v: _nearest(v))
check("t7_lookup", C, oracle="SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42 OR c_acctbal < -900")(
    lambda c: c.filter((F.col("c_custkey") == 42) | (F.col("c_acctbal") < -900)).select("c_custkey", "c_name"))


def _nearest(v):
    from tidemill.plans.corpus import nearest
    return nearest(v, v.agg(F.max_by("embedding", "file_name")).scalar()).withColumn("similarity", F.round("similarity", 9))


# -- set operators, windows, mutations ------------------------------------------------------------------

check("u1_union_all", E, oracle="SELECT event_id, 'view of ' || user_id AS note FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, concat('click at ', value) FROM events WHERE event_type = 'click'")(
    lambda e: e.filter("event_type = 'view'").select("event_id", s.concat_text(F.lit("view of "), "user_id").alias("note")).unionByName(
        e.filter("event_type = 'click'").select("event_id", s.concat_text(F.lit("click at "), "value").alias("note"))))
check("u2_distinct_on", E, oracle="SELECT DISTINCT ON (user_id, event_type, time_bucket(INTERVAL '6 hours', ts)) event_id, user_id, event_type, ts FROM events ORDER BY user_id, event_type, time_bucket(INTERVAL '6 hours', ts), ts DESC")(
    lambda e: latest_by(e.select("event_id", "user_id", "event_type", "ts"), ["user_id", "event_type", s.slot("ts", "6 hours")], ["ts", "event_id"]))
check("st2_hop_batch", E, oracle="SELECT time_bucket(INTERVAL '6 hours', ts) - k * INTERVAL 6 HOUR AS window_start, count(*) AS n FROM events, range(4) t(k) GROUP BY 1")(
    lambda e: hop(e, "ts", "6 hours", "24 hours").groupBy("window_start").agg(F.count("*").alias("n")))
declare(
    late_orders="SELECT o_orderkey, 'LATE' AS o_orderstatus, o_orderdate + INTERVAL '1' DAY AS o_orderdate FROM {orders} WHERE o_orderpriority = '5-LOW'",
    new_orders="SELECT o_orderkey + 7 AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + INTERVAL '1' DAY AS o_orderdate, 'NEW' AS o_orderpriority FROM {orders} WHERE o_orderpriority = '1-URGENT'",
    order_status_feed="""SELECT o_orderkey, 'pending' AS status, 1 AS seq, 'c' AS op FROM {orders} UNION ALL SELECT o_orderkey, 'paid', 2, 'u' FROM {orders} WHERE o_orderstatus <> 'P'
        UNION ALL SELECT o_orderkey, 'shipped', 3, 'u' FROM {orders} WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'paid', 4, 'd' FROM {orders} WHERE o_orderpriority = '5-LOW'""",
)
check("m1_keyed_update", O, "late_orders", oracle="""SELECT o.* REPLACE (coalesce(u.o_orderstatus, o.o_orderstatus) AS o_orderstatus, coalesce(u.o_orderdate, o.o_orderdate) AS o_orderdate)
    FROM orders o LEFT JOIN late_orders u USING (o_orderkey)""")(lambda o, u: update_where(o, u, ["o_orderkey"], ["o_orderstatus", "o_orderdate"]))
check("m2_status_transitions", "order_status_feed", oracle="""SELECT o_orderkey, status FROM order_status_feed QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1 AND op <> 'd'""")(
    lambda f: _mirror(f))
check("m3_upsert", O, "new_orders", oracle="""SELECT * FROM new_orders UNION ALL SELECT * FROM orders ANTI JOIN new_orders USING (o_orderkey)""")(
    lambda o, n: upsert(o, n, ["o_orderkey"], ["o_orderdate"]))


def _mirror(feed):
    from tidemill.sources.cdc import mirror
    return mirror(feed, ["o_orderkey"])
