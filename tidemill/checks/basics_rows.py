"""Checks for row-level operators: projection, predicates, scalar functions, JSON."""

from decimal import Decimal

from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.functions import semi
from tidemill.functions import scalar as s
from tidemill.operators import count_where

E, L, C, O = "events", "lineitem", "customer", "orders"  # noqa: E741

# -- projection, filter, predicate ---------------------------------------------------------

check("p1_project_rename", C, oracle="SELECT c_custkey AS id, c_name AS name FROM customer")(
    lambda c: c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
check("p2_pass_through", E, oracle="SELECT * FROM events")(lambda e: e.select("*"))
check("p3_arithmetic", L, oracle="SELECT l_orderkey, l_linenumber, (l_extendedprice - l_quantity) / l_quantity * 100 AS pct FROM lineitem")(
    lambda x: x.select("l_orderkey", "l_linenumber", (s.ratio(F.col("l_extendedprice") - F.col("l_quantity"), "l_quantity") * 100).alias("pct")))
check("p4_compare_and_null", E, oracle="SELECT event_id FROM events WHERE value > 100 AND props IS NOT NULL AND NOT (event_type = 'view')")(
    lambda e: e.filter((F.col("value") > 100) & F.col("props").isNotNull() & ~(F.col("event_type") == "view")).select("event_id"))
check("p5_in_list", E, oracle="SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")(
    lambda e: e.filter(F.col("event_type").isin("click", "view")).select("event_id", "event_type"))
check("p6_between", L, oracle="SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 10 AND l_quantity <= 20")(
    lambda x: x.filter(F.col("l_quantity").between(10, 20)).select("l_orderkey", "l_quantity"))
check("p7_nested_rules", L, oracle="""SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_returnflag = 'A' AND (l_quantity < 5 OR l_discount > 0.08) OR l_returnflag = 'R' AND l_tax = 0""")(
    lambda x: x.filter(((F.col("l_returnflag") == "A") & ((F.col("l_quantity") < 5) | (F.col("l_discount") > 0.08)))
                       | ((F.col("l_returnflag") == "R") & (F.col("l_tax") == 0))).select("l_orderkey", "l_linenumber"))
check("p8_searched_case", E, oracle="SELECT event_id, CASE WHEN value < 20 THEN 'low' WHEN value < 100 THEN 'mid' END AS band FROM events")(
    lambda e: e.select("event_id", s.first_match([(F.col("value") < 20, "low"), (F.col("value") < 100, "mid")]).alias("band")))
check("p9_code_label", O, oracle="SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'Unknown' END AS status FROM orders")(
    lambda o: o.select("o_orderkey", s.code_label("o_orderstatus", {"F": "filled", "O": "open"}, "Unknown").alias("status")))
check("p10_flags", E, oracle="""SELECT event_id, if(event_type = 'view', NULL, value) > 50 AS bare, coalesce(if(event_type = 'view', NULL, value) > 50, false) AS two_valued FROM events""")(
    lambda e: e.withColumn("v", F.when(F.col("event_type") != "view", F.col("value"))).select(
        "event_id", (F.col("v") > 50).alias("bare"), s.is_true(F.col("v") > 50).alias("two_valued")))
check("p11_moving_filter", E, oracle="SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-25' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-25'")(
    lambda e: e.filter((F.col("ts") > s.moment("2024-01-25 00:00:00") - s.span("7 days")) & (F.col("ts") <= s.moment("2024-01-25 00:00:00"))).select("event_id"))
check("p12_having", E, oracle="SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 60")(
    lambda e: e.groupBy("user_id").agg(F.count("*").alias("n")).filter("n > 60"))
check("p13_scalar_subquery", E, oracle="SELECT event_id FROM events WHERE date_trunc('day', ts) < (SELECT date_trunc('day', max(ts)) FROM events)")(
    lambda e: e.filter(F.date_trunc("day", "ts") < e.agg(F.date_trunc("day", F.max("ts"))).scalar()).select("event_id"))
check("p14_derived_tables", O, oracle="""WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT n, count(*) AS customers FROM a GROUP BY 1)
    SELECT * FROM b WHERE customers > 5""")(
    lambda o: o.groupBy("o_custkey").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("customers")).filter("customers > 5"))
check("p15_literals", E, oracle="SELECT event_id, 'level1' AS alert_level, 1 AS id FROM events")(
    lambda e: e.select("event_id", F.lit("level1").alias("alert_level"), F.lit(1).alias("id")))
check("p16_casts", E, oracle="""SELECT event_id, round(value::DECIMAL(38,10), 1)::DOUBLE AS n, strftime(ts, '%Y-%m-%d')::TIMESTAMP AS d,
    TRY_CAST(event_type AS INTEGER) AS bad FROM events""")(
    lambda e: e.select("event_id", s.round_numeric("value", 1).alias("n"), F.date_format("ts", "yyyy-MM-dd").cast("timestamp").alias("d"),
                       F.col("event_type").try_cast("int").alias("bad")))

# -- scalar functions -------------------------------------------------------------------------

check("f1_round_numeric", E, oracle="SELECT event_id, round((value / 7)::DECIMAL(38,10), 2)::DOUBLE AS r2, round((value / 7)::DECIMAL(38,10), 0)::DOUBLE AS r0 FROM events")(
    lambda e: e.select("event_id", s.round_numeric(F.col("value") / 7, 2).alias("r2"), s.round_numeric(F.col("value") / 7).alias("r0")))
check("f2_abs", L, oracle="SELECT l_orderkey, l_linenumber, abs(l_quantity - 25) AS d FROM lineitem")(
    lambda x: x.select("l_orderkey", "l_linenumber", F.abs(F.col("l_quantity") - 25).alias("d")))
check("f3_grid_id", E, oracle="SELECT event_id, floor(value / 0.002::DOUBLE)::BIGINT || '_' || floor(-value / 0.002::DOUBLE)::BIGINT AS grid_id FROM events")(
    lambda e: e.select("event_id", s.grid_id("value", -F.col("value")).alias("grid_id")))
check("f4_haversine", E, oracle="""SELECT event_id, round(12742 * asin(sqrt(pow(sin(radians(1.5::DOUBLE - a) / 2), 2) + cos(radians(a)) * cos(radians(1.5::DOUBLE)) * pow(sin(radians(103.5::DOUBLE - b) / 2), 2))), 6) AS km
    FROM (SELECT event_id, event_id % 80 AS a, event_id % 170 AS b FROM events)""")(
    lambda e: e.select("event_id", F.round(s.haversine_km(F.col("event_id") % 80, F.col("event_id") % 170, F.lit(1.5), F.lit(103.5)), 6).alias("km")))
check("f5_clamp", E, oracle="SELECT event_id, greatest(5, least(value, 60)) AS v, greatest(if(event_type = 'view', NULL, 1), 0) AS g FROM events")(
    lambda e: e.select("event_id", s.clamp("value", 5.0, 60.0).alias("v"),
                       F.greatest(F.when(F.col("event_type") != "view", 1), F.lit(0)).alias("g")))
check("f6_coalesce_nullif", E, oracle="SELECT event_id, coalesce(nullif(event_type, 'view'), 'seen') AS t, 100::DOUBLE / nullif(user_id % 3, 0) AS d FROM events")(
    lambda e: e.select("event_id", F.coalesce(F.nullif("event_type", F.lit("view")), F.lit("seen")).alias("t"),
                       s.ratio(F.lit(100), F.col("user_id") % 3).alias("d")))
check("f7_concat", E, oracle="SELECT event_id, concat('user ', user_id, ' ', nullif(event_type, 'view')) AS t FROM events")(
    lambda e: e.select("event_id", s.concat_text(F.lit("user "), "user_id", F.lit(" "), F.nullif("event_type", F.lit("view"))).alias("t")))
check("f8_stable_id", E, oracle="SELECT event_id, md5(concat(user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'))) AS id FROM events")(
    lambda e: e.select("event_id", s.stable_id("user_id", s.time_text("ts")).alias("id")))
check("f9_date_trunc", E, oracle="SELECT event_id, " + ", ".join(f"date_trunc('{u}', ts) AS t_{u}" for u in ("second", "minute", "day", "month", "year")) + " FROM events")(
    lambda e: e.select("event_id", *[F.date_trunc(u, "ts").alias(f"t_{u}") for u in ("second", "minute", "day", "month", "year")]))
check("f10_extract", E, oracle="SELECT event_id, day(ts) AS d, hour(ts) AS h, second(ts) AS s, epoch_us(ts) AS us FROM events")(
    lambda e: e.select("event_id", F.dayofmonth("ts").alias("d"), F.hour("ts").alias("h"), F.second("ts").alias("s"), s.event_micros("ts").alias("us")))
check("f11_interval_arithmetic", E, oracle="SELECT event_id, ts + to_seconds(90 * (user_id % 5)) AS later, ts - INTERVAL 3 HOUR AS earlier FROM events")(
    lambda e: e.select("event_id", (F.col("ts") + F.expr("(user_id % 5) * 1.5 * INTERVAL '1' MINUTE")).alias("later"), (F.col("ts") - s.span("3 hours")).alias("earlier")))
check("f12_time_difference", E, oracle="SELECT event_id, TIMESTAMP '2024-01-31' - ts <= INTERVAL 10 DAY AS recent, round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts)) / 1000000)::BIGINT AS secs FROM events")(
    lambda e: e.select("event_id", (s.moment("2024-01-31 00:00:00") - F.col("ts") <= s.span("10 days")).alias("recent"),
                       s.seconds_between("ts", s.moment("2024-01-31 00:00:00")).alias("secs")))
check("f13_json_get", E, oracle="SELECT event_id, (props->>'k')::BIGINT AS k, props->>'missing' AS missing FROM events")(
    lambda e: e.select("event_id", semi.json_text("props", "$.k").cast("bigint").alias("k"), semi.json_text("props", "$.missing").alias("missing")))

declare(json_rows="""SELECT event_id, '[{{"n": ' || event_id || ', "tag": "' || event_type || '"}}, {{"n": ' || user_id || '}}]' AS items,
    '{{"a": ' || CASE WHEN event_id % 2 = 0 THEN '{{"$numberLong": "' || user_id || '"}}' ELSE '' || user_id END || '}}' AS doc,
    '{{"flight": {{"number": "' || event_id % 90 || '", "codeshared": ' || CASE WHEN event_id % 3 = 0 THEN '{{"airline": "x' || user_id || '"}}' ELSE 'null' END || '}}, "airline": {{"name": "air' || user_id % 9 || '"}}}}' AS flight FROM {events}""")
check("f14_json_rows", "json_rows", oracle="SELECT event_id, (i->>'n')::BIGINT AS n, i->>'tag' AS tag FROM (SELECT event_id, unnest(from_json(items, '[\"JSON\"]')) AS i FROM json_rows)")(
    lambda j: semi.explode_json_array(j, "items", "struct<n:bigint,tag:string>").select("event_id", "item.n", "item.tag"))
check("f15_json_number", "json_rows", oracle='''SELECT event_id, coalesce(doc->'a'->>'$."$numberLong"', doc->>'a')::BIGINT AS a FROM json_rows''')(
    lambda j: j.select("event_id", semi.json_number("doc", "a").alias("a")))
check("f16_parse_time", E, oracle="SELECT event_id, date_trunc('second', ts) AS iso, date_trunc('minute', ts) AS patterned FROM events")(
    lambda e: e.withColumns({"a": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "b": F.date_format("ts", "dd/MM/yyyy HH:mm")}).select(
        "event_id", F.to_timestamp("a").alias("iso"), F.to_timestamp("b", "dd/MM/yyyy HH:mm").alias("patterned")))
check("f17_time_zone", E, oracle="SELECT date_trunc('day', ts + INTERVAL 8 HOUR) AS local_day, count(*) AS n FROM events GROUP BY 1")(
    lambda e: e.groupBy(F.date_trunc("day", F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Asia/Shanghai")).alias("local_day")).agg(F.count("*").alias("n")))
check("f18_contains_any", "supplier", oracle="SELECT s_suppkey FROM supplier WHERE lower(s_name) LIKE '%er#00000001%' OR s_nationkey::VARCHAR LIKE '%er#00000001%'")(
    lambda x: x.filter(s.contains_any(["s_name", "s_nationkey"], "ER#00000001")).select("s_suppkey"))
check("f19_code_table", L, oracle="SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'add' WHEN 'R' THEN 'clear' WHEN 'N' THEN 'none' END AS action FROM lineitem")(
    lambda x: x.select("l_orderkey", "l_linenumber", s.code_label("l_returnflag", {"A": "add", "R": "clear", "N": "none"}).alias("action")))
check("f20_flatten_nested", "json_rows", oracle="""SELECT event_id, flight->'flight'->>'number' AS flight_number, flight->'flight'->'codeshared'->>'airline' AS codeshared_airline,
    concat('Flight ', flight->'flight'->>'number', ' of ', flight->'airline'->>'name') AS flight_info FROM json_rows""")(
    lambda j: semi.flatten(semi.flatten(j.select("event_id", F.from_json(
        "flight", "flight struct<number:string,codeshared:struct<airline:string>>, airline struct<name:string>").alias("r")), "r").withColumnRenamed("airline", "carrier"), "flight").select(
        "event_id", F.col("number").alias("flight_number"), F.col("codeshared.airline").alias("codeshared_airline"),
        s.concat_text(F.lit("Flight "), "number", F.lit(" of "), "carrier.name").alias("flight_info")))
check("f21_step_score", E, oracle="""SELECT event_id, CASE WHEN value >= 200 THEN 5 WHEN value >= 100 THEN 4 WHEN value >= 50 THEN 3 WHEN value >= 20 THEN 2 ELSE 1 END AS score,
    CASE WHEN TIMESTAMP '2024-01-31' - ts <= INTERVAL 3 DAY THEN 5 WHEN TIMESTAMP '2024-01-31' - ts <= INTERVAL 10 DAY THEN 4 ELSE 1 END AS recency FROM events""")(
    lambda e: e.select("event_id", s.step_score("value", [(200, 5), (100, 4), (50, 3), (20, 2)]).alias("score"),
                       s.step_score(s.moment("2024-01-31 00:00:00") - F.col("ts"), [(s.span("3 days"), 5), (s.span("10 days"), 4)], descending=True).alias("recency")))
check("f22_integer_division", E, oracle="SELECT event_id, event_id // 7 AS q, 100 // nullif(user_id % 4, 0) AS guarded FROM events")(
    lambda e: e.select("event_id", s.int_div("event_id", F.lit(7)).alias("q"), s.int_div(F.lit(100), F.col("user_id") % 4).alias("guarded")))

# -- functions -----------------------------------------------------------------------------------

check("x1_days_in_month", O, oracle="SELECT o_orderkey, day(last_day(o_orderdate)) AS days FROM orders")(
    lambda o: o.select("o_orderkey", s.days_in_month("o_orderdate").alias("days")))
check("x5_scored_once", "news", oracle="""
    SELECT doc_id, round(coalesce(len(regexp_extract_all(headline, '[aeiou]')), 0) / 1000, 9) AS s, CASE WHEN coalesce(len(regexp_extract_all(headline, '[aeiou]')), 0) > 50 THEN 'BUY' ELSE 'HOLD' END AS signal FROM news""")(
    lambda n: _vowels(n))
check("x6_table_function", E, oracle="SELECT event_id, unnest(range(event_id % 3)) AS i FROM events")(
    lambda e: e.filter("event_id % 3 > 0").select("event_id", F.explode(F.sequence(F.lit(0), F.col("event_id") % 3 - 1)).alias("i")))


def _vowels(news):
    import re

    from tidemill.plans.corpus import headline_signals
    vowel = re.compile("[aeiou]")
    return headline_signals(news, lambda texts: [len(vowel.findall(t)) / 1000 for t in texts]).select("doc_id", F.round("sentiment_score", 9).alias("s"), "signal")


check("s26_row_count", L, oracle="SELECT count(*) AS rows, count(*) FILTER (l_tax = 0) AS untaxed FROM lineitem")(
    lambda x: x.agg(F.count("*").alias("rows"), count_where(F.col("l_tax") == 0).alias("untaxed")))
check("p16_decimal_literals", L, oracle="SELECT l_orderkey, l_linenumber, (l_extendedprice::DECIMAL(18,2) * 1.20)::DOUBLE AS p FROM lineitem")(
    lambda x: x.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(Decimal("1.20"))).alias("p")))
