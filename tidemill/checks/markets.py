"""Checks for market data."""

from pyspark.sql import functions as F

from tidemill.checks.harness import check, declare
from tidemill.plans import markets as m

declare(
    ticks="""SELECT user_id AS asset_id, ts AS timestamp, floor(value) + 10.0E0 AS price, event_id % 90 AS volume,
               floor(value) + 9.0E0 AS bid_price, floor(value) + 10.0E0 + event_id % 4 AS ask_price FROM {events}""",
    sector_context="""SELECT user_id + CASE WHEN event_type = 'error' THEN 1000000000 ELSE 0 END AS asset_id, ts + INTERVAL '5' MINUTE AS timestamp, event_type AS sector,
               CAST(event_id % 13 AS DOUBLE) AS sector_performance, CAST(event_id % 7 AS DOUBLE) AS sentiment_score
               FROM {events}""",
    trades="""SELECT event_id AS trade_id, user_id % 20 AS asset_id, ts AS timestamp, value AS price,
                CAST(floor(value) AS BIGINT) AS volume FROM {events}""",
    quotes="""SELECT user_id % 20 AS asset_id, ts AS timestamp, floor(value) + 5.0E0 AS price, 1.0E0 * (event_id % 3) AS bid_price,
                1.0E0 * (event_id % 2) AS ask_price, CAST(floor(value) AS BIGINT) AS rolling_volume FROM {events}""",
    book="""SELECT ts AS ts_event, 'S' || user_id AS symbol, 'X' || user_id % 3 AS exchange, CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side,
              100.0E0 + event_id % 3 AS price, 990 + event_id % 40 AS size,
              CASE event_type WHEN 'click' THEN 'add' WHEN 'error' THEN 'trade' ELSE 'cancel' END AS event_type FROM {events}""",
    best="""SELECT ts + INTERVAL '30' SECOND AS ts_event, 'S' || user_id AS symbol, 'X' || user_id % 3 AS exchange,
              100.0E0 + event_id % 2 AS bid_px_00, 101.0E0 + event_id % 2 AS ask_px_00 FROM {events}""",
)

_FRAME = "(PARTITION BY asset_id ORDER BY timestamp RANGE BETWEEN INTERVAL '6 hours' PRECEDING AND CURRENT ROW)"
_PRICE = f"""SELECT asset_id, timestamp, round((avg(price) OVER {_FRAME})::DECIMAL(38,10), 2) AS average_price,
   round((avg(ask_price - bid_price) OVER {_FRAME})::DECIMAL(38,10), 2) AS bid_ask_spread FROM ticks"""
_VOL = f"SELECT asset_id, timestamp, round((stddev_samp(price) OVER {_FRAME})::DECIMAL(38,10), 2) AS rolling_volatility FROM ticks"
_NEAR = "BETWEEN {0}.timestamp - INTERVAL '3 hours' AND {0}.timestamp + INTERVAL '3 hours'"
_ENRICHED = f"""ap AS ({_PRICE}), rv AS ({_VOL}), enriched AS (
   SELECT r.asset_id, average_price::DOUBLE AS average_price, (r.price - average_price::DOUBLE) / average_price::DOUBLE * 100 AS price_change,
      bid_ask_spread::DOUBLE AS bid_ask_spread, rolling_volatility::DOUBLE AS rolling_volatility, sector_performance, sentiment_score, r.timestamp
   FROM ticks r JOIN ap ON r.asset_id = ap.asset_id AND r.timestamp {_NEAR.format('ap')}
   JOIN rv ON r.asset_id = rv.asset_id AND r.timestamp {_NEAR.format('rv')}
   JOIN sector_context e ON r.asset_id = e.asset_id AND r.timestamp {_NEAR.format('e')})"""


def _enriched(t, c):
    return m.enriched_ticks(t, c, "6 hours", "3 hours")


def _dashboard(t, c, metrics, grain, by=(), limit=None):
    return m.dashboard_from_ticks(t, c, metrics, grain, by, limit, "6 hours", "3 hours")


check("q6_price_and_spread", "ticks", oracle=f"SELECT * REPLACE (average_price::DOUBLE AS average_price, bid_ask_spread::DOUBLE AS bid_ask_spread) FROM ({_PRICE})")(
    lambda t: m.price_and_spread(t, "6 hours"))
check("q7_volatility", "ticks", oracle=f"SELECT * REPLACE (rolling_volatility::DOUBLE AS rolling_volatility) FROM ({_VOL})")(
    lambda t: m.volatility(t, "6 hours"))
check("q8_enriched_ticks", "ticks", "sector_context", oracle=f"WITH {_ENRICHED} SELECT * FROM enriched")(_enriched)
check("q9_rollup_by_time", "ticks", "sector_context", oracle=f"""WITH {_ENRICHED}
    SELECT time_bucket(INTERVAL '1 day', timestamp) AS time_slot, round(avg(price_change), 9) AS avg_price_change,
      round(avg(rolling_volatility), 9) AS avg_rolling_volatility FROM enriched GROUP BY 1""")(
    lambda t, c: _dashboard(t, c, ["avg_price_change", "avg_rolling_volatility"], "1 day").select(
        "time_slot", *[F.round(x, 9).alias(x) for x in ("avg_price_change", "avg_rolling_volatility")]))
check("q9_rollup_by_asset", "ticks", "sector_context", oracle=f"""WITH {_ENRICHED}
    SELECT asset_id, round(sum(price_change), 4) AS sum_price_change FROM enriched GROUP BY 1 ORDER BY 2 DESC LIMIT 50""")(
    lambda t, c: _dashboard(t, c, ["sum_price_change"], None, ("asset_id",), 50).select(
        "asset_id", F.round("sum_price_change", 4).alias("sum_price_change")))
check("q9_spread_by_asset_and_time", "ticks", "sector_context", oracle=f"""WITH {_ENRICHED}
    SELECT asset_id, time_bucket(INTERVAL '1 day', timestamp) AS time_slot, round(avg(bid_ask_spread), 9) AS avg_bid_ask_spread,
      avg(sector_performance) AS avg_sector_performance, avg(sentiment_score) AS avg_sentiment FROM enriched GROUP BY ALL""")(
    lambda t, c: _dashboard(t, c, ["avg_bid_ask_spread", "avg_sector_performance", "avg_sentiment"],
                            "1 day", ("asset_id",)).withColumn("avg_bid_ask_spread", F.round("avg_bid_ask_spread", 9)))

check("q10_unusual_volume", "trades", oracle=f"""
    SELECT trade_id, asset_id, volume, volume > 1.5::DOUBLE * avg(volume) OVER {_FRAME} AS unusual_volume, timestamp FROM trades""")(
    lambda t: m.unusual_volume(t, "6 hours"))
check("q11_price_spike", "quotes", oracle=f"""
    WITH r AS (SELECT asset_id, timestamp, max(price) OVER {_FRAME} AS hi, min(price) OVER {_FRAME} AS lo FROM quotes)
    SELECT asset_id, (hi - lo) / lo AS percent_change, (hi - lo) / lo * 100 > 5 AS if_price_spike, timestamp FROM r""")(
    lambda q: m.price_spike(q, "6 hours"))
check("q12_quiet_tight_spread", "quotes", oracle=f"""
    SELECT asset_id, timestamp, abs(bid_price - ask_price) < 0.2 AND rolling_volume < 0.8::DOUBLE * avg(rolling_volume) OVER {_FRAME}
      AS potential_spoofing FROM quotes""")(lambda q: m.quiet_tight_spread(q, "6 hours"))

_CLOSE = "((side = 'bid' AND abs(price - bid_px_00) < 0.01 * bid_px_00) OR (side = 'ask' AND abs(price - ask_px_00) < 0.01 * ask_px_00))"
check("q76_spoofing_alerts", "book", "best", oracle=f"""
    SELECT time_bucket(INTERVAL '1 day', o.ts_event) AS window_start, o.symbol, o.exchange, count(*) AS num_cancellations
    FROM book o JOIN best b ON b.symbol = o.symbol AND b.exchange = o.exchange
      AND b.ts_event BETWEEN o.ts_event - INTERVAL '2 days' AND o.ts_event
    WHERE event_type = 'cancel' AND size > 1000 AND {_CLOSE} GROUP BY ALL HAVING num_cancellations > 1""")(
    lambda o, b: m.spoofing_alerts(o, b, "1 day", "2 days"))
check("q76_spoofing_alerts_latest_quote", "book", "best", oracle=f"""
    SELECT time_bucket(INTERVAL '5 days', o.ts_event, TIMESTAMP '1970-01-01') AS window_start, o.symbol, o.exchange, count(*) AS num_cancellations
    FROM book o ASOF JOIN best b ON b.symbol = o.symbol AND b.exchange = o.exchange AND o.ts_event >= b.ts_event
    WHERE event_type = 'cancel' AND size > 1000 AND {_CLOSE} GROUP BY ALL HAVING num_cancellations > 1""")(
    lambda o, b: m.spoofing_alerts(o, b, "5 days", quote="latest"))
