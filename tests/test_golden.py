"""Inputs and results that were published together."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill.functions.text import lexicon_scorer
from tidemill.operators.changes import upsert
from tidemill.plans import corpus, mirrors, web
from tidemill.sources import decode

VISITS = [
    '{"timestamp": "2023-06-13T10:05:00Z", "user_id": 1, "page_id": 1, "action": "click"}',
    '{"timestamp": "2023-06-13T10:06:00Z", "user_id": 2, "page_id": 2, "action": "scroll"}',
    '{"timestamp": "2023-06-13T10:07:00Z", "user_id": 3, "page_id": 1, "action": "view"}',
    '{"timestamp": "2023-06-13T10:08:00Z", "user_id": 4, "page_id": 2, "action": "view"}',
    '{"timestamp": "2023-06-13T10:09:00Z", "user_id": 5, "page_id": 3, "action": "view"}',
]
SIXTH = '{"timestamp": "2023-06-13T10:10:00Z", "user_id": 6, "page_id": 4, "action": "click"}'
USERS = [(1, "John Doe", 25, "San Francisco"), (2, "Jane Smith", 30, "New York"), (3, "Bob Johnson", 22, "Beijing")]
LATER = [(4, "Aaron Reed", 18, "San Francisco"), (5, "Denice Tucker", 21, "Beijing"), (6, "Paul Lewis", 35, "New York")]


def visits(spark, lines):
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    return decode.decode_json(raw, "timestamp timestamp, user_id int, page_id int, action string")


def users(spark, rows):
    return spark.createDataFrame(rows, "id int, name string, age int, city string")


def at(minute):
    return datetime(2023, 6, 13, 10, minute)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_page_visits(spark):
    got = rows(web.page_visits(visits(spark, VISITS)))
    assert got == [(1, 2, 2, at(7)), (2, 2, 2, at(8)), (3, 1, 1, at(9))]
    more = rows(web.page_visits(visits(spark, [*VISITS, SIXTH])))
    assert more == [*got, (4, 1, 1, at(10))]


def test_visits_with_users(spark):
    joined = web.visits_with_users(visits(spark, VISITS), users(spark, USERS))
    assert rows(joined) == [
        (at(5), 1, "John Doe", 25, 1, "click"), (at(6), 2, "Jane Smith", 30, 2, "scroll"), (at(7), 3, "Bob Johnson", 22, 1, "view")]
    assert [tuple(r) for r in web.popular_pages(visits(spark, VISITS), users(spark, USERS)).collect()] == [(1, 2), (2, 1)]


def test_city_average_follows_updates(spark):
    before = users(spark, USERS)
    assert rows(web.city_average_age(before)) == [("Beijing", 22.0), ("New York", 30.0), ("San Francisco", 25.0)]
    after = web.city_average_age(upsert(before, users(spark, LATER), ["id"]))
    assert rows(after) == [("Beijing", 21.5), ("New York", 32.5), ("San Francisco", 21.5)]
    assert rows(after.filter("avg_age < 25").select("city")) == [("Beijing",), ("San Francisco",)]


def test_card_transactions_final_state(spark):
    c = "op string, seq bigint, transaction_id bigint, merchant_name string, tran_status string, is_fraud_suspect boolean"
    feed = [
        ("c", 1, 202508260001, "Whole Foods Market", "pending", None), ("c", 2, 202508260002, "Shell Gas Station", "posted", None),
        ("c", 3, 202508260003, "Best Buy", "pending", None), ("c", 4, 202508260004, "Wallet Refund", "posted", None),
        ("u", 5, 202508260001, "Whole Foods Market", "posted", None), ("u", 6, 202508260003, "Best Buy", "reversed", True),
        ("c", 7, 202508260005, "QuickMart", "declined", None)]
    got = {r.transaction_id % 10: (r.tran_status, r.is_fraud_suspect) for r in mirrors.card_transactions(spark.createDataFrame(feed, c)).collect()}
    assert got == {1: ("posted", None), 2: ("posted", None), 3: ("reversed", True), 4: ("posted", None), 5: ("declined", None)}


def test_order_documents(spark):
    feed = [
        ("c", 1, "a", datetime(2025, 8, 26), '{"order_id": 202508260101, "customer_id": {"$numberLong": "5001001"}, "items_total": 84.23, "status": "pending", "is_expedited": false}'),
        ("u", 2, "a", datetime(2025, 8, 27), '{"order_id": {"$numberLong": "202508260101"}, "customer_id": 5001001, "items_total": 84.23, "status": "paid", "is_expedited": false}'),
        ("c", 3, "b", datetime(2025, 8, 27), '{"order_id": 202508260105, "customer_id": 5002002, "items_total": 42.00, "status": "shipped", "is_expedited": true}')]
    df = mirrors.order_documents(spark.createDataFrame(feed, "op string, seq bigint, _id string, commit_ts timestamp, payload string"))
    got = sorted((r.order_id, r.customer_id, r.items_total, r.status, r.is_expedited, r.commit_ts) for r in df.collect())
    assert got == [(202508260101, 5001001, Decimal("84.2300000000"), "paid", False, datetime(2025, 8, 27)),
                   (202508260105, 5002002, Decimal("42.0000000000"), "shipped", True, datetime(2025, 8, 27))]


@pytest.mark.parametrize("score, signal", [(0.0, "HOLD"), (0.05, "HOLD"), (-0.05, "HOLD"), (0.3182, "BUY"), (-0.6369, "SELL"), (0.0501, "BUY")])
def test_signal_thresholds(spark, score, signal):
    news = spark.createDataFrame([("some headline",), (None,)], "headline string")
    got = {r.headline: (r.sentiment_score, r.signal) for r in corpus.headline_signals(news, lambda texts: [score] * len(texts)).collect()}
    assert got == {"some headline": (score, signal), None: (0.0, "HOLD")}


def test_default_lexicon_signs(spark):
    news = spark.createDataFrame([("Ethereum surges 10% following successful network upgrade",), ("Major crypto exchange hacked, thousands of wallets drained",),
                                  ("Blockchain association releases annual transparency report",)], "headline string")
    lexicon = {"surges": 2.0, "successful": 2.0, "hacked": -2.5, "drained": -2.0}
    for scorer in (lexicon, lexicon_scorer(lexicon)):
        got = corpus.headline_signals(news, scorer).collect()
        assert [r.signal for r in got] == ["BUY", "SELL", "HOLD"]
        assert all(-1 <= r.sentiment_score <= 1 for r in got)


def test_undeclared_and_missing_fields(spark):
    raw = spark.createDataFrame([('{"a": 1, "zzz": 2}',), ("not json",)], "value string")
    assert rows(decode.decode_json(raw, "a int, b string").filter(F.col("a").isNotNull())) == [(1, None)]
    assert decode.valid_json(raw).count() == 1
