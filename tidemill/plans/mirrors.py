"""Operational tables mirrored from change feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.semi import json_number, json_text
from tidemill.operators.changes import upsert
from tidemill.sources.cdc import mirror, mirror_documents

ORDER_TEXT_FIELDS = ("currency", "payment_method", "channel", "shipping_city", "shipping_state", "shipping_country", "status")


def order_documents(changes: DataFrame) -> DataFrame:
    """Typed orders from a document feed; ids may be plain numbers or wrapped longs."""
    docs = mirror_documents(changes)
    return docs.select(
        json_number("payload", "order_id").alias("order_id"), json_number("payload", "customer_id").alias("customer_id"),
        json_number("payload", "items_total", "decimal(38,10)").alias("items_total"),
        *[json_text("payload", f"$.{f}").alias(f) for f in ORDER_TEXT_FIELDS],
        json_text("payload", "$.is_expedited").cast("boolean").alias("is_expedited"), "commit_ts")


def trips(changes: DataFrame) -> DataFrame:
    """Ride-hailing trips with the commit time of their last change; a 0/1 flag reads as boolean."""
    return mirror(changes, ["trip_id"], commit_ts=True).withColumn("is_surge", F.col("is_surge").cast("boolean"))


def card_transactions(changes: DataFrame) -> DataFrame:
    return mirror(changes, ["transaction_id"])


def bank_accounts(accounts: DataFrame, updates: DataFrame) -> DataFrame:
    """Accounts after an upsert; the newest version of an account wins."""
    return upsert(accounts, updates, ["account_id"], ["updated_at"])
