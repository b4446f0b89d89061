"""Chain transactions: unnested from JSON, per block, per window, look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import moment, span
from tidemill.functions.semi import explode_json_array
from tidemill.operators import count_where, hop, tumble, zero_filled

_ENTRY = ("struct<slot:string,blockTime:string,tx_type:string,signature:string,sender:string,receiver:string,"
          "amount:string,fee:string>")

# Transfer types counted apart, with the prefix of their columns.
TRANSFER_TYPES = {"sol": "SOL Transfer", "spl": "SPL-Token Transfer"}


def transactions(batches: DataFrame) -> DataFrame:
    """One typed row per element of the ``transactions`` JSON array."""
    rows = explode_json_array(batches, "transactions", _ENTRY, "tx")
    return rows.select(
        "tx.slot", F.to_timestamp("tx.blockTime").alias("blockTime"), "tx.tx_type", "tx.signature", "tx.sender",
        "tx.receiver", F.col("tx.amount").cast("decimal(38,10)").alias("amount"), "tx.fee")


def _transfer_stats() -> list[Column]:
    out = []
    for prefix, kind in TRANSFER_TYPES.items():
        match = F.col("tx_type") == kind
        amount = F.when(match, F.col("amount"))
        out += [
            count_where(match).alias(f"{prefix}_tx_count"),
            zero_filled(F.sum(amount)).alias(f"{prefix}_total_amount"),
            F.round(F.avg(amount), 0).alias(f"{prefix}_avg_amount"),
            zero_filled(F.max(amount)).alias(f"{prefix}_max_amount"),
            zero_filled(F.min(amount)).alias(f"{prefix}_min_amount"),
        ]
    return out


def block_stats(tx: DataFrame) -> DataFrame:
    return tx.groupBy("slot").agg(*_transfer_stats())


def window_stats(tx: DataFrame, slide: str = "1 minute", size: str = "2 minutes") -> DataFrame:
    return hop(tx, "blockTime", slide, size).groupBy("window_start", "window_end").agg(*_transfer_stats())


def last_closed_window(stats: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    return stats.filter(F.col("window_end") < moment(as_of)).orderBy(F.desc("window_end")).limit(1)


def counts_per_window(tx: DataFrame, size: str = "5 seconds") -> DataFrame:
    return tumble(tx, "blockTime", size).groupBy("window_start").agg(F.count(F.lit(1)).alias("tx_count"))


def recent_counts(counts: DataFrame, as_of: Column | str | None = None, within: str = "2 minutes") -> DataFrame:
    return counts.filter(F.col("window_start") >= moment(as_of) - span(within)).orderBy("window_start")


def lookup(tx: DataFrame, column: str, value: str) -> DataFrame:
    """Point look-up by slot or signature."""
    return tx.filter(F.col(column) == value)
