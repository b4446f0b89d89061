"""Market data: rolling prices, enrichment, surveillance flags, spoofing alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import is_true, round_numeric, ratio
from tidemill.operators import asof_join, band_join, band_totals, count_where, range_frame, tumble


def price_and_spread(ticks: DataFrame, horizon: str = "3 seconds") -> DataFrame:
    """Rolling average price and bid-ask spread per asset."""
    rolled = range_frame(ticks, ["asset_id"], "timestamp", horizon, {
        "_price": ("avg", "price"), "_spread": ("avg", F.col("ask_price") - F.col("bid_price"))})
    return rolled.select("asset_id", "timestamp", round_numeric("_price", 2).alias("average_price"),
                         round_numeric("_spread", 2).alias("bid_ask_spread"))


def volatility(ticks: DataFrame, horizon: str = "3 seconds") -> DataFrame:
    """Rolling sample standard deviation of the price; NULL for a single tick."""
    rolled = range_frame(ticks, ["asset_id"], "timestamp", horizon, {"_sd": ("stddev_samp", "price")})
    return rolled.select("asset_id", "timestamp", round_numeric("_sd", 2).alias("rolling_volatility"))


def enriched_ticks(ticks: DataFrame, context: DataFrame, horizon: str = "3 seconds",
                   reach: str = "3 seconds") -> DataFrame:
    """Ticks joined to rolling price, volatility and sector context within ``reach``."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.withColumnsRenamed({"asset_id": f"{tag}_asset", "timestamp": f"{tag}_ts"})

    def near(left: DataFrame, right: DataFrame, tag: str) -> DataFrame:
        return band_join(left, side(right, tag), {"asset_id": f"{tag}_asset"}, "timestamp", f"{tag}_ts", reach, reach)

    out = near(ticks, price_and_spread(ticks, horizon), "ap")
    out = near(out, volatility(ticks, horizon), "rv")
    out = near(out, context.select("asset_id", "timestamp", "sector_performance", "sentiment_score"), "ec")
    average = F.col("average_price").cast("double")
    return out.select(
        "asset_id", "average_price", (ratio(F.col("price") - average, average) * 100).alias("price_change"),
        "bid_ask_spread", "rolling_volatility", "sector_performance", "sentiment_score", "timestamp")


# Dashboard metrics over the enriched ticks.
DASHBOARD_METRICS = {
    "avg_price": ("avg", "average_price"),
    "avg_price_change": ("avg", "price_change"),
    "sum_price_change": ("sum", "price_change"),
    "avg_bid_ask_spread": ("avg", "bid_ask_spread"),
    "avg_rolling_volatility": ("avg", "rolling_volatility"),
    "avg_sector_performance": ("avg", "sector_performance"),
    "avg_sentiment": ("avg", "sentiment_score"),
}


def dashboard_rollup(enriched: DataFrame, metrics: list[str], grain: str | None = "1 second",
                     by: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """Chart series: metrics per time grain and dimension, largest first when limited."""
    keys = list(by)
    if grain:
        enriched = enriched.withColumn("time_slot", F.window("timestamp", grain)["start"])
        keys = ["time_slot", *keys]
    out = enriched.groupBy(*keys).agg(*[
        getattr(F, kind)(F.col(column).cast("double")).alias(name)
        for name, (kind, column) in DASHBOARD_METRICS.items() if name in metrics])
    return out.orderBy(F.desc(metrics[0]), *keys).limit(limit) if limit else out


def dashboard_from_ticks(ticks: DataFrame, context: DataFrame, metrics: list[str], grain: str | None = "1 second",
                         by: tuple[str, ...] = (), limit: int | None = None, horizon: str = "3 seconds",
                         reach: str = "3 seconds") -> DataFrame:
    """``dashboard_rollup`` of ``enriched_ticks`` without building the enriched rows.

    A tick with ``n`` rolled ticks and ``m`` context rows in reach has n * n * m
    enriched rows, whose number grows with the cube of the density.  Here each
    tick stays one row: it takes the sums and counts of each side, and a metric
    of one side is weighted with how often the other sides repeat it.  ``by``
    names columns of the ticks.
    """
    def known(column: str) -> dict:
        return {f"_s_{column}": F.sum(column), f"_c_{column}": F.count(column)}

    rolled = range_frame(ticks, ["asset_id"], "timestamp", horizon, {
        "_p": ("avg", "price"), "_b": ("avg", F.col("ask_price") - F.col("bid_price")), "_v": ("stddev_samp", "price")}).select(
        F.col("asset_id").alias("_asset"), F.col("timestamp").alias("_ts"),
        *[round_numeric(c, 2).cast("double").alias(n) for c, n in (
            ("_p", "average_price"), ("_b", "bid_ask_spread"), ("_v", "rolling_volatility"))])
    rolled = rolled.withColumn("inverse_price", ratio(F.lit(1.0), "average_price"))
    sector = context.select(F.col("asset_id").alias("_c_asset"), F.col("timestamp").alias("_c_ts"),
                            F.col("sector_performance").cast("double").alias("sector_performance"),
                            F.col("sentiment_score").cast("double").alias("sentiment_score"))
    base = ticks.select("asset_id", "timestamp", F.col("price").cast("double").alias("price"),
                        *[c for c in by if c not in ("asset_id", "timestamp", "price")])
    sums = band_totals(base, rolled, {"asset_id": "_asset"}, "timestamp", "_ts", {
        "_n": F.count("_asset"), **known("average_price"), **known("inverse_price"), **known("bid_ask_spread"),
        **known("rolling_volatility")}, reach, reach)
    sums = band_totals(sums, sector, {"asset_id": "_c_asset"}, "timestamp", "_c_ts", {
        "_m": F.count("_c_asset"), **known("sector_performance"), **known("sentiment_score")}, reach, reach)
    sums = sums.filter("_n > 0 AND _m > 0")
    # (price - a) / a * 100 over the averages a of a tick is (price * sum(1 / a) - their number) * 100.
    change = (F.col("price") * F.col("_s_inverse_price") - F.col("_c_inverse_price")) * 100
    sums = sums.withColumns({"_s_price_change": change,
                             "_c_price_change": F.when(change.isNotNull(), F.col("_c_inverse_price")).otherwise(0)})
    keys = list(by)
    if grain:
        sums = sums.withColumn("time_slot", F.window("timestamp", grain)["start"])
        keys = ["time_slot", *keys]

    def metric(kind: str, column: str):
        times = F.col("_n") * (F.col("_n") if column in ("sector_performance", "sentiment_score") else F.col("_m"))
        total = F.sum(F.col(f"_s_{column}") * times)
        return F.try_divide(total, F.sum(F.col(f"_c_{column}") * times)) if kind == "avg" else total

    out = sums.groupBy(*keys).agg(*[
        metric(kind, column).alias(name) for name, (kind, column) in DASHBOARD_METRICS.items() if name in metrics])
    return out.orderBy(F.desc(metrics[0]), *keys).limit(limit) if limit else out


# -- surveillance ------------------------------------------------------------------

def unusual_volume(trades: DataFrame, horizon: str = "10 minutes", factor: float = 1.5) -> DataFrame:
    """Flag trades above ``factor`` times the asset's rolling average volume."""
    rolled = range_frame(trades, ["asset_id"], "timestamp", horizon, {"_avg": ("avg", "volume")})
    return rolled.select("trade_id", "asset_id", "volume",
                         is_true(F.col("volume") > F.col("_avg") * factor).alias("unusual_volume"), "timestamp")


def price_spike(quotes: DataFrame, horizon: str = "5 minutes", percent: float = 5) -> DataFrame:
    """Relative price range over the horizon, flagged above ``percent``."""
    rolled = range_frame(quotes, ["asset_id"], "timestamp", horizon, {"_hi": ("max", "price"), "_lo": ("min", "price")})
    change = ratio(F.col("_hi") - F.col("_lo"), F.col("_lo"))
    return rolled.select("asset_id", change.alias("percent_change"),
                         is_true(change * 100 > percent).alias("if_price_spike"), "timestamp")


def quiet_tight_spread(quotes: DataFrame, horizon: str = "10 minutes", spread: float = 0.2,
                       factor: float = 0.8) -> DataFrame:
    """Potential spoofing: a tight spread while volume is below its rolling average."""
    rolled = range_frame(quotes, ["asset_id"], "timestamp", horizon, {"_avg": ("avg", "rolling_volume")})
    tight = F.abs(F.col("bid_price") - F.col("ask_price")) < spread
    quiet = F.col("rolling_volume") < F.col("_avg") * factor
    return rolled.select("asset_id", "timestamp", is_true(tight & quiet).alias("potential_spoofing"))


# -- order-book spoofing -------------------------------------------------------------

# Order action codes of the feed.
ACTION_CODES = {"A": "add", "M": "modify", "C": "cancel", "R": "clear", "T": "trade", "F": "fill", "N": "none"}


def spoofing_alerts(orders: DataFrame, best: DataFrame, size: str = "5 seconds", lookback: str = "1 second",
                    min_size: int = 1000, closeness: float = 0.01, quote: str = "each") -> DataFrame:
    """Windows with more than one large cancel close to the best price.

    ``quote="each"`` tests a cancel against every quote of the lookback, so one
    cancel counts once per matching quote; ``quote="latest"`` tests only the
    last quote at or before it.
    """
    # Only cancels above the size survive the rule, so the join reads just those.
    cancels = orders.filter((F.col("event_type") == "cancel") & (F.col("size") > min_size))
    quotes = best.select(F.col("symbol").alias("q_symbol"), F.col("exchange").alias("q_exchange"),
                         F.col("ts_event").alias("q_ts"), "bid_px_00", "ask_px_00")
    if quote == "each":
        seen = band_join(cancels, quotes, {"symbol": "q_symbol", "exchange": "q_exchange"},
                         "ts_event", "q_ts", before=lookback)
    else:
        seen = asof_join(cancels, best.withColumnRenamed("ts_event", "q_ts"), ["symbol", "exchange"], "ts_event", "q_ts",
                         ["bid_px_00", "ask_px_00"], how="inner", tie=["bid_px_00", "ask_px_00"])
    close = lambda px: F.abs(F.col("price") - F.col(px)) < F.col(px) * closeness
    near = ((F.col("side") == "bid") & close("bid_px_00")) | ((F.col("side") == "ask") & close("ask_px_00"))
    return (
        tumble(seen.filter(near), "ts_event", size)
        .groupBy("window_start", "symbol", "exchange").agg(count_where(F.lit(True)).alias("num_cancellations"))
        .filter(F.col("num_cancellations") > 1)
    )
