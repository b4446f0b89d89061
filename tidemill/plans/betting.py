"""Sports betting: position risk and user behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import latest_by, sum_where


def position_overview(positions: DataFrame, market: DataFrame) -> DataFrame:
    """Positions at their latest market price, with profit and risk level."""
    latest = latest_by(market, ["position_id"], ["timestamp", "market_price"]).select(
        "position_id", "market_price", F.col("timestamp").alias("last_update"))
    held = positions.select("position_id", "position_name", "league", "stake_amount", "max_risk", "fair_value")
    gain = (F.col("market_price") - F.col("fair_value")) * F.col("stake_amount")
    level = (
        F.when(F.col("profit_loss") > F.col("max_risk"), "High")
        .when(F.col("profit_loss").between(F.col("max_risk") * 0.5, F.col("max_risk")), "Medium")
        .otherwise("Low")
    )
    return held.join(latest, "position_id").withColumn("profit_loss", gain).withColumn("risk_level", level).select(
        "position_id", "position_name", "league", "stake_amount", "max_risk", "fair_value", "market_price",
        "profit_loss", "risk_level", "last_update")


def risk_summary(overview: DataFrame) -> DataFrame:
    return overview.groupBy("risk_level").agg(F.count(F.lit(1)).alias("position_count"))


def market_summary(positions: DataFrame, market: DataFrame) -> DataFrame:
    """Latest price per position and bookmaker."""
    latest = latest_by(market, ["position_id", "bookmaker"], ["timestamp", "market_price"]).select(
        "position_id", "bookmaker", "market_price", F.col("timestamp").alias("last_update"))
    return positions.select("position_id", "position_name", "league").join(latest, "position_id")


def betting_patterns(history: DataFrame) -> DataFrame:
    return history.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_bets"),
        sum_where(F.col("result") == "Win", F.lit(1)).alias("wins"),
        sum_where(F.col("result") == "Loss", F.lit(1)).alias("losses"),
        F.avg("profit_loss").alias("avg_profit_loss"), F.sum("profit_loss").alias("total_profit_loss"))


def user_exposure(positions: DataFrame) -> DataFrame:
    return positions.groupBy("user_id").agg(
        F.sum("stake_amount").alias("total_exposure"), F.count(F.lit(1)).alias("active_positions"))


def high_risk_users(profiles: DataFrame, positions: DataFrame, history: DataFrame, multiple: float = 5) -> DataFrame:
    """Users exposed above ``multiple`` average bets who lose on average."""
    losing = betting_patterns(history).filter(F.col("avg_profit_loss") < 0)
    return (
        profiles.join(user_exposure(positions), "user_id").join(losing, "user_id")
        .filter(F.col("total_exposure") > F.col("avg_bet_size") * multiple)
        .select("user_id", "username", "risk_tolerance", "total_exposure", "total_bets", "avg_profit_loss",
                "total_profit_loss")
    )
