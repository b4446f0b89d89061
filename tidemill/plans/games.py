"""Game statistics: team figures, mental states, leaders and spikes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import round_numeric
from tidemill.operators import hop, previous, top_n, tumble


def _part(top: Column, bottom: Column, digits: int = 2) -> Column:
    """Ratio on decimals, rounded; NULL where the divisor is zero."""
    wide = "decimal(28,6)"
    return round_numeric(F.try_divide(top.cast(wide), bottom.cast(wide)), digits)


def team_figures(stats: DataFrame, size: str = "10 minutes") -> DataFrame:
    """Kills, headshot rate, damage per minute, sustain and accuracy per window."""
    total = tumble(stats, "ts", size).groupBy("window_start", "window_end").agg(
        *[F.sum(c).alias(f"_{c}") for c in ("eliminations", "headshot_kills", "damage_dealt", "damage_taken",
                                           "healing_done", "time_survived")], F.avg("accuracy").alias("_accuracy"))
    return total.select(
        "window_start", "window_end", F.col("_eliminations").alias("total_kills"),
        _part(F.col("_headshot_kills") * 100, F.col("_eliminations")).alias("headshot_rate_pct"),
        _part(F.col("_damage_dealt") * 60, F.col("_time_survived")).alias("team_dpm"),
        _part(F.col("_healing_done"), F.col("_damage_taken")).alias("sustain_ratio"),
        round_numeric("_accuracy", 2).alias("avg_accuracy_pct")).orderBy("window_start")


def mental_states(stats: DataFrame, size: str = "15 minutes") -> DataFrame:
    """Samples, kills, accuracy, headshots per kill, survival and placement per state and window."""
    total = tumble(stats, "ts", size).groupBy("window_start", "window_end", "mental_state").agg(
        F.count(F.lit(1)).alias("samples"), F.sum("eliminations").alias("kills"), F.avg("accuracy").alias("_accuracy"),
        F.sum("headshot_kills").alias("_heads"), F.sum("time_survived").alias("_survived"),
        F.sum("player_rank").alias("_rank"), F.count("player_rank").alias("_ranked"))
    return total.select(
        "window_start", "window_end", "mental_state", "samples", "kills",
        round_numeric("_accuracy", 2).alias("avg_accuracy_pct"), _part(F.col("_heads"), F.col("kills")).alias("hs_per_kill"),
        _part(F.col("_survived"), F.col("samples") * 60).alias("avg_survival_min"),
        _part(F.col("_rank"), F.col("_ranked")).alias("avg_placement")).orderBy("window_start", "mental_state")


def impact_leaders(stats: DataFrame, slide: str = "5 minutes", size: str = "20 minutes", n: int = 3) -> DataFrame:
    """Players with the greatest impact score per hopping window; the name settles ties."""
    total = hop(stats, "ts", slide, size).groupBy("window_start", "window_end", "player_name").agg(
        F.sum("eliminations").alias("elims"), F.sum("assists").alias("ast"), F.sum("headshot_kills").alias("hs"),
        F.sum("damage_dealt").alias("dmg"))
    impact = F.col("elims") * 2 + F.col("ast") + F.col("hs") * 0.5 + F.col("dmg") / 1000.0
    return top_n(total.withColumn("impact_score", impact), ["window_start", "window_end"],
                 [F.desc("impact_score"), F.asc("player_name")], n, "rn").orderBy("window_start", "rn")


def spikes(stats: DataFrame, slide: str = "5 minutes", size: str = "15 minutes", jump: float = 1.5) -> DataFrame:
    """Players whose kills or damage rose by half or more against their previous window."""
    total = hop(stats, "ts", slide, size).groupBy("window_start", "window_end", "player_name").agg(
        F.sum("eliminations").alias("elims"), F.sum("damage_dealt").alias("dmg"))
    moved = previous(total, ["player_name"], "window_end", {"prev_elims": "elims", "prev_dmg": "dmg"})
    more = lambda now, before: F.col(now) >= F.col(before) * jump
    return moved.filter(F.col("prev_elims").isNotNull() & (more("elims", "prev_elims") | more("dmg", "prev_dmg"))).select(
        "window_start", "window_end", "player_name", "elims", "prev_elims", "dmg", "prev_dmg",
        _part(F.col("elims") - F.col("prev_elims"), F.col("prev_elims")).alias("kill_jump_ratio"),
        _part(F.col("dmg") - F.col("prev_dmg"), F.col("prev_dmg")).alias("dmg_jump_ratio"),
    ).orderBy("window_end", "player_name")


def match_leaders(stats: DataFrame, size: str = "10 minutes", n: int = 5) -> DataFrame:
    """Best players per match and window by kills, then damage, assists and name."""
    total = tumble(stats, "ts", size).groupBy("window_start", "match_id", "player_name").agg(
        F.sum("eliminations").alias("elims"), F.sum("damage_dealt").alias("dmg"), F.sum("assists").alias("ast"))
    return top_n(total, ["window_start", "match_id"],
                 [F.desc("elims"), F.desc("dmg"), F.desc("ast"), F.asc("player_name")], n, "rk").orderBy(
        "window_start", "match_id", "rk")
