"""Inventory and dynamic pricing."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import micros, round_numeric
from tidemill.operators import asof_join, key_join, latest_by, range_frame, running_sum, tumble

# Stock bands and price rules.
LOW_STOCK, MEDIUM_STOCK = 20, 50
LOW_STOCK_FACTOR, HIGH_STOCK_FACTOR = Decimal("1.20"), Decimal("0.90")
BUSY_CLICKS = 30
BUSY_FACTOR, UNDERCUT_FACTOR, FLOOR_FACTOR = Decimal("1.02"), Decimal("0.99"), Decimal("0.5")


def minute_deltas(purchases: DataFrame, restocks: DataFrame, size: str = "1 minute") -> DataFrame:
    """Units bought and restocked per product and window; a missing side is zero.

    A full join of two aggregates, done as one aggregate over the union of the
    two flows: one shuffle and no join.  Rows without a product never match in
    a join, so they stay apart by side.
    """
    def flow(df: DataFrame, ts: str, bought, restocked) -> DataFrame:
        return tumble(df, ts, size).select("product_id", "window_start", bought.cast("bigint").alias("_out"),
                                           restocked.cast("bigint").alias("_in"))

    none = F.lit(None)
    both = flow(purchases, "purchase_time", F.col("quantity_purchased"), none).withColumn("_side", F.lit(0)).unionByName(
        flow(restocks, "restock_time", none, F.col("quantity_restocked")).withColumn("_side", F.lit(1)))
    apart = F.when(F.col("product_id").isNull(), F.col("_side")).alias("_apart")
    return both.groupBy("product_id", "window_start", apart).agg(
        F.coalesce(F.sum("_out"), F.lit(0)).alias("total_purchased"),
        F.coalesce(F.sum("_in"), F.lit(0)).alias("total_restocked")).drop("_apart")


SLOT_WINDOWS = 360  # windows of one product per task slice


def stock_status(inventory: DataFrame, purchases: DataFrame, restocks: DataFrame, size: str = "1 minute",
                 slot: str | None = None) -> DataFrame:
    """Stock level over time per product, in bands.

    The running totals are cut into slots of ``slot`` (360 windows unless
    given), so a product's history is spread over many tasks.  They are taken
    before the join: an inventory row only adds its base level.
    """
    deltas = minute_deltas(purchases, restocks, size).select(
        "product_id", "window_start", (F.col("total_restocked") - F.col("total_purchased")).alias("_flow"))
    slot = slot or f"{micros(size) * SLOT_WINDOWS} microseconds"
    moved = running_sum(deltas, ["product_id"], "window_start", {"_moved": "_flow"}, slot).drop("_flow")
    level = F.col("current_inventory")
    return (
        inventory.join(moved, "product_id", "left")
        .withColumn("current_inventory", F.coalesce("_moved", F.lit(0)) + F.col("stock_level"))
        .select("product_id", "product_name", F.col("window_start").alias("inventory_window"), "current_inventory",
                "base_price", "reorder_threshold",
                F.when(level < LOW_STOCK, "Low").when(level.between(LOW_STOCK, MEDIUM_STOCK), "Medium")
                .otherwise("High").alias("stock_level_category"))
    )


def _rule_price() -> Column:
    band, base = F.col("stock_level_category"), F.col("base_price")
    return F.when(band == "Low", base * F.lit(LOW_STOCK_FACTOR)).when(band == "Medium", base).otherwise(
        base * F.lit(HIGH_STOCK_FACTOR))


def stock_rule_prices(status: DataFrame) -> DataFrame:
    """List price from the stock band alone."""
    return status.select(
        "product_id", "product_name", "inventory_window", "current_inventory", "stock_level_category", "base_price",
        round_numeric(_rule_price(), 2).alias("new_price"))


def sales_at_price(purchases: DataFrame, prices: DataFrame, slot: str = "1 day") -> DataFrame:
    """Units and takings per product at the price in force when each sale happened."""
    sold = asof_join(purchases, prices, ["product_id"], "purchase_time", "inventory_window",
                     ["product_name", "new_price"], slot=slot)
    return sold.groupBy("product_id", "product_name").agg(
        F.sum("quantity_purchased").alias("total_purchased"),
        F.sum(F.col("new_price") * F.col("quantity_purchased")).alias("total_profit"))


def excess_inventory(status: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Summed stock per window against 1.5 times the reorder level."""
    summed = tumble(status, "inventory_window", size).groupBy("product_id", "product_name", "window_start").agg(
        F.sum("current_inventory").alias("current_inventory"), F.avg("reorder_threshold").alias("reorder_level"))
    return summed.withColumn("inventory_status", F.when(
        F.col("current_inventory") > F.col("reorder_level") * 1.5, "Excess").otherwise("Normal"))


def demand_elasticity(purchases: DataFrame, prices: DataFrame, status: DataFrame, slot: str = "1 day") -> DataFrame:
    """Units and revenue per product and price.

    Each sale counts once per stock row of its product.  That factor is the
    product's row count, so it is multiplied in and the pairs are never built.
    """
    sold = asof_join(purchases, prices, ["product_id"], "purchase_time", "inventory_window", ["new_price"], how="inner", slot=slot)
    per_price = sold.groupBy("product_id", "new_price").agg(
        F.sum("quantity_purchased").alias("_units"),
        F.sum(F.col("quantity_purchased") * F.col("new_price")).alias("_revenue"))
    repeats = status.groupBy("product_id", "product_name").agg(F.count(F.lit(1)).alias("_n"))
    return key_join(per_price, repeats, ["product_id"]).select(
        "product_id", "product_name", F.col("new_price").alias("price_range"),
        (F.col("_units") * F.col("_n")).alias("total_quantity"), (F.col("_revenue") * F.col("_n")).alias("total_revenue"),
        (F.col("_units") * F.col("_n")).cast("double").alias("avg_quantity_sold"),
    ).orderBy("price_range")


# -- dashboard queries ---------------------------------------------------------------------

def latest_prices(prices: DataFrame) -> DataFrame:
    return latest_by(prices, ["product_id"], ["inventory_window"]).select(
        "product_id", "product_name", "inventory_window", "base_price", "new_price").orderBy("product_id")


def latest_stock(status: DataFrame) -> DataFrame:
    return latest_by(status, ["product_id"], ["inventory_window"]).select(
        "product_id", "product_name", "inventory_window", "current_inventory", "stock_level_category").orderBy("product_id")


def revenue_by_price(elasticity: DataFrame) -> DataFrame:
    return elasticity.groupBy("price_range", "product_name", "product_id").agg(
        F.sum("total_quantity").alias("total_quantity_sold"), F.sum("total_revenue").alias("total_revenue"))


def profit_ranking(sales: DataFrame, metric: str = "total_profit") -> DataFrame:
    return sales.select(F.col("product_id").cast("string").alias("product_id"), metric).orderBy(metric)


# -- demand- and competitor-aware prices -----------------------------------------------------

def clicks_per_window(clicks: DataFrame, size: str = "1 minute") -> DataFrame:
    return tumble(clicks, "event_time", size).groupBy("product_id", "window_start").agg(
        F.count(F.lit(1)).alias("clicks"))


def latest_competitor_prices(offers: DataFrame) -> DataFrame:
    return latest_by(offers, ["product_id", "competitor"], ["ts", "competitor_price"]).select(
        "product_id", "competitor", "competitor_price", "ts")


def lowest_competitor_price(offers: DataFrame) -> DataFrame:
    return latest_competitor_prices(offers).groupBy("product_id").agg(
        F.min("competitor_price").alias("min_competitor_price"))


def enriched_prices(status: DataFrame, clicks: DataFrame, offers: DataFrame, size: str = "1 minute",
                    horizon: str = "15 minutes", busy: int = BUSY_CLICKS) -> DataFrame:
    """Final price: stock rule, raised on busy demand, cut under a competitor, floored at half base."""
    demand = range_frame(clicks_per_window(clicks, size), ["product_id"], "window_start", horizon,
                         {"clicks_15m": F.sum("clicks")}).select(
        "product_id", F.col("window_start").alias("inventory_window"), "clicks_15m")
    rule, base, rival = _rule_price(), F.col("base_price"), F.col("min_competitor_price")
    chosen = (
        F.when(rival.isNotNull() & (base <= rival) & (F.coalesce("clicks_15m", F.lit(0)) > busy), rule * F.lit(BUSY_FACTOR))
        .when(rival.isNotNull() & (rule > rival), rule * F.lit(UNDERCUT_FACTOR))
        .otherwise(rule)
    )
    return (
        status.join(demand, ["product_id", "inventory_window"], "left")
        .join(lowest_competitor_price(offers), "product_id", "left")
        .select("product_id", "product_name", "inventory_window", "current_inventory", "stock_level_category",
                "base_price", "clicks_15m", "min_competitor_price", round_numeric(rule, 2).alias("stock_rule_price"),
                F.greatest(round_numeric(chosen, 2), round_numeric(base * F.lit(FLOOR_FACTOR), 2)).alias("final_price"))
    )


def order_revenue(orders: DataFrame, prices: DataFrame, inventory: DataFrame, slot: str = "1 day") -> DataFrame:
    """Units and estimated revenue per product at the final price in force (no price: no revenue)."""
    priced = asof_join(orders, prices, ["product_id"], "order_time", "inventory_window", ["final_price"], slot=slot)
    totals = priced.groupBy("product_id").agg(
        F.sum("quantity").alias("total_orders"), F.sum(F.col("final_price") * F.col("quantity")).alias("revenue_estimate"))
    names = inventory.groupBy("product_id").agg(F.max("product_name").alias("product_name"))
    return key_join(totals, names, ["product_id"], "left").select(
        "product_id", "product_name", "total_orders", "revenue_estimate")
