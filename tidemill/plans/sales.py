"""Sales: product and user rankings, stream balance, risk rollups, topic rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalar import ratio
from tidemill.operators import net_of_sums, ordering, top_k, tumble


def sales_per_window(sales: DataFrame, products: DataFrame, size: str = "1 minute") -> DataFrame:
    """Total and average price per sale, known product and window."""
    known = products.select("product_id")
    return tumble(sales, "sale_timestamp", size).join(known, "product_id").groupBy(
        "sale_id", "product_id", "window_start", "window_end").agg(
        F.sum("total_price").alias("total_sales"), F.avg("total_price").alias("average_revenue_per_sale")).select(
        "sale_id", "product_id", "total_sales", "average_revenue_per_sale", "window_start", "window_end")


def active_users(users: DataFrame, size: str = "1 minute") -> DataFrame:
    """Distinct users by last login per window."""
    return tumble(users, "last_login", size).groupBy("window_start", "window_end").agg(
        F.count_distinct("user_id").alias("total_active_users"))


def product_windows(sales: DataFrame, products: DataFrame, size: str = "1 minute") -> DataFrame:
    """Units per product and window, with the product's names."""
    sold = tumble(sales, "sale_timestamp", size).groupBy("product_id", "window_start", "window_end").agg(
        F.sum("quantity").alias("units"))
    return sold.join(products.select("product_id", "category", "product_name"), "product_id")


def named_windows(sold: DataFrame) -> DataFrame:
    """Units per product name and window; products that share their names count as one."""
    return sold.groupBy("category", "product_name", "window_start", "window_end").agg(F.sum("units").alias("total_quantity_sold"))


#: Ranking of product windows: (column, ascending).
PRODUCT_ORDER = (("total_quantity_sold", False), ("category", True), ("product_name", True), ("window_start", True))


def top_products(sales: DataFrame, products: DataFrame, size: str = "1 minute", n: int = 5) -> DataFrame:
    """The ``n`` best windows of a product by units; names, then window, settle ties."""
    return top_k(named_windows(product_windows(sales, products, size)), ordering(PRODUCT_ORDER), n)


def spending(users: DataFrame, sales: DataFrame, size: str = "1 minute") -> DataFrame:
    """What each user spent, with the window of the last login."""
    spent = sales.groupBy("user_id").agg(F.sum("total_price").alias("_spent"))
    seen = tumble(users, "last_login", size).select("user_id", "username", "email", "window_start", "window_end")
    return seen.join(spent, "user_id").groupBy("user_id", "username", "email", "window_start", "window_end").agg(
        F.sum("_spent").alias("total_spent"))


#: Ranking of users: (column, ascending).
SPENDER_ORDER = (("total_spent", False), ("user_id", True))


def top_spenders(users: DataFrame, sales: DataFrame, size: str = "1 minute", n: int = 10) -> DataFrame:
    """The ``n`` users who spent most, with the window of their last login."""
    return top_k(spending(users, sales, size), ordering(SPENDER_ORDER), n)


# -- two purchase streams ----------------------------------------------------------------------

def net_purchases(constant: DataFrame, varying: DataFrame) -> DataFrame:
    """Incoming minus outgoing per customer over the many-to-many join of the two streams."""
    return net_of_sums(constant, varying, "customer_id", {
        "quant_tot": ("quant_in", "quant_out"), "amnt_tot": ("tot_amnt_in", "tot_amnt_out")})


def outgoing_per_window(varying: DataFrame, size: str = "1 minute", pattern: str | None = None) -> DataFrame:
    """Outgoing totals per window of a time that arrives as text."""
    parsed = F.to_timestamp("ts", pattern) if pattern else F.to_timestamp("ts")
    return tumble(varying.withColumn("ts", parsed), "ts", size).groupBy("window_end").agg(
        F.sum("quant_out").alias("quant_out"), F.sum("tot_amnt_out").alias("tot_amnt_out"))


# -- risk table ----------------------------------------------------------------------------------

def highest_risk(users: DataFrame) -> DataFrame:
    """Rows that carry the greatest risk of the table (scalar subquery)."""
    worst = users.agg(F.max("risk"))
    return users.filter(F.col("risk") == worst.scalar()).select("id", "risk", "time")


def cost_by_risk(users: DataFrame) -> DataFrame:
    return users.groupBy("risk").agg(
        F.count(F.lit(1)).alias("user_count"), F.sum("cost").alias("total_cost"), F.avg("cost").alias("avg_cost"),
    ).orderBy(F.desc("total_cost"), "risk")


# -- product sales topic ----------------------------------------------------------------------------

def topic_rollups(sales: DataFrame) -> dict[str, DataFrame]:
    """Five standard rollups of a product-sales topic."""
    def by(*keys: str) -> DataFrame:
        return sales.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("transactions"), F.sum("quantity").alias("units"),
            F.sum("total_amount").alias("revenue"), F.sum("profit_amount").alias("profit"))

    return {
        "by_category": by("product_category").withColumn("margin", ratio("profit", "revenue")),
        "by_channel": by("sales_channel"),
        "by_region_and_day": by("region", "date"),
        "by_segment": by("customer_segment").withColumn("average_order", ratio("revenue", "transactions")),
        "by_payment": by("payment_method"),
    }
