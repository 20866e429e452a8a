"""Curated orders, customers and products → enriched sales, margins and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwright.functions.measures import line_margin, line_profit, money_sum, unit_sum
from tillwright.operators.references import keep_referenced
from tillwright.sources import schemas


def referenced_orders(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders whose customer and product are both curated."""
    with_customer = keep_referenced(orders, customers, "customer_id")
    return keep_referenced(with_customer, products, "product_id")


def enriched_sales(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order with the customer's and the product's attributes and the profit.

    The inner joins drop orders without customer or product themselves, so clean orders can
    come here directly, without :func:`referenced_orders` before.
    """
    who = customers.select(
        "customer_id", F.concat_ws(" ", "first_name", "last_name").alias("customer_name"), "country", "state"
    )
    what = products.select("product_id", "product_name", "category", "brand", "cost")
    profit = line_profit(F.col("total_amount"), F.col("quantity"), F.col("cost"))
    joined = orders.join(what, "product_id").join(who, "customer_id")
    return joined.withColumn("profit", profit).select(*schemas.SALES)


def orders_of(sales: DataFrame) -> DataFrame:
    """The referenced orders, taken back out of the sales.

    Customer and product ids are unique, so the sales hold each referenced order exactly
    once, with all its columns: reading them here saves joining the orders a second time.
    """
    return sales.select(*schemas.ORDERS)


def margins(sales: DataFrame) -> DataFrame:
    """Profit margin of every sale."""
    return sales.select(
        "order_date", "product_name", "quantity", "cost", "unit_price", "total_amount", "profit",
        line_margin(F.col("profit"), F.col("total_amount")).alias("profit_margin_pct"),
    )


def category_summary(sales: DataFrame) -> DataFrame:
    """Units, revenue and profit per category."""
    return sales.groupBy("category").agg(
        unit_sum(F.col("quantity")).alias("units_sold"),
        money_sum(F.col("total_amount")).alias("revenue"),
        money_sum(F.col("profit")).alias("profit"),
    )


def payment_summary(sales: DataFrame) -> DataFrame:
    """Orders, revenue and profit per payment method."""
    return sales.groupBy("payment_method").agg(
        F.count("*").alias("orders"),
        money_sum(F.col("total_amount")).alias("revenue"),
        money_sum(F.col("profit")).alias("profit"),
    )
