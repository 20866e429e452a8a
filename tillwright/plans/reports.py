"""Reporting views over the star schema.

Where a report has one row per dimension key, the fact is aggregated by that key first and the
attributes are joined to the result: the join then moves one row per key, not one per sale, and a
key with very many sales is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwright.functions.measures import margin_pct, money_sum, per_order, unit_sum
from tillwright.operators.references import with_attributes


def _measures(units: str = "units_sold", revenue: str = "revenue", profit: str = "profit") -> list[Column]:
    return [
        F.count_distinct("order_id").alias("total_orders"),
        unit_sum(F.col("quantity")).alias(units),
        money_sum(F.col("total_amount")).alias(revenue),
        money_sum(F.col("profit")).alias(profit),
    ]


def _margin(profit: str = "profit", revenue: str = "revenue") -> Column:
    return margin_pct(F.col(profit), F.col(revenue)).alias("profit_margin_pct")


def executive_kpis(fact: DataFrame) -> DataFrame:
    """One row: orders, units, revenue, profit, margin of the sums, average order value."""
    totals = fact.agg(*_measures("total_units_sold", "total_revenue", "total_profit"))
    return totals.select(
        "*",
        margin_pct(F.col("total_profit"), F.col("total_revenue")).alias("overall_profit_margin_pct"),
        per_order(F.col("total_revenue"), F.col("total_orders")).alias("average_order_value"),
    )


def daily_sales(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales per day."""
    per_day = fact.groupBy("date_key").agg(*_measures())
    attributes = ["full_date", "year", "quarter", "month_number", "month_name"]
    return with_attributes(per_day, dates, "date_key", attributes).select(
        *attributes, "total_orders", "units_sold", "revenue", "profit"
    )


def category_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Sales and margin per category. An order counts once per category, so sales are joined first."""
    sold = with_attributes(fact, products, "product_key", ["category"])
    return sold.groupBy("category").agg(*_measures()).select("*", _margin())


def category_revenue(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per category; sums per product are enough for it."""
    per_product = fact.groupBy("product_key").agg(F.sum("total_amount").alias("amount"))
    categorised = with_attributes(per_product, products, "product_key", ["category"])
    return categorised.groupBy("category").agg(money_sum(F.col("amount")).alias("revenue"))


def product_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Sales and margin per product."""
    per_product = fact.groupBy("product_key").agg(*_measures())
    attributes = ["product_id", "product_name", "category", "brand"]
    return with_attributes(per_product, products, "product_key", attributes).select(
        *attributes, "total_orders", "units_sold", "revenue", "profit", _margin()
    )


def payment_performance(fact: DataFrame) -> DataFrame:
    """Sales per payment method."""
    return fact.groupBy("payment_method").agg(*_measures())


def customer_performance(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Purchases per customer."""
    per_customer = fact.groupBy("customer_key").agg(
        *_measures("units_purchased", "total_spent", "total_profit_generated")
    )
    attributes = ["customer_id", "first_name", "last_name", "country", "state"]
    return with_attributes(per_customer, customers, "customer_key", attributes).select(
        *attributes, "total_orders", "units_purchased", "total_spent", "total_profit_generated"
    )
