"""Dashboard measures that go beyond the reporting views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwright.functions.measures import margin_pct, money_sum, unit_sum
from tillwright.functions.text import fingerprint
from tillwright.operators.references import with_attributes

# Lifetime spend from which a customer counts as high or medium value. The published segment
# revenues follow from these cuts; they are defaults, not law.
HIGH_VALUE = 2000
MEDIUM_VALUE = 1000

# Customer columns a dashboard may show (fixed values): no name, address, phone or postal code.
SHOWABLE = ("customer_key", "country", "state", "is_active", "loyalty_points")


def _trend(fact: DataFrame, dates: DataFrame, period: list[str]) -> DataFrame:
    per_day = fact.groupBy("date_key").agg(
        F.sum("quantity").alias("quantity"), F.sum("total_amount").alias("amount"), F.sum("profit").alias("gain")
    )
    return with_attributes(per_day, dates, "date_key", period).groupBy(*period).agg(
        unit_sum(F.col("quantity")).alias("units_sold"),
        money_sum(F.col("amount")).alias("revenue"),
        money_sum(F.col("gain")).alias("profit"),
    )


def monthly_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Units, revenue and profit per calendar month."""
    return _trend(fact, dates, ["year", "month_number", "month_name"])


def month_of_year_trend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """The same per month of the year, all years together."""
    return _trend(fact, dates, ["month_number", "month_name"])


def product_margin_map(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue against margin: one row per product and one per category (``product_id`` NULL)."""
    per_product = fact.groupBy("product_key").agg(
        F.sum("quantity").alias("quantity"), F.sum("total_amount").alias("amount"), F.sum("profit").alias("gain")
    )
    sums = with_attributes(per_product, products, "product_key", ["category", "product_id"]).groupingSets(
        [["category", "product_id"], ["category"]], "category", "product_id"
    ).agg(
        unit_sum(F.col("quantity")).alias("units_sold"),
        money_sum(F.col("amount")).alias("revenue"),
        money_sum(F.col("gain")).alias("profit"),
    )
    return sums.select("*", margin_pct(F.col("profit"), F.col("revenue")).alias("profit_margin_pct"))


def customer_counts(customers: DataFrame) -> DataFrame:
    """One row: all, active and inactive customers."""
    return customers.agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.count_if("is_active").alias("active_customers"),
        F.count_if(~F.col("is_active")).alias("inactive_customers"),
    )


def value_segment(spent: Column, high: float = HIGH_VALUE, medium: float = MEDIUM_VALUE) -> Column:
    """High, Medium or Low Value by lifetime spend."""
    return F.when(spent >= high, "High Value").when(spent >= medium, "Medium Value").otherwise("Low Value")


def customer_segments(
    fact: DataFrame, customers: DataFrame, high: float = HIGH_VALUE, medium: float = MEDIUM_VALUE
) -> DataFrame:
    """Lifetime spend and segment of every customer with sales."""
    spent = fact.groupBy("customer_key").agg(money_sum(F.col("total_amount")).alias("total_spent"))
    known = with_attributes(spent, customers, "customer_key", ["customer_id"])
    return known.select("customer_id", "total_spent", value_segment(F.col("total_spent"), high, medium).alias("segment"))


def segment_revenue(segments: DataFrame) -> DataFrame:
    """Customers and revenue per segment, from :func:`customer_segments`."""
    return segments.groupBy("segment").agg(
        F.count("*").alias("customers"), money_sum(F.col("total_spent")).alias("revenue")
    )


def customer_activity(fact: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders, last order and days since then, up to the latest day with an order.

    The latest day comes from the date dimension, which spares a second scan of the fact.
    """
    latest = dates.agg(F.max("full_date")).scalar()
    per_customer = fact.groupBy("customer_key").agg(
        F.count_distinct("order_id").alias("total_orders"), F.max("order_date").alias("last_order_date")
    )
    known = with_attributes(per_customer, customers, "customer_key", ["customer_id"])
    return known.select(
        "customer_id", "total_orders", "last_order_date",
        F.date_diff(latest, F.col("last_order_date")).alias("days_since_last_order"),
    )


def showable_customers(customers: DataFrame, secret: str) -> DataFrame:
    """Customers without personal data; a fingerprint of the address, keyed by ``secret``, still links records."""
    return customers.select(*SHOWABLE, fingerprint(F.col("email"), secret).alias("email_fingerprint"))
