"""Curated tables → star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwright.functions.dates import calendar, day_number
from tillwright.operators.keys import dense_key
from tillwright.operators.references import with_surrogate
from tillwright.sources import schemas


def customer_dimension(customers: DataFrame) -> DataFrame:
    """Customers with ``customer_key`` 1..n in id order."""
    return dense_key(customers, "customer_id", "customer_key")


def product_dimension(products: DataFrame) -> DataFrame:
    """Products with ``product_key`` 1..n in id order."""
    return dense_key(products, "product_id", "product_key")


def date_dimension(sales: DataFrame) -> DataFrame:
    """The observed order dates. Days are made distinct before their attributes are derived."""
    days = sales.select("order_date").filter("order_date is not null").distinct()
    return days.select(*[part.alias(name) for name, part in calendar(F.col("order_date")).items()])


def value_dimension(sales: DataFrame, column: str, key: str) -> DataFrame:
    """The observed values of one text column with a key 1..n in their order."""
    return dense_key(sales.select(column).filter(F.col(column).isNotNull()).distinct(), column, key)


def payment_dimension(sales: DataFrame) -> DataFrame:
    """Payment methods with ``payment_key``."""
    return value_dimension(sales, "payment_method", "payment_key")


def status_dimension(sales: DataFrame) -> DataFrame:
    """Order statuses with ``order_status_key``."""
    return value_dimension(sales, "order_status", "order_status_key")


def sales_fact(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row per sale with the keys of its dimensions (arguments: the two dimensions).

    Sales without a dimension row stay, with a NULL key. The date key is computed, so it needs
    no lookup. Sales as stored lie together by customer, so that lookup comes first: its rows compress better when they move,
    and the fact lies together by product.
    """
    keyed = with_surrogate(sales, customers, "customer_id", "customer_key")
    keyed = with_surrogate(keyed, products, "product_id", "product_key")
    return keyed.withColumn("date_key", day_number(F.col("order_date"))).select(*schemas.FACT_SALES)
