"""The data-quality and reconciliation checks of the stored layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwright.functions.measures import money_sum
from tillwright.operators.checks import BadRows, Check, KnownKey, SameTotal, UniqueKey, side_by_side


def _missing(table: str, *columns: str) -> list[Check]:
    return [BadRows(f"{column} is null", table, F.col(column).isNull()) for column in columns]


def curated_checks() -> list[Check]:
    """Keys of the curated tables: unique, present, known to the parent tables."""
    return [
        UniqueKey("customer_id repeats", "customers", "customer_id"),
        UniqueKey("product_id repeats", "products", "product_id"),
        UniqueKey("order_id repeats", "orders", "order_id"),
        *_missing("customers", "customer_id"),
        *_missing("products", "product_id"),
        *_missing("orders", "order_id", "customer_id", "product_id"),
        KnownKey("product_id unknown", "sales_curated", "product_id", "products"),
        KnownKey("customer_id unknown", "sales_curated", "customer_id", "customers"),
    ]


def gold_checks() -> list[Check]:
    """Keys of the star schema, and agreement with the curated sales."""
    return [
        UniqueKey("customer_key repeats", "dim_customer", "customer_key"),
        UniqueKey("product_key repeats", "dim_product", "product_key"),
        UniqueKey("date_key repeats", "dim_date", "date_key"),
        *_missing("fact_sales", "customer_key", "product_key", "date_key"),
        KnownKey("product_key unknown", "fact_sales", "product_key", "dim_product"),
        KnownKey("customer_key unknown", "fact_sales", "customer_key", "dim_customer"),
        KnownKey("date_key unknown", "fact_sales", "date_key", "dim_date"),
        SameTotal("revenue differs", "fact_sales", "sales_curated", money_sum(F.col("total_amount"))),
        SameTotal("row count differs", "fact_sales", "sales_curated", F.count("*")),
    ]


def unmatched_keys(fact: DataFrame) -> DataFrame:
    """One row: fact rows in all and without each of their dimension keys."""
    return fact.agg(
        F.count("*").alias("total_fact_rows"),
        F.count_if(F.col("customer_key").isNull()).alias("unmatched_customers"),
        F.count_if(F.col("product_key").isNull()).alias("unmatched_products"),
        F.count_if(F.col("date_key").isNull()).alias("unmatched_dates"),
    )


def revenue_reconciliation(sales: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: revenue of both layers, their difference and whether they agree."""
    both = side_by_side(sales, fact, money_sum(F.col("total_amount")), "curated_revenue", "gold_revenue")
    return both.select(
        "*",
        (F.col("curated_revenue") - F.col("gold_revenue")).cast("decimal(38,2)").alias("difference"),
        F.col("curated_revenue").eqNullSafe(F.col("gold_revenue")).alias("equal"),
    )


def row_count_reconciliation(sales: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: row counts of both layers, as two scalar subqueries."""
    return sales.sparkSession.range(1).select(
        sales.agg(F.count("*")).scalar().alias("curated_sales_rows"),
        fact.agg(F.count("*")).scalar().alias("fact_sales_rows"),
    )
