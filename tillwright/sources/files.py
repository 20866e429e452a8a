"""CSV readers with declared schemas.

Columns bind by position and a token that does not fit its type becomes NULL while the row stays
(Spark's PERMISSIVE mode). Quotes inside a quoted field are doubled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwright.sources import schemas

CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file or folder under a declared schema."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Raw orders: text only."""
    return read_csv(spark, path, schemas.ORDERS_RAW)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Raw products: stock and weight are numbers, the rest is text."""
    return read_csv(spark, path, schemas.PRODUCTS_RAW)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Raw customers: id, date, flag and points are typed; only true/false are flags."""
    return read_csv(spark, path, schemas.CUSTOMERS_RAW)


def write_csv(df: DataFrame, path: str) -> None:
    """Write rows so that the readers above get every text back; an empty text comes back as NULL."""
    options = {
        "header": "true",
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    df.write.options(**options).csv(path)
