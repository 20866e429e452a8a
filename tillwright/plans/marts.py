"""Reports that are kept up to date: partial rows per day, of which new days alone are computed.

Partial rows are of two levels, so that they merge exactly. ``sums`` has the sums of one day, category and payment method, which add;
the reports that need no more than those read nothing else. ``orders`` has every sale with its order number, the keys of all reports and
its amounts: distinct orders don't add, and a product or customer has hardly two sales a day, so rows by key and day are as many, once for every key.
One row a sale for all keys is moved once when it is written, and a report moves its own key and the numbers only. Days, or longer periods, are
parts of a folder (see :mod:`tillwright.sources.parts`): an increment replaces the parts of its days, and its sales are all that is read.

The reports are those of :mod:`tillwright.plans.reports` and the summaries of :mod:`tillwright.plans.sales`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwright.functions.measures import SUMMED_MONEY, margin_pct, per_order
from tillwright.sources.parts import Parts

# Levels of the partial rows, and what a row of each is told apart by.
SUMS, ORDERS = "sums", "orders"
COARSE = ("order_date", "category", "payment_method")
FINE = ("order_id", "customer_id", "product_id")

PERIOD = "period"
PARTIAL = (
    "level string, order_date date, category string, payment_method string, order_id bigint, customer_id string, product_id string, "
    f"sales bigint, units bigint, revenue {SUMMED_MONEY}, profit {SUMMED_MONEY}"
)


def _sums(units: str = "quantity", revenue: str = "total_amount", profit: str = "profit", sales: Column | None = None) -> list[Column]:
    return [
        (F.count(F.lit(1)) if sales is None else F.sum(sales)).alias("sales"),
        F.sum(units).cast("bigint").alias("units"),
        F.sum(revenue).cast(SUMMED_MONEY).alias("revenue"),
        F.sum(profit).cast(SUMMED_MONEY).alias("profit"),
    ]


def partials(sold: DataFrame) -> DataFrame:
    """The partial rows of enriched sales, which are read once for each level; sales without a day are a day of their own."""
    kinds = {field.name: field.dataType for field in sold.sparkSession.createDataFrame([], PARTIAL).schema}
    order = sold.select("*", F.lit(1).alias("sales"), F.col("quantity").alias("units"), F.col("total_amount").alias("revenue"))
    levels = {SUMS: sold.groupBy(*COARSE).agg(*_sums()), ORDERS: order}

    def rows(level: str, df: DataFrame) -> DataFrame:
        known = {"level": F.lit(level), **{name: F.lit(None) for name in FINE if level == SUMS}}
        return df.select(*(known.get(name, F.col(name)).cast(kind).alias(name) for name, kind in kinds.items()))

    return rows(SUMS, levels[SUMS]).union(rows(ORDERS, levels[ORDERS]))


def _summed(parts: DataFrame, level: str, *by: str) -> DataFrame:
    """Sums of the rows of a level by some of its columns."""
    return parts.filter(F.col("level") == level).groupBy(*by).agg(*_sums("units", "revenue", "profit", F.col("sales")))


def _merged(parts: DataFrame, *by: str) -> DataFrame:
    """Sums and distinct orders by some columns of the partial rows."""
    rows = parts.filter(F.col("level") == ORDERS)
    if set(by) & set(FINE):
        sums = _sums("units", "revenue", "profit", F.col("sales"))
        return rows.groupBy(*by).agg(F.count_distinct("order_id").alias("total_orders"), *sums)
    # Sums come from the few rows that have them, so that order numbers alone are brought together.
    orders = rows.select(*by, "order_id").distinct().groupBy(*by).agg(F.count("order_id").alias("total_orders"))
    sums = _summed(parts, SUMS, *by)
    if not by:
        return sums.crossJoin(orders)
    named = orders.select(*(F.col(name).alias(f"_{name}") for name in by), "total_orders")
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in by]
    return sums.join(named, same).drop(*(f"_{name}" for name in by))


def _shown(units: str = "units_sold", revenue: str = "revenue", profit: str = "profit") -> list[Column]:
    return [F.col("total_orders"), F.col("units").alias(units), F.col("revenue").alias(revenue), F.col("profit").alias(profit)]


_MARGIN = "profit_margin_pct"


def executive_kpis(parts: DataFrame) -> DataFrame:
    """One row over everything."""
    totals = _merged(parts).select(*_shown("total_units_sold", "total_revenue", "total_profit"))
    return totals.select(
        "*", margin_pct(F.col("total_profit"), F.col("total_revenue")).alias("overall_profit_margin_pct"),
        per_order(F.col("total_revenue"), F.col("total_orders")).alias("average_order_value"),
    )


def daily_sales(parts: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales per day with the attributes of the date dimension."""
    days = _merged(parts, "order_date").select("order_date", *_shown())
    attributes = ["full_date", "year", "quarter", "month_number", "month_name"]
    return days.join(dates.select(*attributes), F.col("order_date") == F.col("full_date")).drop("order_date").select(
        *attributes, "total_orders", "units_sold", "revenue", "profit"
    )


def category_performance(parts: DataFrame) -> DataFrame:
    """Sales and margin per category."""
    margin = margin_pct(F.col("profit"), F.col("revenue")).alias(_MARGIN)
    return _merged(parts, "category").select("category", *_shown(), margin)


def payment_performance(parts: DataFrame) -> DataFrame:
    """Sales per payment method."""
    return _merged(parts, "payment_method").select("payment_method", *_shown())


def product_performance(parts: DataFrame, products: DataFrame) -> DataFrame:
    """Sales and margin per product."""
    sums = _merged(parts, "product_id").select("product_id", *_shown())
    attributes = ["product_id", "product_name", "category", "brand"]
    margin = margin_pct(F.col("profit"), F.col("revenue")).alias(_MARGIN)
    return sums.join(products.select(*attributes), "product_id").select(*attributes, "total_orders", "units_sold", "revenue", "profit", margin)


def customer_performance(parts: DataFrame, customers: DataFrame) -> DataFrame:
    """Purchases per customer."""
    names = ("units_purchased", "total_spent", "total_profit_generated")
    kind = customers.schema["customer_id"].dataType
    sums = _merged(parts, "customer_id").select(F.col("customer_id").cast(kind), *_shown(*names))
    attributes = ["customer_id", "first_name", "last_name", "country", "state"]
    return sums.join(customers.select(*attributes), "customer_id").select(*attributes, "total_orders", *names)


def category_summary(parts: DataFrame) -> DataFrame:
    """Units, revenue and profit per category."""
    return _summed(parts, SUMS, "category").select("category", F.col("units").alias("units_sold"), "revenue", "profit")


def payment_summary(parts: DataFrame) -> DataFrame:
    """Sales, revenue and profit per payment method."""
    return _summed(parts, SUMS, "payment_method").select("payment_method", F.col("sales").alias("orders"), "revenue", "profit")


@dataclass(frozen=True)
class Marts(Parts):
    """A folder of partial rows by day, or by what the pattern ``period`` says."""

    period: str = "yyyy-MM-dd"

    def update(self, spark: SparkSession, batch: int, sold: DataFrame) -> list[str]:
        """Take in all sales of some periods, instead of what those had; returns the periods. A batch that counts already is skipped.

        ``sold`` must hold every sale of the periods it has, and nothing else is read. It is read twice and should be stored.
        """
        if batch <= self.batch(spark):
            return []
        period = F.coalesce(F.date_format("order_date", self.period), F.lit("none"))
        return self.replace(spark, batch, partials(sold).withColumn(PERIOD, period), PERIOD)


def marts(spark: SparkSession, folder: str, period: str = "yyyy-MM-dd") -> Marts:
    """The partial rows under ``folder``, which need not exist yet.

    Choose a period whose partial rows make files of a useful size; a few small files a day soon are very many.
    """
    return Marts(folder, spark.createDataFrame([], PARTIAL).schema, period)
