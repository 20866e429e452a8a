"""Reports from partial aggregates against the reports over everything."""

import os
import random
import re
from datetime import date, timedelta
from decimal import Decimal

from tillwright.plans import marts, reports, sales, star
from tillwright.session import shared_dir

ROW = (
    "order_id bigint, order_date date, customer_id bigint, product_id string, category string, quantity int, "
    "total_amount decimal(27,2), profit decimal(29,2), payment_method string"
)


def _sold(seed, n):
    """Sales whose orders have several lines, on several days now and then, with missing values and wide order numbers."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        order = draw.choice([draw.randint(1, 60), draw.randint(30_000, 40_000), 10**12 + draw.randint(1, 9)])
        day = draw.choice([None, *(date(2024, 1, 1) + timedelta(days=k) for k in range(6))])
        product = draw.randint(1, 6)
        money = Decimal(draw.randint(0, 99_999)) / 100
        rows.append((order, day, draw.randint(1, 5), f"P{product}", draw.choice([f"c{product % 3}", None]), draw.randint(1, 9), money, money / 4, draw.choice(["x", "y", None])))
    return [(*row[:7], row[7].quantize(Decimal("0.01")), row[8]) for row in rows]


def rows_of(df):
    return df.columns, df.dtypes, sorted(map(repr, map(tuple, df.collect())))


def test_increments_give_what_one_pass_gives(spark, tmp_path):
    rows = _sold(4, 400)
    days = sorted({row[1] for row in rows if row[1]})
    kept = marts.marts(spark, str(tmp_path / "marts"))
    assert kept.rows(spark).collect() == []
    increments = [
        [row for row in rows if row[1] in days[:2]],
        [row for row in rows if row[1] in days[2:4]][::2],  # half of the sales of two days, which come again
        [row for row in rows if row[1] is None or row[1] in days[2:]],
    ]
    seen = [kept.update(spark, n, spark.createDataFrame(part, ROW)) for n, part in enumerate(increments)]
    assert [len(part) for part in seen] == [2, 2, 5] and "none" in seen[2]
    paths = kept.paths(spark)
    assert paths[str(days[0])].split("/")[-2] == "batch-000000000000" and paths[str(days[2])].split("/")[-2] == "batch-000000000002"
    assert kept.update(spark, 2, spark.createDataFrame(rows[:5], ROW)) == []
    parts, sold = kept.rows(spark), spark.createDataFrame(rows, ROW)
    customers = spark.createDataFrame([(n, f"f{n}", "l", "US", None) for n in range(1, 6)], "customer_id bigint, first_name string, last_name string, country string, state string")
    products = spark.createDataFrame([(f"P{n}", f"n{n}", "c", None) for n in range(1, 7)], "product_id string, product_name string, category string, brand string")
    dates = star.date_dimension(sold)
    fact = sold.selectExpr("*", "customer_id as customer_key", "product_id as product_key", "cast(date_format(order_date, 'yyyyMMdd') as int) as date_key")
    assert rows_of(marts.category_summary(parts)) == rows_of(sales.category_summary(sold))
    assert rows_of(marts.payment_summary(parts)) == rows_of(sales.payment_summary(sold))
    assert rows_of(marts.executive_kpis(parts)) == rows_of(reports.executive_kpis(fact))
    assert rows_of(marts.daily_sales(parts, dates)) == rows_of(reports.daily_sales(fact, dates))
    assert rows_of(marts.payment_performance(parts)) == rows_of(reports.payment_performance(fact))
    by_category = fact.groupBy("category").agg(*reports._measures()).select("*", reports._margin())
    assert rows_of(marts.category_performance(parts)) == rows_of(by_category)
    assert rows_of(marts.product_performance(parts, products)) == rows_of(reports.product_performance(fact, products.selectExpr("*", "product_id as product_key")))
    assert rows_of(marts.customer_performance(parts, customers)) == rows_of(reports.customer_performance(fact, customers.selectExpr("*", "customer_id as customer_key")))


def test_a_sale_is_one_partial_row(spark, tmp_path):
    """All keys of a sale share a row, beside the sums by day, category and payment method; an increment stores them once."""
    rows = _sold(5, 200)
    sold = spark.createDataFrame(rows, ROW)
    few = len({(row[1], row[4], row[8]) for row in rows})
    assert marts.partials(sold).count() == len(rows) + few
    kept = marts.marts(spark, str(tmp_path / "marts"), "yyyy-MM")
    before = set(os.listdir(shared_dir(spark)))
    assert kept.update(spark, 0, sold) == ["2024-01", "none"] and kept.rows(spark).count() == len(rows) + few
    assert set(os.listdir(shared_dir(spark))) == before


def test_an_increment_reads_its_days_only(spark, tmp_path):
    """With sales stored by day, the plan of an increment has the other days pruned."""
    spark.createDataFrame(_sold(9, 100), ROW).write.partitionBy("order_date").parquet(str(tmp_path / "sales"))
    sold = spark.read.parquet(str(tmp_path / "sales")).filter("order_date = date'2024-01-02'")
    plan = marts.partials(sold)._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert filters and all("order_date" in one for one in filters)
    spark.createDataFrame(_sold(9, 100), ROW).filter("order_date <> date'2024-01-02'").write.partitionBy("order_date").parquet(str(tmp_path / "others"))
    pruned = spark.read.parquet(str(tmp_path / "others")).filter("order_date = date'2024-01-02'")
    assert marts.partials(pruned).collect() == []
