"""From raw files to reports and checks on the small shop."""

from datetime import date
from decimal import Decimal as D

import pytest
from fixture_files import write_shop
from pyspark.sql import functions as F

from tillwright.plans import build, curation, dashboard, sales, star, validation
from tillwright.sources import files, tables


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    folder = str(write_shop(tmp_path_factory.mktemp("shop")))
    return (
        files.read_customers(spark, f"{folder}/customers.csv"),
        files.read_products(spark, f"{folder}/products.csv"),
        files.read_orders(spark, f"{folder}/orders.csv"),
    )


@pytest.fixture(scope="module")
def layers(spark, shop):
    return build.build(spark, *shop, "shop_curated", "shop_gold")


def test_typed_read_turns_bad_tokens_into_null(shop):
    customers, products, _ = shop
    by_name = {row.first_name.strip(): row for row in customers.collect()}
    assert by_name["Kay"].customer_id is None
    assert by_name["Bo"].signup_date == date(2022, 3, 2)
    assert by_name["Gus"].signup_date is None
    assert by_name["Di"].is_active is None
    assert by_name["Flo"].first_name == "Flo"
    assert products.filter("product_id = 'P0002'").first().product_name == 'Screen 27"'
    assert products.filter("product_id = 'P0002'").first().weight_kg is None


def test_clean_customers(shop):
    rows = {row.customer_id: row for row in curation.clean_customers(shop[0]).collect()}
    assert sorted(rows) == [1, 2, 3]
    assert tuple(rows[1]) == (
        1, "Ada", "Byron", "ada@shop.org", "442079460000", date(2022, 3, 1), "USA", "NY", "00501", True, 10,
    )
    assert rows[2].loyalty_points == 0 and rows[2].country == "Canada" and rows[2].is_active is False
    assert rows[3].loyalty_points == 999999 and rows[3].country == "Peru" and rows[3].state == "LIMA"


def test_clean_products(shop):
    rows = {row.product_id: row for row in curation.clean_products(shop[1]).collect()}
    assert sorted(rows) == ["P0001", "P0002", "P0003"]
    assert rows["P0001"].price == D("19.99")
    assert rows["P0002"].price == D("399.99") and rows["P0002"].brand is None and rows["P0002"].weight_kg is None
    assert rows["P0002"].created_date == date(2022, 1, 2) and rows["P0002"].is_active is True
    assert rows["P0003"].is_active is False


def test_clean_orders(shop):
    rows = {row.order_id: row for row in curation.clean_orders(shop[2]).collect()}
    assert sorted(rows) == [101, 102, 103, 104, 116, 117, 118]
    assert rows[101].total_amount == D("53.97")
    assert rows[102].order_date == date(2023, 1, 6) and rows[102].ship_date == date(2023, 1, 9)
    assert rows[103].order_date == date(2023, 1, 7) and rows[103].total_amount == 0
    assert rows[104].total_amount == D("760.60") and rows[104].payment_method == "Card"


def test_rejected_orders_name_their_reasons(shop):
    survivors = curation.surviving_orders(shop[2])
    rejected = {row.order_id: row.reasons for row in curation.rejected_orders(survivors).collect()}
    assert rejected == {
        "105": ["ship_date missing"],
        "106": ["order_date missing"],
        "107": ["quantity not positive"],
        "108": ["quantity not positive"],
        "109": ["unit price negative"],
        "110": ["discount outside 0 to 100"],
        "111": ["discount outside 0 to 100"],
        "112": ["total amount negative"],
        "113": ["customer_id missing"],
        "114": ["product id malformed"],
        "115": ["payment_method missing"],
        "9999999999999999999999999": ["order id out of range"],
    }
    assert survivors.count() == len(rejected) + curation.valid_orders(survivors).count()


def test_options(shop):
    merged = curation.clean_orders(shop[2], payment_names={"Credit Card": ("card",)})
    assert {row.payment_method for row in merged.collect()} == {"Credit Card", "Cash"}
    some = curation.clean_orders(shop[2], statuses=("Delivered", "Shipped"))
    assert {row.order_status for row in some.collect()} == {"Delivered", "Shipped"}


def test_wide_and_narrow_ids(spark, shop):
    wide, narrow = curation.clean_orders(shop[2]), curation.clean_orders(shop[2], id_type="int")
    assert dict(wide.dtypes)["order_id"] == dict(wide.dtypes)["customer_id"] == "bigint"
    assert dict(narrow.dtypes)["order_id"] == dict(narrow.dtypes)["customer_id"] == "int"
    beyond = shop[2].filter("trim(order_id) = '101'").withColumn("order_id", F.lit("3000000101"))
    assert curation.clean_orders(beyond).first().order_id == 3_000_000_101
    assert curation.clean_orders(beyond, id_type="int").count() == 0
    customers = shop[0].filter("customer_id = 1").withColumn("customer_id", F.lit(3_000_000_000))
    assert curation.clean_customers(customers).first().customer_id == 3_000_000_000
    assert curation.clean_customers(customers, id_type="int").count() == 0


def test_product_id_pattern(shop):
    products = shop[1].withColumn("product_id", F.replace("product_id", F.lit("P"), F.lit("SKU-")))
    assert curation.clean_products(products).count() == 0
    assert curation.clean_products(products, r"^SKU-\d{4}$").count() == curation.clean_products(shop[1]).count() > 0


def test_funnel(shop):
    stages = {
        "customers": (shop[0], curation.clean_customers(shop[0])),
        "orders": (shop[2], curation.clean_orders(shop[2])),
    }
    assert {tuple(row) for row in curation.funnel(stages).collect()} == {("customers", 13, 3), ("orders", 22, 7)}


def test_tables(layers):
    curated, gold = layers
    counts = {name: df.count() for name, df in {**curated, **gold}.items()}
    assert counts == {
        "customers": 3, "products": 3, "orders": 4, "sales_curated": 4, "margin": 4, "category_summary": 3,
        "payment_summary": 2, "dim_customer": 3, "dim_product": 3, "dim_date": 4, "dim_payment": 2,
        "dim_order_status": 4, "fact_sales": 4,
    }


SCHEMAS = {
    "sales_curated": "order_id bigint, order_date date, ship_date date, customer_id bigint, customer_name string, country string, "
    "state string, product_id string, product_name string, category string, brand string, quantity int, unit_price decimal(10,2), "
    "discount_pct decimal(5,2), total_amount decimal(27,2), cost decimal(10,2), profit decimal(29,2), payment_method string, order_status string",
    "margin": "order_date date, product_name string, quantity int, cost decimal(10,2), unit_price decimal(10,2), "
    "total_amount decimal(27,2), profit decimal(29,2), profit_margin_pct decimal(35,2)",
    "category_summary": "category string, units_sold bigint, revenue decimal(38,2), profit decimal(38,2)",
    "payment_summary": "payment_method string, orders bigint, revenue decimal(38,2), profit decimal(38,2)",
    "dim_date": "date_key int, full_date date, year int, quarter int, month_number int, month_name string, day_of_month int, "
    "day_of_week_number int, day_name string",
    "fact_sales": "order_id bigint, customer_key bigint, product_key bigint, date_key int, customer_id bigint, product_id string, "
    "order_date date, quantity int, unit_price decimal(10,2), discount_pct decimal(5,2), total_amount decimal(27,2), "
    "profit decimal(29,2), payment_method string, order_status string",
}


@pytest.mark.parametrize("name", SCHEMAS)
def test_schema(layers, name):
    curated, gold = layers
    assert ", ".join(f"{column} {kind}" for column, kind in {**curated, **gold}[name].dtypes) == SCHEMAS[name]


def test_orders_table_is_the_semi_join(shop, layers):
    curated, _ = layers
    semi = sales.referenced_orders(curation.clean_orders(shop[2]), curated["customers"], curated["products"])
    assert sorted(map(repr, semi.select(*curated["orders"].columns).collect())) == sorted(
        map(repr, curated["orders"].collect())
    )


def test_margin_of_free_sale_is_null(layers):
    curated, _ = layers
    rows = {row.product_name: row for row in curated["margin"].collect()}
    assert rows["Pen"].profit == D("-20.00") and rows["Pen"].profit_margin_pct is None
    assert rows["Lamp"].profit == D("26.97") and rows["Lamp"].profit_margin_pct == D("49.97")


def test_reports(spark, layers):
    kpis = spark.table("vw_executive_kpis").first()
    assert tuple(kpis) == (4, 16, D("1214.56"), D("417.56"), D("34.38"), D("303.64"))
    days = spark.table("vw_daily_sales").orderBy("full_date").collect()
    assert [(row.full_date.isoformat(), row.month_name, row.units_sold) for row in days] == [
        ("2023-01-05", "Jan", 3), ("2023-01-06", "Jan", 1), ("2023-01-07", "Jan", 10), ("2023-02-01", "Feb", 2),
    ]
    categories = {row.category: row for row in spark.table("vw_category_performance").collect()}
    assert categories["Tech"].total_orders == 2 and categories["Tech"].revenue == D("1160.59")
    assert categories["Office"].profit_margin_pct is None
    assert spark.table("vw_product_performance").count() == 3
    customers = {row.customer_id: row.total_spent for row in spark.table("vw_customer_performance").collect()}
    assert customers == {1: D("814.57"), 2: D("399.99"), 3: D("0.00")}
    payments = {row.payment_method: row.total_orders for row in spark.table("vw_payment_performance").collect()}
    assert payments == {"Card": 3, "Cash": 1}


def test_dashboard(layers):
    _, gold = layers
    fact, customers = gold["fact_sales"], gold["dim_customer"]
    months = {row.month_name: row.revenue for row in dashboard.month_of_year_trend(fact, gold["dim_date"]).collect()}
    assert months == {"Jan": D("453.96"), "Feb": D("760.60")}
    segments = dashboard.customer_segments(fact, customers, high=800, medium=300)
    assert {row.customer_id: row.segment for row in segments.collect()} == {
        1: "High Value", 2: "Medium Value", 3: "Low Value",
    }
    activity = {row.customer_id: row.days_since_last_order for row in dashboard.customer_activity(fact, customers, gold["dim_date"]).collect()}
    assert activity == {1: 0, 2: 26, 3: 25}
    assert tuple(dashboard.customer_counts(customers).first()) == (3, 2, 1)
    shown = dashboard.showable_customers(customers, "secret")
    assert not set(shown.columns) & {"first_name", "last_name", "email", "phone", "postal_code"}


def test_checks_pass_and_reconcile(layers):
    curated, gold = layers
    outcome = build.quality_report(curated, gold).collect()
    assert len(outcome) == len(validation.curated_checks()) + len(validation.gold_checks())
    assert all(row.passed for row in outcome)
    revenue = validation.revenue_reconciliation(curated["sales_curated"], gold["fact_sales"]).first()
    assert (revenue.difference, revenue.equal) == (0, True)


def test_checks_see_a_lost_dimension_row(layers):
    curated, gold = layers
    fewer = gold["dim_product"].filter("product_id <> 'P0002'")
    fact = star.sales_fact(curated["sales_curated"], gold["dim_customer"], fewer)
    outcome = build.quality_report(curated, {**gold, "dim_product": fewer, "fact_sales": fact.limit(3)})
    failed = {row.check_name for row in outcome.collect() if not row.passed}
    assert {"product_key is null", "product_key unknown", "revenue differs", "row count differs"} >= failed >= {
        "product_key unknown", "row count differs",
    }


def test_build_replaces_its_tables(spark, shop, layers):
    before = {row.order_id for row in spark.table("shop_curated.orders").collect()}
    build.build(spark, shop[0], shop[1], shop[2].filter("order_id <> '102'"), "shop_curated", "shop_gold")
    tables.refresh(spark, "shop_curated.orders")
    assert {row.order_id for row in spark.table("shop_curated.orders").collect()} == before - {102}
    build.build(spark, *shop, "shop_curated", "shop_gold")


def test_catalog(spark, layers, tmp_path):
    assert set(tables.names_in(spark, "shop_gold")) >= {"dim_customer", "dim_product", "dim_date", "fact_sales"}
    spark.table("shop_gold.dim_date").write.parquet(str(tmp_path / "days"))
    tables.ensure_namespace(spark, "mounted")
    assert tables.mount(spark, "mounted.days", str(tmp_path / "days")).count() == 4
    assert tables.alias_table(spark, "mounted.orders_curated", "shop_curated.orders").count() == 4
    tables.use_namespace(spark, "mounted")
    assert spark.table("days").count() == 4
    tables.use_namespace(spark, "default")
    assert tables.names_in(spark, "mounted") == ["days", "orders_curated"]


def test_csv_round_trip(spark, shop, tmp_path):
    rows = spark.createDataFrame(
        [(' a "quoted", text ', "x\\y"), ("", None)], "order_id string, customer_id string"
    ).select("order_id", "customer_id", *[F.lit(None).cast("string").alias(c) for c in shop[2].columns[2:]])
    files.write_csv(rows, str(tmp_path / "rows"))
    back = files.read_orders(spark, str(tmp_path / "rows")).collect()
    assert {(row.order_id, row.customer_id) for row in back} == {(' a "quoted", text ', "x\\y"), (None, None)}
