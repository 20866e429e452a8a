"""Registered queries: one per operator, over the generated tables (see ``standins``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from querybook import standins as si
from tillwright.functions import dates, measures, numbers, text
from tillwright.operators.checks import duplicate_keys, report, row_counts
from tillwright.operators.dedup import one_row_per_key
from tillwright.operators.keys import stable_key
from tillwright.operators.ranking import ranked, top
from tillwright.operators.references import orphan_keys, with_attributes, with_surrogate
from tillwright.plans import build, curation, dashboard, marts, reports, sales, star, validation, views
from tillwright.session import read_alike, scratch_path, stored
from tillwright.sources import files, tables
from tillwright.sources.versions import Staging
from tillwright.streaming import increments, upserts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its name."""
    QUERIES[function.__name__] = function
    return function


# --- sources, sinks, catalog ------------------------------------------------------------------


@query
def src1_orders_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    files.write_csv(si.raw_orders(spark, sf_dir), path)
    return files.read_orders(spark, path)


@query
def src2_products_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "products-csv")
    files.write_csv(si.raw_products_text(spark, sf_dir), path)
    return files.read_products(spark, path)


@query
def src3_customers_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customers-csv")
    files.write_csv(si.raw_customers_text(spark, sf_dir), path)
    return files.read_customers(spark, path)


def _fresh_namespace(spark: SparkSession, label: str) -> str:
    location = scratch_path(spark, label)
    name = location.rsplit("/", 1)[1].replace("-", "_")
    tables.ensure_namespace(spark, name, location)
    return name


@query
def snk1_save_and_scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{_fresh_namespace(spark, 'curated')}.margin"
    return tables.save_table(sales.margins(_sales(spark, sf_dir)), name)


@query
def snk2_save_dimension_and_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _fresh_namespace(spark, "gold")
    customers = tables.save_table(_dim_customer(spark, sf_dir), f"{gold}.dim_customer")
    products = tables.save_table(_dim_product(spark, sf_dir), f"{gold}.dim_product")
    return tables.save_table(star.sales_fact(_sales(spark, sf_dir), customers, products), f"{gold}.fact_sales")


@query
def snk3_reporting_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = _fresh_namespace(spark, "views")
    tables.save_table(_sales(spark, sf_dir).select("category", "quantity", "total_amount"), f"{namespace}.sales_curated")
    body = "SELECT category, sum(quantity) AS units_sold, cast(sum(total_amount) AS decimal(38,2)) AS revenue"
    return tables.save_view(
        spark, f"{namespace}.vw_units", f"{body} FROM {namespace}.sales_curated GROUP BY category"
    )


def _gold_view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """One of the catalog's views over a star schema that was published with it, as a second session reads it."""
    gold = _fresh_namespace(spark, "gold")
    staging = Staging(spark)
    sold = staging.add(_sales(spark, sf_dir), f"{gold}.sold")
    curated = {"sales_curated": sold, "customers": si.customers(spark, sf_dir), "products": si.products(spark, sf_dir)}
    build.stage_gold(staging, curated, gold)
    views.stage_views(staging, gold)
    staging.publish()
    return spark.newSession().table(f"{gold}.{view}")


@query
def snk3_executive_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_view(spark, sf_dir, "vw_executive_kpis")


@query
def snk3_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_view(spark, sf_dir, "vw_daily_sales")


@query
def snk3_category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_view(spark, sf_dir, "vw_category_performance")


@query
def snk3_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_view(spark, sf_dir, "vw_product_performance")


@query
def snk3_payment_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_view(spark, sf_dir, "vw_payment_performance")


@query
def snk3_customer_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_view(spark, sf_dir, "vw_customer_performance")


@query
def snk1_switched_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after its second version was shown, beside what a reader of the first one still gets."""
    name = f"{_fresh_namespace(spark, 'curated')}.products"
    tables.save_table(si.products(spark, sf_dir), name)
    earlier = spark.table(name).select("product_id", F.lit("first").alias("version"), "price")
    tables.save_table(_known_products(spark, sf_dir).withColumn("price", F.expr("cast(price * 2 as decimal(10,2))")), name)
    return earlier.union(spark.table(name).select("product_id", F.lit("second"), "price"))


@query
def cat3_mounted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stored-customers")
    si.customers(spark, sf_dir).write.parquet(path)
    namespace = _fresh_namespace(spark, "mounted")
    mounted = tables.mount(spark, f"{namespace}.customers_curated", path)
    tables.refresh(spark, f"{namespace}.customers_curated")
    return mounted


@query
def cat3_mounted_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second mount of an alias shows the second files."""
    alias = f"{_fresh_namespace(spark, 'mounted')}.members"
    for label, rows in (("stored-customers", si.customers(spark, sf_dir)), ("stored-products", si.products(spark, sf_dir))):
        path = scratch_path(spark, label)
        rows.write.parquet(path)
        mounted = tables.mount(spark, alias, path)
    return mounted


# --- column rules -----------------------------------------------------------------------------


@query
def cln1_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.trimmed(si.raw_products_text(spark, sf_dir))


@query
def cln2_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.without_tokens(si.raw_orders(spark, sf_dir))


@query
def cln3_number_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.select_text(si.table(spark, sf_dir, "part"), si.PRODUCT_TEXT, "product_id", "price", "cost", bases="products")
    return raw.withColumns({name: text.tokens_to_null(F.col(name), text.NUMBER_PLACEHOLDERS) for name in ("price", "cost")})


@query
def cln4_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.select_text(si.table(spark, sf_dir, "customer"), si.CUSTOMER_TEXT, "customer_id", "email", bases="customers")
    return raw.withColumn("email", text.email_address(text.blank_to_null(F.col("email"))))


@query
def cln5_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.select_text(si.table(spark, sf_dir, "customer"), si.CUSTOMER_TEXT, "customer_id", "phone", bases="customers")
    return raw.withColumn("phone", text.phone_number(F.col("phone")))


@query
def cln6_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.select_text(si.table(spark, sf_dir, "customer"), si.CUSTOMER_TEXT, "customer_id", "loyalty_points", bases="customers")
    return raw.withColumn("loyalty_points", numbers.at_least_zero(numbers.whole_number(F.col("loyalty_points"))))


@query
def cln7_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.select_text(si.table(spark, sf_dir, "customer").join(si.table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey")), si.CUSTOMER_TEXT, "customer_id", "country", bases="customers")
    return raw.withColumn("country", text.canonical(F.col("country")))


@query
def cln8_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.select_text(si.customer_rows(spark, sf_dir), si.CUSTOMER_TEXT, "customer_id", "state", bases="customers")
    return raw.withColumn("state", text.upper_code(F.col("state")))


@query
def cln9_all_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.parse_customers(si.raw_customers(spark, sf_dir)).dropna()


@query
def cln10_some_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.parse_products(si.raw_products(spark, sf_dir)).dropna(subset=list(curation.PRODUCT_REQUIRED))


@query
def cln11_one_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_row_per_key(curation.without_tokens(si.raw_orders(spark, sf_dir)), ["order_id"])


@query
def cln12_id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.select_text(si.table(spark, sf_dir, "part"), si.PRODUCT_TEXT, "product_id", "product_name", bases="products")
    return curation.trimmed(raw).filter(text.matches(F.col("product_id")))


@query
def cln13_numeric_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.raw_orders(spark, sf_dir).select("order_id", "customer_id")
    return curation.without_tokens(raw).select(*[numbers.numeric_id(F.col(name)).alias(name) for name in raw.columns])


@query
def cln14_list_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.select_text(si.table(spark, sf_dir, "part"), si.PRODUCT_TEXT, "product_id", "price", "cost", bases="products")
    priced = {name: numbers.list_price(text.tokens_to_null(F.col(name), text.NUMBER_PLACEHOLDERS)) for name in ("price", "cost")}
    return raw.withColumns(priced)


def _lines(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return curation.without_tokens(si.select_text(si.table(spark, sf_dir, "lineitem"), si.LINE_TEXT, *names, bases="lines"))


@query
def cln15_order_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, "order_id", "unit_price", "total_amount")
    return lines.withColumns(
        {
            "unit_price": numbers.order_price(F.col("unit_price")),
            "total_amount": numbers.plain_money(F.col("total_amount")),
        }
    )


@query
def cln16_percentage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, "order_id", "discount_pct")
    return lines.withColumn("discount_pct", numbers.percentage(F.col("discount_pct")))


@query
def cln17_whole_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, "order_id", "quantity")
    return lines.withColumn("quantity", numbers.whole_number(F.col("quantity")))


@query
def cln18_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = curation.parse_orders(si.raw_orders(spark, sf_dir))
    rules = {name: rule for name, rule in curation.order_rules().items() if not name.endswith(("missing", "range"))}
    return parsed.filter(curation.requirement(rules)).drop("order_number")


@query
def cln19_iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.select_text(si.table(spark, sf_dir, "part"), si.PRODUCT_TEXT, "product_id", "created_date", bases="products")
    return raw.withColumn("created_date", dates.standard_date(text.blank_to_null(F.col("created_date"))))


@query
def cln20_two_date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, "order_id", "ship_date")
    return lines.withColumn("ship_date", dates.standard_date(F.col("ship_date"), (dates.ISO_DAY, dates.US_DAY)))


@query
def cln21_yes_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = si.select_text(si.table(spark, sf_dir, "part"), si.PRODUCT_TEXT, "product_id", "is_active", bases="products")
    return raw.withColumn("is_active", text.yes_no(text.blank_to_null(F.col("is_active"))))


@query
def cln22_line_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = si.select_text(si.table(spark, sf_dir, "lineitem"), si.ORDER, "order_id", "quantity", "unit_price", "discount_pct")
    return priced.withColumn(
        "total_amount", measures.line_total(F.col("quantity"), F.col("unit_price"), F.col("discount_pct"))
    )


@query
def cln23_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {
        "customers": (si.raw_customers(spark, sf_dir), curation.clean_customers),
        "products": (si.raw_products(spark, sf_dir), curation.clean_products),
        "orders": (si.raw_orders(spark, sf_dir), curation.clean_orders),
    }
    return curation.funnel({entity: (df, clean(df)) for entity, (df, clean) in raw.items()})


# --- curated entities from raw text -----------------------------------------------------------


@query
def cln_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.clean_customers(si.raw_customers(spark, sf_dir))


@query
def cln_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.clean_products(si.raw_products(spark, sf_dir))


@query
def cln_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.clean_orders(si.raw_orders(spark, sf_dir))


@query
def jn2_sales_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.enriched_sales(cln_orders(spark, sf_dir), cln_customers(spark, sf_dir), cln_products(spark, sf_dir))


# --- joins ------------------------------------------------------------------------------------


def _known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.customers(spark, sf_dir, si.KNOWN_CUSTOMERS)


def _known_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.products(spark, sf_dir, si.KNOWN_PRODUCTS)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.enriched_sales(si.orders(spark, sf_dir), si.customers(spark, sf_dir), si.products(spark, sf_dir))


def _dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.customer_dimension(si.customers(spark, sf_dir))


def _dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.product_dimension(si.products(spark, sf_dir))


def _part_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer dimension that lacks members, for the queries about orphans."""
    return star.customer_dimension(_known_customers(spark, sf_dir))


def _part_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product dimension that lacks members, for the queries about orphans."""
    return star.product_dimension(_known_products(spark, sf_dir))


def _dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_dimension(_sales(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.sales_fact(_sales(spark, sf_dir), _dim_customer(spark, sf_dir), _dim_product(spark, sf_dir))


def _part_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.sales_fact(_sales(spark, sf_dir), _part_customer(spark, sf_dir), _part_product(spark, sf_dir))


def _fact_by_product(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The fact with only the product looked up, and the product dimension."""
    dimension = _dim_product(spark, sf_dir)
    return with_surrogate(_sales(spark, sf_dir), dimension, "product_id", "product_key"), dimension


def _fact_by_customer(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The fact with only the customer looked up, and the customer dimension."""
    dimension = _dim_customer(spark, sf_dir)
    return with_surrogate(_sales(spark, sf_dir), dimension, "customer_id", "customer_key"), dimension


def _fact_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with only its date key."""
    return _sales(spark, sf_dir).withColumn("date_key", dates.day_number(F.col("order_date")))


@query
def jn1_referenced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.referenced_orders(si.orders(spark, sf_dir), _known_customers(spark, sf_dir), _known_products(spark, sf_dir))


@query
def jn2_enriched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.enriched_sales(si.orders(spark, sf_dir), _known_customers(spark, sf_dir), _known_products(spark, sf_dir))


@query
def jn3_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = si.orders(spark, sf_dir).select("order_id", "customer_id", "total_amount")
    return with_surrogate(ordered, _part_customer(spark, sf_dir), "customer_id", "customer_key")


@query
def jn4_fact_to_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = _part_product(spark, sf_dir)
    fact = with_surrogate(_sales(spark, sf_dir), dimension, "product_id", "product_key")
    lines = fact.select("order_id", "product_key", "quantity", "total_amount")
    return with_attributes(lines, dimension, "product_key", ["product_id", "category"])


@query
def jn5_orphan_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_keys(_sales(spark, sf_dir), _known_products(spark, sf_dir), "product_id")


# --- marts and reporting views ----------------------------------------------------------------


@query
def ag1_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.category_summary(_sales(spark, sf_dir))


@query
def ag2_payment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.payment_summary(_sales(spark, sf_dir))


@query
def ag3_executive_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.executive_kpis(_sales(spark, sf_dir))


@query
def ag4_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_sales(_fact_by_day(spark, sf_dir), _dim_date(spark, sf_dir))


@query
def ag5_category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_performance(*_fact_by_product(spark, sf_dir))


@query
def ag6_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.product_performance(*_fact_by_product(spark, sf_dir))


@query
def ag7_payment_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.payment_performance(_sales(spark, sf_dir))


@query
def ag8_customer_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.customer_performance(*_fact_by_customer(spark, sf_dir))


@query
def ag9_category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_revenue(*_fact_by_product(spark, sf_dir))


@query
def ag10_conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = curation.parse_orders(si.raw_orders(spark, sf_dir))
    return parsed.agg(*[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in ("order_id", "customer_id", "product_id")])


@query
def ag11_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(si.orders(spark, sf_dir), "order_id")


@query
def ag12_line_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.margins(_sales(spark, sf_dir))


# --- star schema ------------------------------------------------------------------------------


@query
def dim1_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_customer(spark, sf_dir)


@query
def dim2_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_product(spark, sf_dir)


@query
def dim3_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_date(spark, sf_dir)


@query
def dim4_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_fact(spark, sf_dir)


@query
def dim5_payment_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.payment_dimension(_sales(spark, sf_dir))


@query
def dim5_order_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.status_dimension(_sales(spark, sf_dir))


# --- ordered reports, set operations, subqueries ----------------------------------------------


@query
def ord1_days_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag4_daily_sales(spark, sf_dir).orderBy("full_date")


@query
def ord2_products_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(ag6_product_performance(spark, sf_dir), "revenue", "product_id")


@query
def ord3_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(ag1_category_summary(spark, sf_dir), "units_sold", 10, "category")


@query
def ord3_top_payment_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(ag2_payment_summary(spark, sf_dir), "orders", 10, "payment_method")


@query
def ord3_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(ag8_customer_performance(spark, sf_dir), "total_spent", 10, "customer_id")


@query
def set2_distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).select("order_date").distinct()


@query
def sub1_two_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = _sales(spark, sf_dir)
    return validation.row_count_reconciliation(sold, with_surrogate(sold, _dim_product(spark, sf_dir), "product_id", "product_key"))


# --- data quality and reconciliation ----------------------------------------------------------


@query
def dq1_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = _sales(spark, sf_dir)
    return row_counts(
        {
            "customers": si.customers(spark, sf_dir),
            "products": si.products(spark, sf_dir),
            "orders": si.orders(spark, sf_dir),
            "sales_curated": sold,
            "category_summary": sales.category_summary(sold),
            "payment_summary": sales.payment_summary(sold),
            "margin": sales.margins(sold),
        }
    )


@query
def dq1_gold_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(
        {
            "dim_customer": _dim_customer(spark, sf_dir),
            "dim_product": _dim_product(spark, sf_dir),
            "dim_date": _dim_date(spark, sf_dir),
            "fact_sales": _fact(spark, sf_dir),
        }
    )


@query
def dq2_repeated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(si.raw_customers(spark, sf_dir), "customer_id")


@query
def dq2_repeated_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(curation.parse_products(si.raw_products(spark, sf_dir)), "product_id")


@query
def dq2_repeated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(curation.without_tokens(si.raw_orders(spark, sf_dir)), "order_id")


@query
def dq3_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = {
        "customers": si.raw_customers(spark, sf_dir),
        "products": curation.parse_products(si.raw_products(spark, sf_dir)),
        "orders": curation.parse_orders(si.raw_orders(spark, sf_dir)),
    }
    checks = [check for check in validation.curated_checks() if check.name.endswith("is null")]
    return report(layer, checks)


@query
def dq4_unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.unmatched_keys(_part_fact(spark, sf_dir))


@query
def dq5_repeated_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, products = _dim_customer(spark, sf_dir), _dim_product(spark, sf_dir)
    gold = {  # with rows that are there twice
        "dim_customer": customers.union(customers.filter("loyalty_points < 0")),
        "dim_product": products.union(products.filter("stock_quantity > 400")),
        "dim_date": _dim_date(spark, sf_dir),
    }
    return report(gold, [check for check in validation.gold_checks() if check.name.endswith("repeats")])


@query
def dq6_revenue_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sales.enriched_sales(si.orders(spark, sf_dir), si.customers(spark, sf_dir), _known_products(spark, sf_dir))
    return validation.revenue_reconciliation(_sales(spark, sf_dir), kept)


@query
def dq7_row_count_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sales.enriched_sales(si.orders(spark, sf_dir), si.customers(spark, sf_dir), _known_products(spark, sf_dir))
    return validation.row_count_reconciliation(_sales(spark, sf_dir), kept)


@query
def dq8_orphan_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_keys(_sales(spark, sf_dir), _known_customers(spark, sf_dir), "customer_id")


@query
def dq8_orphan_product_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = _part_product(spark, sf_dir)
    fact = with_surrogate(_sales(spark, sf_dir), dimension, "product_id", "product_key")
    return orphan_keys(fact, dimension, "product_key")


@query
def dq9_product_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.products(spark, sf_dir).select("product_id", "product_name", "category").orderBy("product_id")


@query
def dq_full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    # neither is stored; the columns are those that the checks and the lookups of the fact read
    sold = read_alike(_sales(spark, sf_dir), "order_id", "order_date", "customer_id", "product_id", "total_amount")
    curated = {
        "customers": _known_customers(spark, sf_dir),
        "products": _known_products(spark, sf_dir),
        "orders": sales.orders_of(sold),
        "sales_curated": sold,
    }
    gold = {
        "dim_customer": _part_customer(spark, sf_dir),
        "dim_product": _part_product(spark, sf_dir),
        "dim_date": star.date_dimension(sold),
    }
    fact = star.sales_fact(sold, gold["dim_customer"], gold["dim_product"])
    gold["fact_sales"] = read_alike(fact, "customer_key", "product_key", "date_key", "total_amount")
    return build.quality_report(curated, gold)


# --- dashboard measures -----------------------------------------------------------------------


@query
def bi2_monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.monthly_trend(_fact_by_day(spark, sf_dir), _dim_date(spark, sf_dir))


@query
def bi2_month_of_year_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.month_of_year_trend(_fact_by_day(spark, sf_dir), _dim_date(spark, sf_dir))


@query
def bi3_product_margin_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.product_margin_map(*_fact_by_product(spark, sf_dir))


@query
def bi4_customer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.customer_counts(si.customers(spark, sf_dir))


# Spend cuts of the segment queries: order lines here are worth far more than a retail basket.
_HIGH, _MEDIUM = 50_000_000, 40_000_000


@query
def bi5_customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.customer_segments(*_fact_by_customer(spark, sf_dir), high=_HIGH, medium=_MEDIUM)


@query
def bi6_segment_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.segment_revenue(bi5_customer_segments(spark, sf_dir))


@query
def bi7_customer_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.customer_activity(*_fact_by_customer(spark, sf_dir), _dim_date(spark, sf_dir))


@query
def bi8_showable_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.showable_customers(_dim_customer(spark, sf_dir), si.SECRET)


# --- streams and gates ------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A generated table as a file stream; the pattern lets it be one file or a folder."""
    schema = si.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


@query
def ext1_orders_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increments.curate_available(si.raw_orders(spark, sf_dir, _stream(spark, sf_dir, "lineitem")))


@query
def ext1_first_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events")
    events = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    arrived = increments.first_arrivals(events, ["event_id"], "ts", "1 hour")
    writer = arrived.select("event_id", "user_id", "event_type", "value").writeStream.format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", scratch_path(spark, "events-progress"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path)


@query
def ext2_rejected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    survivors = curation.surviving_orders(si.raw_orders(spark, sf_dir))
    rejected = curation.rejected_orders(survivors)
    return rejected.select("order_id", F.concat_ws("; ", "reasons").alias("reasons"))


def _entities(spark: SparkSession, sf_dir: str, namespace: str, seen: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    """Accepted and rejected rows of the three raw frames, stored in one pass over each."""
    raw = {"customers": si.raw_customers(spark, sf_dir), "products": si.raw_products(spark, sf_dir), "orders": si.raw_orders(spark, sf_dir)}
    if seen is not None:
        raw = {name: df.observe(seen[name], F.count(F.lit(1)).alias("rows")) for name, df in raw.items()}
    return build.stage_entities(Staging(spark), *raw.values(), namespace)


def _stored_rejects(spark: SparkSession, sf_dir: str, entity: str, key: str) -> DataFrame:
    rejected = _entities(spark, sf_dir, _fresh_namespace(spark, "entities"))[f"rejected_{entity}"]
    return rejected.select(key, F.concat_ws("; ", "reasons").alias("reasons"))


@query
def ext2_stored_customer_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_rejects(spark, sf_dir, "customers", "customer_id")


@query
def ext2_stored_product_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_rejects(spark, sf_dir, "products", "product_id")


@query
def ext2_stored_order_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_rejects(spark, sf_dir, "orders", "order_id")


@query
def cln23_counts_of_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel without another scan: raw rows are counted while accepted and rejected ones are written."""
    seen = {name: Observation(name) for name in ("customers", "products", "orders")}
    entities = _entities(spark, sf_dir, _fresh_namespace(spark, "entities"), seen)
    read = {name: one.get["rows"] for name, one in seen.items()}
    return build.build_funnel(build.layer_counts(spark, read, entities, {}, {}))


@query
def ext1_orders_by_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders arriving in three batches, merged bucket by bucket; copies of an id come in different batches."""
    into = upserts.order_upserts(spark, scratch_path(spark, "upserts"), bucket=upserts.hashed(8))
    for batch in (0, 1, 2):
        lines = si.table(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") % 3 == batch)
        into.merge(spark, batch, curation.surviving_orders(si.raw_orders(spark, sf_dir, lines)))
    return upserts.upserted_orders(spark, into)


@query
def dim1_stable_customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of all customers, a second run finding more of them than the first."""
    first = _part_customer(spark, sf_dir).select("customer_id", "customer_key")
    return stable_key(si.customers(spark, sf_dir), "customer_id", "customer_key", first)[0]


@query
def dim2_stable_product_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the products that are still known, a first run having had others as well."""
    first = _dim_product(spark, sf_dir).filter("stock_quantity < 300").select("product_id", "product_key")
    return stable_key(_known_products(spark, sf_dir), "product_id", "product_key", first)[0]


# Order days up to these end the first and the second increment of the mart queries; the third brings months of the second again.
_FIRST, _SECOND = "1994-06-30", "1996-06-30"


def _marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial rows after three increments, the last of which replaces months of the second that had come without half of their sales."""
    kept = marts.marts(spark, scratch_path(spark, "marts"), "yyyy-MM")
    columns = ["order_id", "order_date", "customer_id", "product_id", "category", "quantity", "total_amount", "profit", "payment_method"]
    sold = stored(_sales(spark, sf_dir).select(*columns), "sold")
    kept.update(spark, 0, sold.filter(F.col("order_date") <= _FIRST))
    second = sold.filter((F.col("order_date") > _FIRST) & (F.col("order_date") <= _SECOND))
    kept.update(spark, 1, second.filter((F.month("order_date") != 2) | (F.col("quantity") > 25)))
    kept.update(spark, 2, sold.filter((F.col("order_date") > _SECOND) | ((F.col("order_date") > _FIRST) & (F.month("order_date") == 2))))
    return kept.rows(spark)


@query
def ext1_mart_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.category_summary(_marts(spark, sf_dir))


@query
def ext1_mart_payment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.payment_summary(_marts(spark, sf_dir))


@query
def ext1_mart_executive_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.executive_kpis(_marts(spark, sf_dir))


@query
def ext1_mart_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_sales(_marts(spark, sf_dir), _dim_date(spark, sf_dir))


@query
def ext1_mart_category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.category_performance(_marts(spark, sf_dir))


@query
def ext1_mart_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.product_performance(_marts(spark, sf_dir), si.products(spark, sf_dir))


@query
def ext1_mart_payment_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.payment_performance(_marts(spark, sf_dir))


@query
def ext1_mart_customer_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_performance(_marts(spark, sf_dir), si.customers(spark, sf_dir))
