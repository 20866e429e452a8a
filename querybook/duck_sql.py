"""The registered queries in DuckDB SQL.

``STEPS`` are named common table expressions; a query gets those it mentions. Amounts that Spark
divides as decimals are divided as integers here, with the rounding steps of Spark's decimal types
spelled out, because DuckDB would fall back to binary floating point.
"""

from __future__ import annotations

import hashlib
import re

from querybook import standins as si
from tillwright.plans.curation import PRODUCT_REQUIRED
from tillwright.sources import schemas

STEPS: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def _mentioned(sql: str) -> list[str]:
    return [name for name in STEPS if re.search(rf"\b{name}\b", sql)]


def complete(sql: str) -> str:
    """Prefix ``sql`` with the steps it needs, in the order of their definition."""
    needed, pending = set(), _mentioned(sql)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += [other for other in _mentioned(STEPS[name]) if other != name]
    steps = [f"{name} AS ({body})" for name, body in STEPS.items() if name in needed]
    return f"WITH {', '.join(steps)} {sql}" if steps else sql


def half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half away from zero; NULL for denominator 0."""
    n, d = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)"
    return f"(case when {d} <> 0 then sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) end)"


def cents(amount: str) -> str:
    return f"cast(cast({amount} as decimal(30,2)) * 100 as hugeint)"


def from_cents(number: str, kind: str = "decimal(38,2)") -> str:
    return f"cast(cast({number} as decimal(30,0)) * cast(0.01 as decimal(3,2)) as {kind})"


def percent(part: str, whole: str, digits: int, kind: str = "decimal(38,2)") -> str:
    """part / whole to ``digits`` places, times 100 to six places, then to two."""
    quotient = half_up(f"{cents(part)} * {10**digits}", cents(whole))
    return from_cents(half_up(half_up(quotient, str(10 ** (digits - 8))), "10000"), kind)


def average(amount: str, count: str) -> str:
    """amount / count to twelve places, then to two."""
    return from_cents(half_up(half_up(f"{cents(amount)} * 10000000000", count), "10000000000"))


def line_total(quantity: str, price: str, discount: str) -> str:
    return from_cents(half_up(f"{quantity} * {cents(price)} * (10000 - {cents(discount)})", "10000"), "decimal(27,2)")


def columns(mapping: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in mapping.items())


def greatest_row(step: str, key: str, names: list[str]) -> str:
    order = ", ".join(f"{name} DESC NULLS LAST" for name in names if name != key)
    return f"SELECT {', '.join(names)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS place FROM {step}) WHERE place = 1"


def tokens(expression: str, *words: str) -> str:
    listed = ", ".join(f"'{word}'" for word in words)
    return f"case when lower(trim({expression})) in ({listed}) then null else trim({expression}) end"


NULLS = ("", "null")
PLACEHOLDERS = ("", "null", "n/a", "na", "none", "?")


def whole(expression: str, kind: str = "int") -> str:
    return f"case when regexp_full_match({expression}, '[+-]?[0-9]+') then try_cast({expression} as {kind}) end"


def numeric_id(expression: str) -> str:
    return f"case when regexp_full_match({expression}, '[0-9]+') then try_cast({expression} as bigint) end"


def money(expression: str) -> str:
    return f"try_cast({expression} as decimal(10,2))"


def list_price(expression: str) -> str:
    bare = f"regexp_replace({expression}, '^[$]', '')"
    return f"case when regexp_full_match({bare}, '-?[0-9]+,[0-9]{{2}}') then {money(f'''replace({bare}, ',', '.')''')} else {money(bare)} end"


def day(expression: str, *formats: tuple[str, str]) -> str:
    dashed = f"replace({expression}, '/', '-')"
    tries = [
        f"case when regexp_full_match({dashed}, '{shape}') then cast(try_strptime({dashed}, '{pattern}') as date) end"
        for shape, pattern in formats
    ]
    return f"coalesce({', '.join(tries)}, null)"


ISO = ("[0-9]{4}-[0-9]{2}-[0-9]{2}", "%Y-%m-%d")
US = ("[0-9]{2}-[0-9]{2}-[0-9]{4}", "%m-%d-%Y")
EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"


def email(expression: str) -> str:
    return f"case when regexp_full_match({expression}, '{EMAIL}') then lower({expression}) end"


def phone(expression: str) -> str:
    digits = f"regexp_replace({expression}, '[^0-9]', '', 'g')"
    return f"case when length({digits}) between 10 and 15 then {digits} end"


def country(expression: str) -> str:
    return (
        f"case when lower({expression}) in ('usa', 'u.s.a.', 'united states', 'us') then 'USA' "
        f"when lower({expression}) = 'canada' then 'Canada' when lower({expression}) = 'mexico' then 'Mexico' else {expression} end"
    )


def yes_no(expression: str) -> str:
    return f"case when lower({expression}) in ('true', 'yes', 'y') then true when lower({expression}) in ('false', 'no', 'n') then false end"


def blank(expression: str) -> str:
    return f"nullif(trim({expression}), '')"


def missing_dropped(step: str, names) -> str:
    return f"SELECT * FROM {step} WHERE " + " AND ".join(f"{name} IS NOT NULL" for name in names)


# --- raw text and what the CSV read makes of it ----------------------------------------------

for entity, text in si.RAW_TEXT.items():
    STEPS[f"text_{entity}"] = (
        f"SELECT {columns(text)} FROM (SELECT *, {columns(si.BASES[entity])} FROM {si.SOURCES[entity]})"
    )

C, P, O = list(si.CUSTOMER_TEXT), list(si.PRODUCT_TEXT), list(si.ORDER_TEXT)

TYPED_CUSTOMER = {name: f"nullif({name}, '')" for name in C} | {
    "customer_id": whole("customer_id", "bigint"),
    "signup_date": "case when regexp_full_match(signup_date, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') then try_cast(signup_date as date) end",
    "is_active": "case lower(is_active) when 'true' then true when 'false' then false end",
    "loyalty_points": whole("loyalty_points"),
}
TYPED_PRODUCT = {name: f"nullif({name}, '')" for name in P} | {
    "stock_quantity": whole("stock_quantity"),
    "weight_kg": "try_cast(weight_kg as float)",
}
STEPS["typed_customers"] = f"SELECT {columns(TYPED_CUSTOMER)} FROM text_customers"
STEPS["typed_products"] = f"SELECT {columns(TYPED_PRODUCT)} FROM text_products"

ORACLE["src1_orders_csv"] = f"SELECT {columns({name: f'''nullif({name}, '')''' for name in O})} FROM text_orders"
ORACLE["src2_products_csv"] = "SELECT * FROM typed_products"
ORACLE["src3_customers_csv"] = "SELECT * FROM typed_customers"

# --- cleaning ---------------------------------------------------------------------------------

PARSED_CUSTOMER = {name: blank(name) for name in C} | {
    "customer_id": "customer_id", "signup_date": "signup_date", "is_active": "is_active",
    "email": email(blank("email")),
    "phone": phone(blank("phone")),
    "loyalty_points": "case when loyalty_points < 0 then 0 else loyalty_points end",
    "country": country(blank("country")),
    "state": f"upper({blank('state')})",
}
PARSED_PRODUCT = {name: blank(name) for name in P} | {
    "stock_quantity": "stock_quantity", "weight_kg": "weight_kg",
    "price": list_price(f"({tokens('price', *PLACEHOLDERS)})"),
    "cost": list_price(f"({tokens('cost', *PLACEHOLDERS)})"),
    "created_date": day(blank("created_date"), ISO),
    "is_active": yes_no(blank("is_active")),
}
BARE_ORDER = {name: tokens(name, *NULLS) for name in O}
PARSED_ORDER = {name: name for name in O} | {
    "customer_id": numeric_id("customer_id"),
    "order_date": day("order_date", ISO, US),
    "ship_date": day("ship_date", ISO, US),
    "quantity": whole("quantity"),
    "unit_price": money("replace(unit_price, '$', '')"),
    "discount_pct": "try_cast(replace(discount_pct, '%', '') as decimal(5,2))",
    "total_amount": money("total_amount"),
}
STEPS["parsed_customers"] = f"SELECT {columns(PARSED_CUSTOMER)} FROM typed_customers"
STEPS["parsed_products"] = f"SELECT {columns(PARSED_PRODUCT)} FROM typed_products"
STEPS["bare_orders"] = f"SELECT {columns(BARE_ORDER)} FROM text_orders"
STEPS["parsed_orders"] = f"SELECT {columns(PARSED_ORDER)} FROM bare_orders"
STEPS["single_customers"] = greatest_row("parsed_customers", "customer_id", C)
STEPS["identified_products"] = "SELECT * FROM parsed_products WHERE regexp_full_match(product_id, 'P[0-9]{4}')"
STEPS["single_products"] = greatest_row("identified_products", "product_id", P)
STEPS["single_orders"] = greatest_row("parsed_orders", "order_id", O)
STEPS["clean_customers"] = missing_dropped("single_customers", C)
STEPS["clean_products"] = (
    missing_dropped("single_products", PRODUCT_REQUIRED) + " AND price > 0 AND cost >= 0 AND stock_quantity >= 0"
)
RANGES = (
    "regexp_full_match(product_id, 'P[0-9]{4}') AND quantity > 0 AND unit_price >= 0 AND total_amount >= 0 "
    "AND discount_pct BETWEEN 0 AND 100"
)
CLEAN_ORDER = {name: name for name in O if name != "total_amount"} | {
    "order_id": numeric_id("order_id"),
    "total_amount": line_total("quantity", "unit_price", "discount_pct"),
}
STEPS["clean_orders"] = (
    f"SELECT {columns(CLEAN_ORDER)} FROM single_orders WHERE {RANGES} AND {numeric_id('order_id')} IS NOT NULL AND customer_id IS NOT NULL "
    "AND order_date IS NOT NULL AND ship_date IS NOT NULL AND payment_method IS NOT NULL AND order_status IS NOT NULL"
)

ORACLE["cln1_blank_to_null"] = f"SELECT {columns({name: blank(name) for name in P})} FROM text_products"
ORACLE["cln2_null_tokens"] = "SELECT * FROM bare_orders"
ORACLE["cln3_number_placeholders"] = (
    f"SELECT product_id, {tokens('price', *PLACEHOLDERS)} AS price, {tokens('cost', *PLACEHOLDERS)} AS cost FROM text_products"
)
ORACLE["cln4_email"] = f"SELECT customer_id, {email(blank('email'))} AS email FROM text_customers"
ORACLE["cln5_phone"] = f"SELECT customer_id, {phone('phone')} AS phone FROM text_customers"
ORACLE["cln6_clamp"] = (
    f"SELECT customer_id, case when points < 0 then 0 else points end AS loyalty_points "
    f"FROM (SELECT customer_id, {whole('loyalty_points')} AS points FROM text_customers)"
)
ORACLE["cln7_country"] = f"SELECT customer_id, {country('country')} AS country FROM text_customers"
ORACLE["cln8_state"] = "SELECT customer_id, upper(trim(state)) AS state FROM text_customers"
ORACLE["cln9_all_required"] = missing_dropped("parsed_customers", C)
ORACLE["cln10_some_required"] = missing_dropped("parsed_products", PRODUCT_REQUIRED)
ORACLE["cln11_one_row_per_key"] = greatest_row("bare_orders", "order_id", O)
ORACLE["cln12_id_filter"] = (
    f"SELECT {blank('product_id')} AS product_id, {blank('product_name')} AS product_name FROM text_products "
    f"WHERE regexp_full_match({blank('product_id')}, 'P[0-9]{{4}}')"
)
ORACLE["cln13_numeric_id"] = (
    f"SELECT {numeric_id('order_id')} AS order_id, {numeric_id('customer_id')} AS customer_id FROM bare_orders"
)
ORACLE["cln14_list_price"] = (
    f"SELECT product_id, {PARSED_PRODUCT['price']} AS price, {PARSED_PRODUCT['cost']} AS cost FROM text_products"
)
STEPS["bare_lines"] = "SELECT " + columns({name: tokens(f"({si.LINE_TEXT[name]})", *NULLS) for name in si.LINE_TEXT}) + f" FROM (SELECT *, {columns(si.BASES['lines'])} FROM lineitem)"
ORACLE["cln15_order_price"] = (
    f"SELECT order_id, {PARSED_ORDER['unit_price']} AS unit_price, {PARSED_ORDER['total_amount']} AS total_amount FROM bare_lines"
)
ORACLE["cln16_percentage"] = f"SELECT order_id, {PARSED_ORDER['discount_pct']} AS discount_pct FROM bare_lines"
ORACLE["cln17_whole_number"] = f"SELECT order_id, {PARSED_ORDER['quantity']} AS quantity FROM bare_lines"
ORACLE["cln18_ranges"] = f"SELECT * FROM parsed_orders WHERE {RANGES}"
ORACLE["cln19_iso_date"] = f"SELECT product_id, {day(blank('created_date'), ISO)} AS created_date FROM text_products"
ORACLE["cln20_two_date_formats"] = f"SELECT order_id, {day('ship_date', ISO, US)} AS ship_date FROM bare_lines"
ORACLE["cln21_yes_no"] = f"SELECT product_id, {yes_no(blank('is_active'))} AS is_active FROM text_products"
ORACLE["cln23_funnel"] = " UNION ALL ".join(
    f"SELECT '{entity}' AS entity, (SELECT count(*) FROM text_{entity}) AS raw_rows, (SELECT count(*) FROM clean_{entity}) AS clean_rows"
    for entity in ("customers", "products", "orders")
)
ORACLE["cln_customers"] = "SELECT * FROM clean_customers"
ORACLE["cln_products"] = "SELECT * FROM clean_products"
ORACLE["cln_orders"] = "SELECT * FROM clean_orders"

# --- sales ------------------------------------------------------------------------------------


def enriched(orders: str, customers: str, products: str) -> str:
    """Inner joins of orders, customers and products with name and profit."""
    derived = {
        "customer_name": "c.first_name || ' ' || c.last_name", "country": "c.country", "state": "c.state",
        "product_name": "p.product_name", "category": "p.category", "brand": "p.brand", "cost": "p.cost",
        "profit": "cast(o.total_amount - o.quantity * p.cost as decimal(29,2))",
    }
    chosen = {name: derived.get(name, f"o.{name}") for name in schemas.SALES}
    return (
        f"SELECT {columns(chosen)} FROM {orders} o JOIN {customers} c ON o.customer_id = c.customer_id "
        f"JOIN {products} p ON o.product_id = p.product_id"
    )


ORACLE["jn2_sales_from_raw"] = enriched("clean_orders", "clean_customers", "clean_products")

for name, condition in (("all", "true"), ("known", si.KNOWN_CUSTOMERS)):
    STEPS[f"{name}_customers"] = f"SELECT {columns(si.CUSTOMER)} FROM {si.SOURCES['customers']} WHERE {condition}"
for name, condition in (("all", "true"), ("known", si.KNOWN_PRODUCTS)):
    STEPS[f"{name}_products"] = f"SELECT {columns(si.PRODUCT)} FROM part WHERE {condition}"
STEPS["order_lines"] = f"SELECT {columns(si.ORDER)} FROM {si.SOURCES['orders']}"
TOTAL = line_total("quantity", "unit_price", "discount_pct")
STEPS["all_orders"] = f"SELECT *, {TOTAL} AS total_amount FROM order_lines"
STEPS["sales"] = enriched("all_orders", "all_customers", "all_products")

ORACLE["cln22_line_total"] = "SELECT order_id, quantity, unit_price, discount_pct, total_amount FROM " + (
    f"(SELECT *, {TOTAL} AS total_amount FROM (SELECT "
    + columns({name: si.ORDER[name] for name in ("order_id", "quantity", "unit_price", "discount_pct")})
    + " FROM lineitem))"
)
ORACLE["jn1_referenced_orders"] = (
    "SELECT * FROM all_orders WHERE customer_id IN (SELECT customer_id FROM known_customers) "
    "AND product_id IN (SELECT product_id FROM known_products)"
)
ORACLE["jn2_enriched_sales"] = enriched("all_orders", "known_customers", "known_products")

MARGIN = percent("profit", "total_amount", 9, "decimal(35,2)")
STEPS["margin"] = f"SELECT order_date, product_name, quantity, cost, unit_price, total_amount, profit, {MARGIN} AS profit_margin_pct FROM sales"


def total(column: str, name: str) -> str:
    return f"cast(sum({column}) as decimal(38,2)) AS {name}"


UNITS = "cast(sum(quantity) as bigint)"
STEPS["category_summary"] = (
    f"SELECT category, {UNITS} AS units_sold, {total('total_amount', 'revenue')}, {total('profit', 'profit')} FROM sales GROUP BY category"
)
STEPS["payment_summary"] = (
    f"SELECT payment_method, count(*) AS orders, {total('total_amount', 'revenue')}, {total('profit', 'profit')} FROM sales GROUP BY payment_method"
)
ORACLE["snk1_save_and_scan_table"] = ORACLE["ag12_line_margin"] = "SELECT * FROM margin"
ORACLE["ag1_category_summary"] = "SELECT * FROM category_summary"
ORACLE["ag2_payment_summary"] = "SELECT * FROM payment_summary"
ORACLE["snk3_reporting_view"] = "SELECT category, units_sold, revenue FROM category_summary"
ORACLE["cat3_mounted_files"] = "SELECT * FROM all_customers"
ORACLE["cat3_mounted_again"] = "SELECT * FROM all_products"

# --- star schema ------------------------------------------------------------------------------

for name, members in (("dim", "all"), ("part", "known")):
    STEPS[f"{name}_customer"] = f"SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * FROM {members}_customers"
    STEPS[f"{name}_product"] = f"SELECT row_number() OVER (ORDER BY product_id) AS product_key, * FROM {members}_products"
DATE_KEY = "cast(strftime(order_date, '%Y%m%d') as int)"
STEPS["dim_date"] = (
    f"SELECT DISTINCT {DATE_KEY} AS date_key, order_date AS full_date, cast(year(order_date) as int) AS year, "
    "cast(quarter(order_date) as int) AS quarter, cast(month(order_date) as int) AS month_number, "
    "strftime(order_date, '%b') AS month_name, cast(day(order_date) as int) AS day_of_month, "
    "cast(dayofweek(order_date) as int) AS day_of_week_number, strftime(order_date, '%a') AS day_name "
    "FROM sales WHERE order_date IS NOT NULL"
)
for name, members in (("fact_sales", "dim"), ("part_fact", "part")):
    STEPS[name] = (
        f"SELECT s.order_id, c.customer_key, p.product_key, {DATE_KEY} AS date_key, s.customer_id, s.product_id, s.order_date, "
        "s.quantity, s.unit_price, s.discount_pct, s.total_amount, s.profit, s.payment_method, s.order_status "
        f"FROM sales s LEFT JOIN {members}_customer c ON s.customer_id = c.customer_id LEFT JOIN {members}_product p ON s.product_id = p.product_id"
    )
ORACLE["dim1_customers"] = "SELECT * FROM dim_customer"
ORACLE["dim2_products"] = "SELECT * FROM dim_product"
ORACLE["dim3_dates"] = "SELECT * FROM dim_date"
ORACLE["dim4_fact_sales"] = "SELECT * FROM part_fact"
for query, key, column in (
    ("dim5_payment_methods", "payment_key", "payment_method"),
    ("dim5_order_statuses", "order_status_key", "order_status"),
):
    ORACLE[query] = f"SELECT row_number() OVER (ORDER BY {column}) AS {key}, {column} FROM (SELECT DISTINCT {column} FROM sales)"
ORACLE["snk2_save_dimension_and_fact"] = (
    "SELECT * FROM fact_sales"
)
ORACLE["jn3_key_lookup"] = (
    "SELECT order_id, o.customer_id, total_amount, customer_key FROM all_orders o LEFT JOIN part_customer c ON o.customer_id = c.customer_id"
)
ORACLE["jn4_fact_to_dimension"] = (
    "SELECT product_key, order_id, quantity, total_amount, p.product_id, category FROM part_fact JOIN part_product p USING (product_key)"
)
ORACLE["jn5_orphan_products"] = (
    "SELECT DISTINCT s.product_id FROM sales s LEFT JOIN known_products p ON s.product_id = p.product_id WHERE p.product_id IS NULL"
)

# --- reports ----------------------------------------------------------------------------------


def measures(units: str = "units_sold", revenue: str = "revenue", profit: str = "profit") -> str:
    return (
        f"count(DISTINCT order_id) AS total_orders, {UNITS} AS {units}, "
        f"{total('total_amount', revenue)}, {total('profit', profit)}"
    )


SUM_MARGIN = percent("profit", "revenue", 10)
STEPS["kpis"] = f"SELECT {measures('total_units_sold', 'total_revenue', 'total_profit')} FROM sales"
ORACLE["ag3_executive_kpis"] = (
    f"SELECT *, {percent('total_profit', 'total_revenue', 10)} AS overall_profit_margin_pct, "
    f"{average('total_revenue', 'total_orders')} AS average_order_value FROM kpis"
)
PARTS = "full_date, year, quarter, month_number, month_name"
ORACLE["ag4_daily_sales"] = f"SELECT {PARTS}, {measures()} FROM fact_sales JOIN dim_date USING (date_key) GROUP BY {PARTS}"
ORACLE["ord1_days_in_order"] = ORACLE["ag4_daily_sales"] + " ORDER BY full_date"
STEPS["by_category"] = f"SELECT category, {measures()} FROM fact_sales JOIN dim_product USING (product_key) GROUP BY category"
ORACLE["ag5_category_performance"] = f"SELECT *, {SUM_MARGIN} AS profit_margin_pct FROM by_category"
PRODUCT_PARTS = "p.product_id, p.product_name, p.category, p.brand"
STEPS["by_product"] = (
    f"SELECT {PRODUCT_PARTS}, {measures()} FROM fact_sales JOIN dim_product p USING (product_key) GROUP BY {PRODUCT_PARTS}"
)
ORACLE["ag6_product_performance"] = ORACLE["ord2_products_by_revenue"] = (
    f"SELECT *, {SUM_MARGIN} AS profit_margin_pct FROM by_product ORDER BY revenue DESC, product_id"
)
ORACLE["ag7_payment_performance"] = f"SELECT payment_method, {measures()} FROM fact_sales GROUP BY payment_method"
CUSTOMER_PARTS = "c.customer_id, c.first_name, c.last_name, c.country, c.state"
STEPS["by_customer"] = (
    f"SELECT {CUSTOMER_PARTS}, {measures('units_purchased', 'total_spent', 'total_profit_generated')} "
    f"FROM fact_sales JOIN dim_customer c USING (customer_key) GROUP BY {CUSTOMER_PARTS}"
)
ORACLE["ag8_customer_performance"] = "SELECT * FROM by_customer"
ORACLE["ag9_category_revenue"] = "SELECT category, revenue FROM by_category"
ORACLE["ag10_conditional_counts"] = "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {name} IS NULL) AS null_{name}" for name in ("order_id", "customer_id", "product_id")
) + " FROM parsed_orders"
ORACLE["ag11_repeated_keys"] = "SELECT order_id, count(*) AS duplicate_count FROM all_orders GROUP BY order_id HAVING count(*) > 1"
ORACLE["ord3_top_categories"] = "SELECT * FROM category_summary ORDER BY units_sold DESC, category LIMIT 10"
ORACLE["ord3_top_payment_methods"] = "SELECT * FROM payment_summary ORDER BY orders DESC, payment_method LIMIT 10"
ORACLE["ord3_top_customers"] = "SELECT * FROM by_customer ORDER BY total_spent DESC, customer_id LIMIT 10"
ORACLE["set2_distinct_days"] = "SELECT DISTINCT order_date FROM sales"
ORACLE["sub1_two_counts"] = (
    "SELECT (SELECT count(*) FROM sales) AS curated_sales_rows, (SELECT count(*) FROM fact_sales) AS fact_sales_rows"
)

# --- checks -----------------------------------------------------------------------------------


def counts(**named: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {step}" for name, step in named.items())


def check(name: str, table: str, failures: str) -> str:
    return f"SELECT '{name}' AS check_name, '{table}' AS table_name, ({failures}) AS failed_rows"


def checks(*listed: str) -> str:
    return f"SELECT *, failed_rows = 0 AS passed FROM ({' UNION ALL '.join(listed)})"


def repeated(table: str, step: str, key: str) -> str:
    return check(f"{key} repeats", table, f"SELECT count(*) FROM (SELECT {key} FROM {step} GROUP BY {key} HAVING count(*) > 1)")


def empty(table: str, step: str, *keys: str) -> list[str]:
    return [check(f"{key} is null", table, f"SELECT count(*) FROM {step} WHERE {key} IS NULL") for key in keys]


def unknown(table: str, step: str, key: str, parent: str) -> str:
    orphans = f"SELECT DISTINCT s.{key} FROM {step} s LEFT JOIN {parent} p ON s.{key} = p.{key} WHERE p.{key} IS NULL"
    return check(f"{key} unknown", table, f"SELECT count(*) FROM ({orphans})")


ORACLE["dq1_row_counts"] = counts(
    customers="all_customers", products="all_products", orders="all_orders", sales_curated="sales",
    category_summary="category_summary", payment_summary="payment_summary", margin="margin",
)
ORACLE["dq1_gold_row_counts"] = counts(
    dim_customer="dim_customer", dim_product="dim_product", dim_date="dim_date", fact_sales="fact_sales"
)
ORACLE["dq2_repeated_customers"] = (
    "SELECT customer_id, count(*) AS duplicate_count FROM typed_customers GROUP BY customer_id HAVING count(*) > 1"
)
for query, step, key in (("dq2_repeated_products", "parsed_products", "product_id"), ("dq2_repeated_orders", "bare_orders", "order_id")):
    ORACLE[query] = f"SELECT {key}, count(*) AS duplicate_count FROM {step} GROUP BY {key} HAVING count(*) > 1"
ORACLE["dq3_missing_keys"] = checks(
    *empty("customers", "typed_customers", "customer_id"),
    *empty("products", "parsed_products", "product_id"),
    *empty("orders", "parsed_orders", "order_id", "customer_id", "product_id"),
)
ORACLE["dq4_unmatched_keys"] = (
    "SELECT count(*) AS total_fact_rows, count(*) - count(customer_key) AS unmatched_customers, "
    "count(*) - count(product_key) AS unmatched_products, count(*) - count(date_key) AS unmatched_dates FROM part_fact"
)


def surrogates(prefix: str) -> list[str]:
    return [
        repeated("dim_customer", f"{prefix}_customer", "customer_key"),
        repeated("dim_product", f"{prefix}_product", "product_key"),
        repeated("dim_date", "dim_date", "date_key"),
    ]


STEPS["twice_customer"] = "SELECT * FROM dim_customer UNION ALL SELECT * FROM dim_customer WHERE loyalty_points < 0"
STEPS["twice_product"] = "SELECT * FROM dim_product UNION ALL SELECT * FROM dim_product WHERE stock_quantity > 400"
ORACLE["dq5_repeated_surrogates"] = checks(*surrogates("twice"))
ORACLE["dq6_revenue_reconciliation"] = (
    "SELECT a AS curated_revenue, b AS gold_revenue, cast(a - b as decimal(38,2)) AS difference, a IS NOT DISTINCT FROM b AS equal FROM "
    "(SELECT (SELECT cast(sum(total_amount) as decimal(38,2)) FROM sales) AS a, "
    "(SELECT cast(sum(total_amount) as decimal(38,2)) FROM sales WHERE product_id IN (SELECT product_id FROM known_products)) AS b)"
)
ORACLE["dq7_row_count_reconciliation"] = (
    "SELECT (SELECT count(*) FROM sales) AS curated_sales_rows, "
    "(SELECT count(*) FROM sales WHERE product_id IN (SELECT product_id FROM known_products)) AS fact_sales_rows"
)
ORACLE["dq8_orphan_customers"] = (
    "SELECT DISTINCT s.customer_id FROM sales s LEFT JOIN known_customers c ON s.customer_id = c.customer_id WHERE c.customer_id IS NULL"
)
ORACLE["dq8_orphan_product_keys"] = (
    "SELECT DISTINCT f.product_key FROM part_fact f LEFT JOIN part_product p ON f.product_key = p.product_key WHERE p.product_key IS NULL"
)
ORACLE["dq9_product_listing"] = "SELECT product_id, product_name, category FROM all_products ORDER BY product_id"
ORACLE["dq_full_report"] = checks(
    repeated("customers", "known_customers", "customer_id"),
    repeated("products", "known_products", "product_id"),
    repeated("orders", "sales", "order_id"),
    *empty("customers", "known_customers", "customer_id"),
    *empty("products", "known_products", "product_id"),
    *empty("orders", "sales", "order_id", "customer_id", "product_id"),
    unknown("sales_curated", "sales", "product_id", "known_products"),
    unknown("sales_curated", "sales", "customer_id", "known_customers"),
    *surrogates("part"),
    *empty("fact_sales", "part_fact", "customer_key", "product_key", "date_key"),
    unknown("fact_sales", "part_fact", "product_key", "part_product"),
    unknown("fact_sales", "part_fact", "customer_key", "part_customer"),
    unknown("fact_sales", "part_fact", "date_key", "dim_date"),
    check(
        "revenue differs", "fact_sales",
        "SELECT cast((SELECT sum(total_amount) FROM sales) IS DISTINCT FROM (SELECT sum(total_amount) FROM part_fact) as bigint)",
    ),
    check(
        "row count differs", "fact_sales",
        "SELECT cast((SELECT count(*) FROM sales) IS DISTINCT FROM (SELECT count(*) FROM part_fact) as bigint)",
    ),
)

# --- dashboard --------------------------------------------------------------------------------

SUMS = f"{UNITS} AS units_sold, {total('total_amount', 'revenue')}, {total('profit', 'profit')}"
for query, period in (
    ("bi2_monthly_trend", "year, month_number, month_name"),
    ("bi2_month_of_year_trend", "month_number, month_name"),
):
    ORACLE[query] = f"SELECT {period}, {SUMS} FROM fact_sales JOIN dim_date USING (date_key) GROUP BY {period}"
STEPS["margin_points"] = (
    f"SELECT category, product_id, units_sold, revenue, profit FROM by_product UNION ALL SELECT category, NULL, units_sold, revenue, profit FROM by_category"
)
ORACLE["bi3_product_margin_map"] = f"SELECT *, {SUM_MARGIN} AS profit_margin_pct FROM margin_points"
ORACLE["bi4_customer_counts"] = (
    "SELECT count(DISTINCT customer_id) AS total_customers, count(*) FILTER (WHERE is_active) AS active_customers, "
    "count(*) FILTER (WHERE NOT is_active) AS inactive_customers FROM all_customers"
)
STEPS["segments"] = (
    "SELECT customer_id, total_spent, case when total_spent >= 50000000 then 'High Value' "
    "when total_spent >= 40000000 then 'Medium Value' else 'Low Value' end AS segment FROM by_customer"
)
ORACLE["bi5_customer_segments"] = "SELECT * FROM segments"
ORACLE["bi6_segment_revenue"] = (
    "SELECT segment, count(*) AS customers, cast(sum(total_spent) as decimal(38,2)) AS revenue FROM segments GROUP BY segment"
)
ORACLE["bi7_customer_activity"] = (
    "SELECT c.customer_id, count(DISTINCT order_id) AS total_orders, max(order_date) AS last_order_date, "
    "cast(date_diff('day', max(order_date), (SELECT max(order_date) FROM fact_sales)) as int) AS days_since_last_order "
    "FROM fact_sales JOIN dim_customer c USING (customer_key) GROUP BY c.customer_id"
)
KEY = hashlib.sha256(si.SECRET.encode()).digest().ljust(64, b"\0")
INNER, OUTER = (bytes(byte ^ pad for byte in KEY).hex() for pad in (0x36, 0x5C))
ORACLE["bi8_showable_customers"] = (
    "SELECT customer_key, country, state, is_active, loyalty_points, "
    f"sha256(unhex('{OUTER}') || unhex(sha256(unhex('{INNER}') || encode(lower(trim(email)))))) AS email_fingerprint FROM dim_customer"
)

# --- streams and gates ------------------------------------------------------------------------

ORACLE["ext1_orders_from_stream"] = ORACLE["cln_orders"]
ORACLE["ext1_first_arrivals"] = "SELECT event_id, user_id, event_type, value FROM events"
RULES = {
    "order id out of range": f"{numeric_id('order_id')} IS NOT NULL",
    "product id malformed": "regexp_full_match(product_id, 'P[0-9]{4}')",
    "quantity not positive": "quantity > 0",
    "unit price negative": "unit_price >= 0",
    "total amount negative": "total_amount >= 0",
    "discount outside 0 to 100": "discount_pct BETWEEN 0 AND 100",
} | {f"{name} missing": f"{name} IS NOT NULL" for name in ("customer_id", "order_date", "ship_date", "payment_method", "order_status")}
STEPS["reasons"] = (
    "SELECT order_id, concat_ws('; ', "
    + ", ".join(f"case when coalesce({rule}, false) then null else '{reason}' end" for reason, rule in RULES.items())
    + ") AS reasons FROM single_orders WHERE regexp_full_match(order_id, '[0-9]+')"
)
ORACLE["ext2_rejected_orders"] = "SELECT * FROM reasons WHERE reasons <> ''"
ORACLE["ext2_stored_order_rejects"] = ORACLE["ext2_rejected_orders"]


def reasons(step: str, key: str, rules: dict[str, str]) -> str:
    """Rows of a step that break a rule, with the names of those they break."""
    broken = ", ".join(f"CASE WHEN coalesce({rule}, false) THEN NULL ELSE '{name}' END" for name, rule in rules.items())
    return f"SELECT * FROM (SELECT {key}, concat_ws('; ', {broken}) AS reasons FROM {step}) WHERE reasons <> ''"


ORACLE["ext2_stored_customer_rejects"] = reasons(
    "(SELECT * FROM single_customers WHERE customer_id IS NOT NULL)", "customer_id", {f"{name} missing": f"{name} IS NOT NULL" for name in C}
)
ORACLE["ext2_stored_product_rejects"] = reasons("single_products", "product_id", {
    "price not positive": "price > 0", "cost negative": "cost >= 0", "stock negative": "stock_quantity >= 0",
    **{f"{name} missing": f"{name} IS NOT NULL" for name in PRODUCT_REQUIRED},
})
ORACLE["cln23_counts_of_one_pass"] = ORACLE["cln23_funnel"]

# --- views that the catalog evaluates --------------------------------------------------------

for view, report in (
    ("executive_kpis", "ag3_executive_kpis"), ("daily_sales", "ag4_daily_sales"), ("category_performance", "ag5_category_performance"),
    ("product_performance", "ag6_product_performance"), ("payment_performance", "ag7_payment_performance"),
    ("customer_performance", "ag8_customer_performance"),
):
    ORACLE[f"snk3_{view}"] = ORACLE[report]
for mart, report in (
    ("category_summary", "ag1_category_summary"), ("payment_summary", "ag2_payment_summary"), ("executive_kpis", "ag3_executive_kpis"),
    ("daily_sales", "ag4_daily_sales"), ("category_performance", "ag5_category_performance"), ("product_performance", "ag6_product_performance"),
    ("payment_performance", "ag7_payment_performance"), ("customer_performance", "ag8_customer_performance"),
):
    ORACLE[f"ext1_mart_{mart}"] = ORACLE[report]
ORACLE["ext1_orders_by_upserts"] = ORACLE["cln_orders"]
# keys that an earlier run gave, and further ones behind the greatest
ORACLE["dim1_stable_customer_keys"] = (
    "SELECT coalesce(k.customer_key, (SELECT max(customer_key) FROM part_customer) + count(*) FILTER (k.customer_key IS NULL) "
    "OVER (ORDER BY c.customer_id)) AS customer_key, c.* FROM all_customers c LEFT JOIN part_customer k ON c.customer_id = k.customer_id"
)
STEPS["first_product_keys"] = "SELECT product_id, product_key FROM dim_product WHERE stock_quantity < 300"
ORACLE["dim2_stable_product_keys"] = (
    "SELECT coalesce(k.product_key, (SELECT max(product_key) FROM first_product_keys) + count(*) FILTER (k.product_key IS NULL) "
    "OVER (ORDER BY p.product_id)) AS product_key, p.* FROM known_products p LEFT JOIN first_product_keys k ON p.product_id = k.product_id"
)
ORACLE["snk1_switched_table"] = (
    "SELECT product_id, 'first' AS version, price FROM all_products UNION ALL "
    "SELECT product_id, 'second', cast(price * 2 as decimal(10,2)) FROM known_products"
)

ORACLE = {name: complete(sql) for name, sql in ORACLE.items()}
