"""The generated tables in the role of retail data.

Raw frames are text as it would stand in the CSV files. Some of it is given the defects that
curation has to deal with; which row gets which defect follows from its key. No row is left out.
The expressions are plain SQL text that Spark and DuckDB evaluate alike, so that both sides of a
comparison start from the same raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwright.functions.measures import line_total
from tillwright.sources import schemas


def _text(expression: str) -> str:
    return f"cast({expression} as string)"


def _padded(expression: str, width: int) -> str:
    return f"lpad({_text(expression)}, {width}, '0')"


def product_id(key: str) -> str:
    """P and at least four digits (``lpad`` alone would cut longer keys)."""
    return f"case when {key} < 10000 then 'P' || {_padded(key, 4)} else 'P' || {_text(key)} end"


def defects(cycle: int, otherwise: str, *cases: tuple[int, str]) -> str:
    """``otherwise``, but a defect where the key leaves the given remainder (column ``turn<cycle>``)."""
    listed = " ".join(f"when {remainder} then {value}" for remainder, value in cases)
    return f"case turn{cycle} {listed} else {otherwise} end"


def _turns(key: str, *cycles: int) -> dict[str, str]:
    return {f"turn{cycle}": f"{key} % {cycle}" for cycle in cycles}


def _us(day: str) -> str:
    return f"substr({day}, 6, 2) || '-' || substr({day}, 9, 2) || '-' || substr({day}, 1, 4)"


# Columns that several defects start from, computed once per row below the text itself.
BASES = {
    "customers": {
        **_turns("c_custkey", 3, 8, 9, 10, 11, 13, 17, 31, 53),
        "key_text": _text("c_custkey"),
        "key_digits": _padded("c_custkey % 10000", 4),
        "key_day": f"'2023-' || {_padded('1 + c_custkey % 12', 2)} || '-' || {_padded('1 + c_custkey % 28', 2)}",
    },
    "products": {
        **_turns("p_partkey", 13, 15, 17, 19, 23, 29, 37, 67),
        "own_id": product_id("p_partkey"),
        "previous_id": product_id("(p_partkey - 1)"),
        "price_text": _text("cast(p_retailprice as decimal(10,2))"),
        "cost_text": _text("round(cast(p_retailprice as decimal(12,2)) * 0.6, 2)"),
        "created_day": f"'2022-' || {_padded('1 + p_partkey % 12', 2)} || '-' || {_padded('1 + p_partkey % 28', 2)}",
    },
    "lines": {
        **_turns("l_orderkey", 19, 29, 31, 37, 41, 43, 47),
        "line_id": _text("l_orderkey * 10 + l_linenumber"),
        "line_product": product_id("l_partkey"),
        "line_price": _text("cast(l_extendedprice as decimal(12,2))"),
        "line_percent": _text("cast(l_discount as decimal(5,2)) * 100"),
        "ship_day": _text("cast(l_shipdate as date)"),
    },
    "headers": {
        **_turns("o_orderkey", 17, 59, 61, 67),
        "order_day": _text("cast(o_orderdate as date)"),
    },
}
BASES["orders"] = BASES["lines"] | BASES["headers"]


CUSTOMER_TEXT = {
    "customer_id": defects(53, "key_text", (7, _text("c_custkey - 1")), (20, "'XYZ'"), (33, _text("c_custkey + 3000000000")), (40, "''")),
    "first_name": defects(11, "c_name", (3, "'   '"), (4, "'  ' || c_name || ' '")),
    "last_name": "c_mktsegment",
    "email": defects(
        9, "'user' || key_text || '@example.com'",
        (1, "'user' || key_text || 'example.com'"),
        (2, "' User' || key_text || '@Shop.Example.COM '"),
        (3, "'user@@example.com'"), (4, "'user@example'"),
    ),
    "phone": defects(
        8, "'612555' || key_digits",
        (1, "'(612)555-' || key_digits"),
        (2, "'+1 612 555 ' || key_digits"),
        (3, "'abc' || key_text"), (4, "''"),
    ),
    "signup_date": defects(
        13, "key_day",
        (2, "replace(key_day, '-', '/')"), (5, "'2023-04-31'"), (6, "'2023-1-5'"), (7, "'notadate'"),
    ),
    "country": "case c_nationkey when 0 then 'usa' when 1 then 'U.S.A.' when 2 then 'United States' "
    "when 3 then 'US' when 4 then 'CANADA' when 5 then 'mexico' else n_name end",
    "state": defects(3, "' ' || r_name || ' '", (0, "lower(r_name)")),
    "postal_code": defects(17, _padded("c_custkey % 100000", 5), (6, "''")),
    "is_active": defects(
        10, "'true'", (0, "'TRUE'"), (1, "'False'"), (2, "'FALSE'"), (3, "'Yes'"), (4, "'1'")
    ),
    "loyalty_points": defects(31, _text("cast(floor(c_acctbal) as int)"), (9, "'abc'")),
}

PRODUCT_TEXT = {
    "product_id": defects(
        67, "own_id", (5, "previous_id"), (20, "'BADID'"), (33, "' ' || own_id || ' '"), (50, "''")
    ),
    "product_name": "p_name",
    "category": "p_type",
    "brand": defects(17, "p_brand", (3, "' '")),
    "price": defects(
        23, "price_text",
        (1, "'$' || price_text"), (2, "replace(price_text, '.', ',')"), (3, "'?'"), (4, "'N/A'"),
        (5, "'-' || price_text"), (6, "' ' || price_text || ' '"), (7, "price_text || '$'"), (8, "''"),
        (9, "'0'"), (10, "'123456789012.00'"),
    ),
    "cost": defects(37, "cost_text", (1, "'$' || cost_text"), (2, "'none'"), (3, "'-1,50'")),
    "stock_quantity": defects(29, _text("p_size * 10"), (4, "'-5'"), (9, "''"), (14, "' 7'")),
    "weight_kg": defects(19, f"{_text('p_size')} || '.5'", (0, "'?'"), (1, "'.25'"), (2, "''")),
    "created_date": defects(
        13, "created_day",
        (1, "replace(created_day, '-', '/')"), (2, "'2023-02-30'"), (3, "'bad-date'"), (4, "' ' || created_day"),
    ),
    "is_active": defects(
        15, "'TRUE'", (1, "'Yes'"), (2, "'y'"), (3, "'N'"), (4, "'no'"), (5, "'1'"), (6, "'unknown'"), (7, "'False '")
    ),
}

# Order columns that come from the lines, and those that come from the order headers.
LINE_TEXT = {
    "order_id": defects(
        41, "line_id",
        (3, "'BADID'"), (9, "' ' || line_id || ' '"), (17, "'NULL'"),
        (23, f"'99999' || {_padded('l_orderkey', 9)}"),
        (29, f"'99999999999999' || {_padded('l_orderkey', 11)}"),
    ),
    "product_id": defects(47, "line_product", (11, "'BADID'"), (12, "''"), (13, "'P99999'")),
    "ship_date": defects(
        19, "ship_day",
        (1, "replace(ship_day, '-', '/')"), (2, _us("ship_day")), (4, "''"),
    ),
    "quantity": defects(
        43, _text("cast(l_quantity as int)"), (5, "'0'"), (6, "'-3'"), (7, "'many'"), (8, "'99999999999'")
    ),
    "unit_price": defects(
        29, "line_price",
        (1, "'$' || line_price"), (2, "line_price || '$'"), (3, "'-' || line_price"), (4, "' '"),
        (5, "replace(line_price, '.', ',')"), (6, "'0'"),
    ),
    "discount_pct": defects(
        37, "line_percent", (1, "line_percent || '%'"), (2, "'150'"), (3, "'abc'"), (4, "'100'"), (5, "'-1'")
    ),
    "total_amount": defects(31, "line_price", (1, "'-' || line_price"), (2, "'n/a'"), (3, "'$' || line_price")),
}

HEADER_TEXT = {
    "customer_id": defects(59, _text("o_custkey"), (1, "'XYZ'"), (2, "''"), (3, "'-5'"), (4, "'123456789012'"), (5, "'1234567890123456789012345'")),
    "order_date": defects(
        17, "order_day",
        (1, "replace(order_day, '-', '/')"), (2, _us("order_day")), (3, f"replace({_us('order_day')}, '-', '/')"),
        (4, "'2023-02-30'"), (5, "'bad-date'"),
    ),
    "payment_method": defects(61, "o_orderpriority", (1, "' null '"), (2, "''"), (3, "' ' || o_orderpriority")),
    "order_status": defects(67, "o_orderstatus", (1, "'NULL'")),
}

ORDER_COLUMNS = [field.split()[0] for field in schemas.ORDERS_RAW.split(",")]
ORDER_TEXT = {name: {**LINE_TEXT, **HEADER_TEXT}[name] for name in ORDER_COLUMNS}

SOURCES = {
    "customers": "customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
    "products": "part",
    "orders": "lineitem join orders on l_orderkey = o_orderkey",
}
RAW_TEXT = {"customers": CUSTOMER_TEXT, "products": PRODUCT_TEXT, "orders": ORDER_TEXT}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def select_text(df: DataFrame, columns: dict[str, str], *names: str, bases: str | None = None) -> DataFrame:
    """Columns given as SQL text over a table that has what they need."""
    if bases:
        df = df.selectExpr("*", *[f"{expression} as {name}" for name, expression in BASES[bases].items()])
    return df.selectExpr(*[f"{columns[name]} as {name}" for name in names or columns])


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with nation and region."""
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    return table(spark, sf_dir, "customer").join(nations, F.expr("c_nationkey = n_nationkey"))


def order_rows(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines with their headers; ``lines`` may be a stream of them."""
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    return lines.join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))


def raw_customers_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers as text."""
    return select_text(customer_rows(spark, sf_dir), CUSTOMER_TEXT, bases="customers")


def raw_products_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw products as text."""
    return select_text(table(spark, sf_dir, "part"), PRODUCT_TEXT, bases="products")


def _as_csv_reads(name: str, kind: str) -> Column:
    """What a typed CSV read makes of a token (blank text aside, which curation treats like NULL).

    The queries ``src*`` read real files instead.
    """
    token = F.col(name)
    match kind:
        case "int" | "bigint":
            value = F.when(token.rlike(r"^[+-]?\d+$"), token.try_cast(kind))
        case "float":
            value = token.try_cast("float")
        case "date":
            value = F.when(token.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), token.try_cast("date"))
        case "boolean":
            value = F.when(F.lower(token).isin("true", "false"), F.lower(token) == "true")
        case _:
            value = token
    return value.alias(name)


def _typed(text: DataFrame, schema: str) -> DataFrame:
    return text.select(*[_as_csv_reads(*field.split()) for field in schema.split(",")])


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers under the types of the CSV read."""
    return _typed(raw_customers_text(spark, sf_dir), schemas.CUSTOMERS_RAW)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw products under the types of the CSV read."""
    return _typed(raw_products_text(spark, sf_dir), schemas.PRODUCTS_RAW)


def raw_orders(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Raw orders, text only."""
    return select_text(order_rows(spark, sf_dir, lines), ORDER_TEXT, bases="orders")


# --- well-formed entities, for what comes after curation -------------------------------------
# Orders are at line grain here: an order id has several rows, which makes distinct counts matter.

CUSTOMER = {
    "customer_id": "c_custkey",
    "first_name": "c_name",
    "last_name": "c_mktsegment",
    "email": f"'user' || {_text('c_custkey')} || '@example.com'",
    "phone": f"'612555' || {_padded('c_custkey % 10000', 4)}",
    "signup_date": f"cast('2023-' || {_padded('1 + c_custkey % 12', 2)} || '-' || {_padded('1 + c_custkey % 28', 2)} as date)",
    "country": "n_name",
    "state": "r_name",
    "postal_code": _padded("c_custkey % 100000", 5),
    "is_active": "c_acctbal >= 0",
    "loyalty_points": "cast(floor(c_acctbal) as int)",
}
PRODUCT = {
    "product_id": product_id("p_partkey"),
    "product_name": "p_name",
    "category": "p_type",
    "brand": "p_brand",
    "price": "cast(p_retailprice as decimal(10,2))",
    "cost": "cast(round(cast(p_retailprice as decimal(12,2)) * 0.6, 2) as decimal(10,2))",
    "stock_quantity": "p_size * 10",
    "weight_kg": "cast(p_size as float)",
    "created_date": f"cast('2022-' || {_padded('1 + p_partkey % 12', 2)} || '-' || {_padded('1 + p_partkey % 28', 2)} as date)",
    "is_active": "p_partkey % 10 <> 0",
}
ORDER = {
    "order_id": "l_orderkey",
    "customer_id": "o_custkey",
    "product_id": product_id("l_partkey"),
    "order_date": "cast(o_orderdate as date)",
    "ship_date": "cast(l_shipdate as date)",
    "quantity": "cast(l_quantity as int)",
    "unit_price": "cast(l_extendedprice as decimal(10,2))",
    "discount_pct": "cast(cast(l_discount as decimal(5,2)) * 100 as decimal(5,2))",
    "payment_method": "o_orderpriority",
    "order_status": "o_orderstatus",
}
# Members that are known where a query is about orphans; all other queries have every member.
# Secret of the masked addresses; a real one is not written in code.
SECRET = "querybook"
KNOWN_CUSTOMERS = "c_mktsegment <> 'BUILDING'"
KNOWN_PRODUCTS = "p_size > 5"


def customers(spark: SparkSession, sf_dir: str, condition: str = "true") -> DataFrame:
    """Well-formed customers."""
    return select_text(customer_rows(spark, sf_dir).filter(condition), CUSTOMER)


def products(spark: SparkSession, sf_dir: str, condition: str = "true") -> DataFrame:
    """Well-formed products."""
    return select_text(table(spark, sf_dir, "part").filter(condition), PRODUCT)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed order lines with their total."""
    total = line_total(F.col("quantity"), F.col("unit_price"), F.col("discount_pct"))
    return select_text(order_rows(spark, sf_dir), ORDER).withColumn("total_amount", total)
