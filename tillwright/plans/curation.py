"""Raw customers, products and orders → curated entities.

Each entity goes through three steps: every column is read under its rule in one projection,
one row per key is kept, rows that break a requirement are dropped. Conditions on the key alone
are tested before the rows are brought together by key: the outcome is the same and the
junk and missing keys, which may be very many copies of one value, never reach the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from tillwright.functions.dates import ISO_DAY, US_DAY, standard_date
from tillwright.functions.measures import line_total
from tillwright.functions.numbers import (
    ID, at_least_zero, list_price, numeric_id, order_price, percentage, plain_money, whole_number,
)
from tillwright.functions.text import (
    NULL_TOKENS, NUMBER_PLACEHOLDERS, PRODUCT_ID_PATTERN, blank_to_null, canonical, email_address, matches, phone_number,
    tokens_to_null, upper_code, yes_no,
)
from tillwright.operators.dedup import one_row_per_key

# Product columns that must have a value; brand and weight_kg may lack one (fixed values).
PRODUCT_REQUIRED = (
    "product_id", "product_name", "category", "price", "cost", "stock_quantity", "created_date", "is_active",
)

# Statuses an optional filter can insist on (fixed values). The default keeps every status.
ORDER_STATUSES = ("Delivered", "Pending", "Shipped", "Cancelled", "Returned")


def trimmed(df: DataFrame) -> DataFrame:
    """Trim every text column, blank becomes NULL."""
    return df.select(
        *[
            blank_to_null(F.col(field.name)).alias(field.name) if isinstance(field.dataType, StringType) else field.name
            for field in df.schema
        ]
    )


def without_tokens(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Trim every column of a text-only frame, null tokens become NULL."""
    return df.select(*[tokens_to_null(F.col(name), tokens).alias(name) for name in df.columns])


def requirement(rules: Mapping[str, Column]) -> Column:
    """All rules hold; a rule that comes out as NULL does not."""
    combined = F.lit(True)
    for rule in rules.values():
        combined = combined & rule
    return combined


def all_present(names: list[str] | tuple[str, ...]) -> dict[str, Column]:
    """One rule per column: it has a value."""
    return {f"{name} missing": F.col(name).isNotNull() for name in names}


def with_reasons(survivors: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows with ``reasons``, the names of the rules each one breaks; accepted rows break none."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(reason)) for reason, rule in rules.items()]
    return survivors.withColumn("reasons", F.array_compact(F.array(*broken)))


# --- customers ------------------------------------------------------------------------------


def parse_customers(raw: DataFrame) -> DataFrame:
    """Every column of the raw customers under its rule."""
    return trimmed(raw).withColumns(
        {
            "email": email_address(F.col("email")),
            "phone": phone_number(F.col("phone")),
            "loyalty_points": at_least_zero(F.col("loyalty_points")),
            "country": canonical(F.col("country")),
            "state": upper_code(F.col("state")),
        }
    )


def surviving_customers(raw: DataFrame, id_type: str = ID) -> DataFrame:
    """One parsed row per customer id; rows without one cannot become customers."""
    raw = raw.withColumn("customer_id", F.col("customer_id").try_cast(id_type))
    return one_row_per_key(parse_customers(raw.filter("customer_id is not null")), ["customer_id"])


def customer_rules(survivors: DataFrame) -> dict[str, Column]:
    """What a curated customer must satisfy: every column has a value."""
    return all_present(survivors.columns)


def clean_customers(raw: DataFrame, id_type: str = ID) -> DataFrame:
    """One complete row per customer; with ``id_type`` ``int`` larger ids go."""
    return surviving_customers(raw, id_type).dropna()


# --- products -------------------------------------------------------------------------------


def parse_products(raw: DataFrame) -> DataFrame:
    """Every column of the raw products under its rule."""
    text = trimmed(raw)
    price = {name: list_price(tokens_to_null(F.col(name), NUMBER_PLACEHOLDERS)) for name in ("price", "cost")}
    return text.withColumns(
        {
            **price,
            "created_date": standard_date(F.col("created_date")),
            "is_active": yes_no(F.col("is_active")),
        }
    )


def product_rules() -> dict[str, Column]:
    """What a curated product must satisfy."""
    return {
        "price not positive": F.col("price") > 0,
        "cost negative": F.col("cost") >= 0,
        "stock negative": F.col("stock_quantity") >= 0,
        **all_present(PRODUCT_REQUIRED),
    }


def surviving_products(raw: DataFrame, id_pattern: str = PRODUCT_ID_PATTERN) -> DataFrame:
    """One parsed row per well-formed product id; other rows cannot become products."""
    identified = raw.filter(matches(F.trim("product_id"), id_pattern))
    return one_row_per_key(parse_products(identified), ["product_id"])


def clean_products(raw: DataFrame, id_pattern: str = PRODUCT_ID_PATTERN) -> DataFrame:
    """One valid row per well-formed product id."""
    return surviving_products(raw, id_pattern).filter(requirement(product_rules()))


# --- orders ---------------------------------------------------------------------------------


def parse_orders(
    raw: DataFrame, payment_names: Mapping[str, tuple[str, ...]] | None = None, id_type: str = ID
) -> DataFrame:
    """Every column of the raw orders under its rule.

    ``order_id`` stays text, because ids are told apart as they were written; ``order_number`` is its
    integer, NULL when the id is none.

    ``payment_names`` optionally maps spellings of payment methods to one name. By default
    the methods stay as written. ``id_type`` may be ``int``, which rejects larger ids.
    """
    text = without_tokens(raw)
    method = F.col("payment_method")
    return text.withColumns(
        {
            "order_number": numeric_id(F.col("order_id"), id_type),
            "customer_id": numeric_id(F.col("customer_id"), id_type),
            "order_date": standard_date(F.col("order_date"), (ISO_DAY, US_DAY)),
            "ship_date": standard_date(F.col("ship_date"), (ISO_DAY, US_DAY)),
            "quantity": whole_number(F.col("quantity")),
            "unit_price": order_price(F.col("unit_price")),
            "discount_pct": percentage(F.col("discount_pct")),
            "total_amount": plain_money(F.col("total_amount")),
            "payment_method": canonical(method, payment_names) if payment_names else method,
        }
    )


def surviving_orders(
    raw: DataFrame, payment_names: Mapping[str, tuple[str, ...]] | None = None, id_type: str = ID
) -> DataFrame:
    """One parsed row per order id of digits; other rows cannot become orders."""
    identified = raw.filter(F.trim("order_id").rlike(r"^\d+$"))
    return one_row_per_key(parse_orders(identified, payment_names, id_type), ["order_id"])


def order_rules(
    statuses: tuple[str, ...] | None = None, id_pattern: str = PRODUCT_ID_PATTERN
) -> dict[str, Column]:
    """What a curated order must satisfy; ``statuses`` optionally limits the order status."""
    present = ("customer_id", "order_date", "ship_date", "payment_method", "order_status")
    rules = {
        "order id out of range": F.col("order_number").isNotNull(),
        "product id malformed": matches(F.col("product_id"), id_pattern),
        "quantity not positive": F.col("quantity") > 0,
        "unit price negative": F.col("unit_price") >= 0,
        "total amount negative": F.col("total_amount") >= 0,
        "discount outside 0 to 100": F.col("discount_pct").between(0, 100),
        **all_present(present),
    }
    if statuses:
        rules["order status unknown"] = F.col("order_status").isin(*statuses)
    return rules


def valid_orders(
    survivors: DataFrame, statuses: tuple[str, ...] | None = None, id_pattern: str = PRODUCT_ID_PATTERN
) -> DataFrame:
    """The orders that satisfy all rules, with integer id and recomputed total.

    The total that came with the order only serves as a rule.
    """
    return with_total(survivors.filter(requirement(order_rules(statuses, id_pattern))))


def with_total(accepted: DataFrame) -> DataFrame:
    """Accepted orders with integer id and recomputed total."""
    total = line_total(F.col("quantity"), F.col("unit_price"), F.col("discount_pct"))
    kept = [name for name in accepted.columns if name not in ("order_id", "order_number", "total_amount")]
    return accepted.select(F.col("order_number").alias("order_id"), *kept, total.alias("total_amount"))


def rejected_orders(
    survivors: DataFrame, statuses: tuple[str, ...] | None = None, id_pattern: str = PRODUCT_ID_PATTERN
) -> DataFrame:
    """The other orders, with the list of rules each one breaks."""
    return with_reasons(survivors, order_rules(statuses, id_pattern)).drop("order_number").filter(F.size("reasons") > 0)


def clean_orders(
    raw: DataFrame,
    payment_names: Mapping[str, tuple[str, ...]] | None = None,
    statuses: tuple[str, ...] | None = None,
    id_type: str = ID,
    id_pattern: str = PRODUCT_ID_PATTERN,
) -> DataFrame:
    """One valid row per order id; for the options see :func:`parse_orders` and :func:`order_rules`."""
    return valid_orders(surviving_orders(raw, payment_names, id_type), statuses, id_pattern)


# --- row counts -----------------------------------------------------------------------------


def funnel(stages: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``(entity, raw_rows, clean_rows)`` from one pair of raw and clean frames per entity."""
    counts = None
    for entity, pair in stages.items():
        for label, df in zip(("raw", "clean"), pair):
            one = df.agg(F.count("*").alias("n")).select(F.lit(entity).alias("entity"), F.lit(label).alias("label"), "n")
            counts = one if counts is None else counts.unionByName(one)
    by_label = {label: F.max(F.when(F.col("label") == label, F.col("n"))) for label in ("raw", "clean")}
    return counts.groupBy("entity").agg(by_label["raw"].alias("raw_rows"), by_label["clean"].alias("clean_rows"))
