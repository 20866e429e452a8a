"""Declared schemas of the raw files and column lists of the stored tables (fixed values)."""

ORDERS_RAW = """
    order_id string, customer_id string, product_id string, order_date string, ship_date string,
    quantity string, unit_price string, discount_pct string, total_amount string,
    payment_method string, order_status string
"""

PRODUCTS_RAW = """
    product_id string, product_name string, category string, brand string, price string, cost string,
    stock_quantity int, weight_kg float, created_date string, is_active string
"""

CUSTOMERS_RAW = """
    customer_id bigint, first_name string, last_name string, email string, phone string, signup_date date,
    country string, state string, postal_code string, is_active boolean, loyalty_points int
"""

ORDERS = (
    "order_id", "customer_id", "product_id", "order_date", "ship_date", "quantity", "unit_price",
    "discount_pct", "payment_method", "order_status", "total_amount",
)

SALES = (
    "order_id", "order_date", "ship_date", "customer_id", "customer_name", "country", "state",
    "product_id", "product_name", "category", "brand", "quantity", "unit_price", "discount_pct",
    "total_amount", "cost", "profit", "payment_method", "order_status",
)

FACT_SALES = (
    "order_id", "customer_key", "product_key", "date_key", "customer_id", "product_id", "order_date",
    "quantity", "unit_price", "discount_pct", "total_amount", "profit", "payment_method", "order_status",
)
