"""The six reporting views as query texts over the stored star schema, for the catalog.

They say in SQL what :mod:`tillwright.plans.reports` says with frames, for readers who only have the
catalog: the texts name their tables in full, are evaluated when they are read, and see the tables'
current version. The fact is aggregated by key before attributes are joined, as in the frames.
"""

from __future__ import annotations

from tillwright.functions.measures import RATIO_OPERAND, SUMMED_MONEY
from tillwright.sources.versions import Staging


def _money(column: str) -> str:
    return f"cast(round(sum({column}), 2) AS {SUMMED_MONEY})"


ORDERS = "count(DISTINCT order_id) AS total_orders"


def _amounts(units: str = "units_sold", revenue: str = "revenue", profit: str = "profit") -> str:
    return ", ".join((
        f"cast(sum(quantity) AS bigint) AS {units}",
        f"{_money('total_amount')} AS {revenue}", f"{_money('profit')} AS {profit}",
    ))


def _sums(*names: str) -> str:
    return f"{ORDERS}, {_amounts(*names)}"


def _margin(profit: str = "profit", revenue: str = "revenue") -> str:
    quotient = f"try_divide(cast({profit} AS {RATIO_OPERAND}), cast({revenue} AS {RATIO_OPERAND}))"
    return f"cast(round({quotient} * 100, 2) AS {SUMMED_MONEY})"


def _by_key(fact: str, key: str, sums: str) -> str:
    return f"(SELECT {key}, {sums} FROM {fact} GROUP BY {key}) AS s"


def _apart_by_key(fact: str, key: str) -> str:
    """Sums and distinct orders by themselves: the orders then move as pairs with the key, without sums beside each of them.

    For keys whose sales lie together in the fact or that are few, so that tasks reduce the sums before they move. NULL keys
    are left out; no dimension has them.
    """
    sums, orders = (f"(SELECT {key}, {what} FROM {fact} GROUP BY {key})" for what in (_amounts(), ORDERS))
    return f"{sums} AS s JOIN {orders} AS o USING ({key})"


def view_queries(namespace: str) -> dict[str, str]:
    """Name and query of each view over the tables of a namespace; none uses another, so any order will do."""
    fact = f"{namespace}.fact_sales"
    order_value = f"try_divide(cast(total_revenue AS {RATIO_OPERAND}), cast(total_orders AS decimal(20,0)))"
    sold = "total_orders, units_sold, revenue, profit"
    spent = ("units_purchased", "total_spent", "total_profit_generated")
    return {
        "vw_executive_kpis": (
            f"SELECT *, {_margin('total_profit', 'total_revenue')} AS overall_profit_margin_pct, "
            f"cast(round({order_value}, 2) AS {SUMMED_MONEY}) AS average_order_value "
            f"FROM (SELECT {_sums('total_units_sold', 'total_revenue', 'total_profit')} FROM {fact})"
        ),
        "vw_daily_sales": (
            f"SELECT full_date, year, quarter, month_number, month_name, {sold} "
            f"FROM {_apart_by_key(fact, 'date_key')} JOIN {namespace}.dim_date USING (date_key)"
        ),
        "vw_category_performance": (
            f"SELECT *, {_margin()} AS profit_margin_pct FROM (SELECT category, {_sums()} "
            f"FROM {fact} JOIN (SELECT product_key, category FROM {namespace}.dim_product) USING (product_key) GROUP BY category)"
        ),
        "vw_product_performance": (
            f"SELECT product_id, product_name, category, brand, {sold}, {_margin()} AS profit_margin_pct "
            f"FROM {_apart_by_key(fact, 'product_key')} JOIN {namespace}.dim_product USING (product_key)"
        ),
        "vw_payment_performance": f"SELECT payment_method, {_sums()} FROM {fact} GROUP BY payment_method",
        "vw_customer_performance": (
            f"SELECT customer_id, first_name, last_name, country, state, total_orders, {', '.join(spent)} "
            f"FROM {_by_key(fact, 'customer_key', _sums(*spent))} JOIN {namespace}.dim_customer USING (customer_key)"
        ),
    }


def stage_views(staging: Staging, namespace: str) -> list[str]:
    """Add the views to what a run publishes; returns their full names."""
    for name, query in view_queries(namespace).items():
        staging.add_view(f"{namespace}.{name}", query)
    return [f"{namespace}.{name}" for name in view_queries(namespace)]
