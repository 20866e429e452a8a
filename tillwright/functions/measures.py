"""Sales arithmetic. Money stays decimal to the end and is rounded once per step, half up."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Result types.
LINE_TOTAL = "decimal(27,2)"
LINE_PROFIT = "decimal(29,2)"
LINE_MARGIN = "decimal(35,2)"
SUMMED_MONEY = "decimal(38,2)"

# Operand type of ratios of sums: leaves ten decimal places to the quotient. At full width
# Spark would cut the quotient of two sums to six.
RATIO_OPERAND = "decimal(28,2)"


def line_total(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """Amount of an order line after discount.

    The percentage is scaled by an exact factor; a decimal division would cost much more.
    """
    return F.round(quantity * unit_price * (100 - discount_pct) * Decimal("0.01"), 2).cast(LINE_TOTAL)


def line_profit(total: Column, quantity: Column, cost: Column) -> Column:
    """Amount of an order line less the cost of its units; both have two decimals already."""
    return (total - quantity * cost).cast(LINE_PROFIT)


def line_margin(profit: Column, total: Column) -> Column:
    """Profit of a line in percent of its amount; NULL when the amount is 0."""
    return F.round(F.try_divide(profit, total) * 100, 2).cast(LINE_MARGIN)


def money_sum(amount: Column) -> Column:
    """Sum of amounts, to the cent."""
    return F.round(F.sum(amount), 2).cast(SUMMED_MONEY)


def unit_sum(quantity: Column) -> Column:
    """Sum of quantities."""
    return F.sum(quantity).cast("bigint")


def margin_pct(profit: Column, revenue: Column) -> Column:
    """Summed profit in percent of summed revenue; NULL when there is no revenue."""
    quotient = F.try_divide(profit.cast(RATIO_OPERAND), revenue.cast(RATIO_OPERAND))
    return F.round(quotient * 100, 2).cast(SUMMED_MONEY)


def per_order(revenue: Column, orders: Column) -> Column:
    """Average order value; NULL when there are no orders."""
    quotient = F.try_divide(revenue.cast(RATIO_OPERAND), orders.cast("decimal(20,0)"))
    return F.round(quotient, 2).cast(SUMMED_MONEY)
