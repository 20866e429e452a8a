"""Rules that turn text into numbers. Bad text and overflow give NULL, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Result types.
MONEY = "decimal(10,2)"
PERCENT = "decimal(5,2)"
ID = "bigint"


def list_price(text: Column) -> Column:
    """Catalogue money: one ``$`` in front is dropped and ``399,99`` reads as 399.99."""
    amount = F.regexp_replace(text, r"^\$", "")
    return F.regexp_replace(amount, r"^(-?\d+),(\d{2})$", "$1.$2").try_cast(MONEY)


def order_price(text: Column) -> Column:
    """Order money: every ``$`` is dropped, a comma makes the text invalid."""
    return F.replace(text, F.lit("$"), F.lit("")).try_cast(MONEY)


def plain_money(text: Column) -> Column:
    """Money without any symbol."""
    return text.try_cast(MONEY)


def percentage(text: Column) -> Column:
    """A percentage with or without ``%``."""
    return F.replace(text, F.lit("%"), F.lit("")).try_cast(PERCENT)


def whole_number(text: Column) -> Column:
    """A whole number."""
    return text.try_cast("int")


def numeric_id(text: Column, kind: str = ID) -> Column:
    """An id of digits only, as an integer; signs, letters and overflow give NULL."""
    return F.when(text.rlike(r"^\d+$"), text.try_cast(kind))


def at_least_zero(number: Column) -> Column:
    """Negative numbers become 0; NULL stays NULL (``greatest`` would skip it)."""
    return F.when(number < 0, 0).otherwise(number)
